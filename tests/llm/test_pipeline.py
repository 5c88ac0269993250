"""Stages of the pipeline against brute force on small inputs."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from tessera.llm import ngram_join, quality, repeats  # noqa: E402
from tessera.session import checkpoint_dir  # noqa: E402
from tessera.sources.fs import list_names  # noqa: E402
from test_llm import DOCS, corpus, docs  # noqa: E402

STAGE = dict(corpus_pipeline.STAGES)


def near_groups(texts, k, percent):
    """Index of the first member of each text's group."""
    words = [(t or "").encode().lower().split() for t in texts]
    sets = [{tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set() for w in words]
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return sets, [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("k,percent", [(5, 80), (1, 60), (2, 100)])
@pytest.mark.parametrize("block", [1024, 4])
def test_similarity_and_shingle_length(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = corpus(11, 150)
    sets, root = near_groups(texts, k, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_join(docs(spark, texts), k, percent=percent).collect()}
    ids = [None if i == 1 else i for i in range(len(texts))]
    assert all(got[d] == (len(sets[i]), ids[root[i]]) for i, d in enumerate(ids) if d is not None)


def test_near_copies_of_five_words_and_four_fifths(spark):
    texts = corpus(13, 150)
    _, root = near_groups(texts, 5, 80)
    assert root != near_groups(texts, 3, 90)[1]
    kept = STAGE["ngram_jaccard"](spark, docs(spark, texts), "").where("doc_id is not null").collect()
    assert sorted(r.doc_id for r in kept) == [i for i in range(len(texts)) if root[i] == i and i != 1]


def test_shared_and_null_ids_keep_one_of_a_group(spark):
    near = [" ".join(f"w{i}" for i in range(60)) + tail for tail in ("", " x", " y")]
    lone = " ".join(f"v{i}" for i in range(60))
    rows = [(None, near[0]), (None, near[1]), (None, near[1]), (None, lone), (7, lone + " a"), (7, lone + " b"), (7, lone + " b"),
            (9, ""), (9, ""), (9, None), (None, "one two"), (8, "one two"), (7, "quite another text of six")]
    df = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, again int")
    got = ngram_join.keep_one(df.withColumnRenamed("again", "key"), k=5, percent=80)
    assert got.columns == ["doc_id", "text", "key"]
    got = [(r.doc_id, r.text) for r in got.collect()]
    assert len(got) == len(set(got)) == 6
    assert sum(d is None and t in near for d, t in got) == 1 and sum(t is not None and t.startswith("v0") for _, t in got) == 1
    assert {(9, ""), (9, None), (8, "one two"), (7, "quite another text of six")} < set(got)
    comp = {(r.doc_id, r.component_id) for r in ngram_join.jaccard_join(df, k=5, percent=80).collect()}
    assert (None, 7) in comp and (None, 8) in comp and (None, None) in comp


def test_mix_tokens_and_whole_run(spark, tmp_dir):
    texts = corpus(17, 80)
    df = docs(spark, texts).where("doc_id is not null")
    mixed = STAGE["mix_sources"](spark, df, "")
    assert mixed.columns == df.columns
    taken = {}
    for r in mixed.collect():
        assert r.text == texts[r.doc_id]
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    assert taken and max(taken.values()) <= 3
    assert sorted(taken.items()) == sorted((r.doc_id, r["count"]) for r in STAGE["mix_sources"](spark, df, "").groupBy("doc_id").count().collect())
    coded = STAGE["byte_bpe"](spark, df, "").collect()
    assert len(coded) == df.count() and all(r.exact and r.n_tokens == len(r.ids) for r in coded)

    long = [" ".join(f"a{i}b{(i * j) % 97}" for j in range(80)) for i in range(30)]
    shared = " ".join(f"shared passage {j}" for j in range(60))
    rows = [(i, t + "\n" + (shared if i in (3, 4) else f"end {i}"), "en", f"s{i % 3}", None, "x") for i, t in enumerate(long)]
    rows += [(100, "too short", "en", "s0", None, "x"), (101, rows[5][1], "en", "s1", None, "x")]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    at = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    cut = {r.doc_id: r.text for r in STAGE["suffix_dedup"](spark, at.where("doc_id < 100"), "").collect()}
    assert len(cut) == 30 and all(cut[i] == rows[i][1] for i in range(30) if i not in (3, 4))
    assert all("passage 30" not in cut[i] for i in (3, 4))
    out = corpus_pipeline.run(spark, tmp_dir).collect()
    assert out and {r.doc_id for r in out} <= set(range(30)) and all(r.exact for r in out)


def test_copies_do_not_deplete_each_other(spark):
    clean = "\n".join(" ".join(f"c{i}x{j}" for j in range(30)) for i in range(3))
    line = "this very line stands in all pages of the host today"
    texts = [clean] * 30 + [line + "\n" + " ".join(f"d{i}x{j}" for j in range(60)) for i in range(25)]
    rows = [(i, t, "en", "host", None, "x") for i, t in enumerate(texts)]
    kept = {r.doc_id: r.text for r in STAGE["quality_rules"](spark, spark.createDataFrame(rows, DOCS), "").collect()}
    assert sorted(kept) == list(range(55))
    assert all(kept[i] == clean for i in range(30)) and all(line not in kept[i] for i in range(30, 55))


def test_repeated_rows_count_once_for_a_line(spark):
    text = "\n".join(" ".join(f"c{i}x{j}" for j in range(30)) for i in range(3))
    rows = [(1, text, "en", "host", None, "x")] * 30 + [(i, f"other {i} " * 30, "en", "host", None, "x") for i in range(2, 12)]
    got = quality.quality_rules(spark.createDataFrame(rows, DOCS)).where("doc_id = 1").collect()
    assert len(got) == 30 and all(r.removed_words == 0 and r.kept for r in got)


def test_short_passages_of_over_fifty_words(spark):
    words = lambda name, n: [f"{name}{j}" for j in range(n)]
    passage, fifty = words("p", 51), words("q", 50)           # fewer than 400 bytes each
    texts = [" ".join(words("a", 30) + passage + words("b", 30)), "\n".join(words("c", 30) + passage) + " " + " ".join(words("d", 30)),
             " ".join(words("e", 30) + fifty), " ".join(fifty + words("f", 30)), "", "g" * 500, "h" + "g" * 450, "z " * 90]
    rows = [(i, t, "en", "src", None, "x") for i, t in enumerate(texts)]
    cut = {r.doc_id: r.text for r in STAGE["suffix_dedup"](spark, spark.createDataFrame(rows, DOCS), "").collect()}
    assert cut[0].split() == words("a", 30) + words("b", 30) and cut[1].split() == words("c", 30) + words("d", 30)
    assert [cut[i] for i in (2, 3, 4, 5, 6, 7)] == [*texts[2:5], "", "h", texts[7]]   # one's own words stay


@pytest.mark.parametrize("step", [1 << 20, 200])
def test_word_windows_in_several_documents_and_no_tables_left(spark, monkeypatch, step):
    rng = random.Random(step)
    monkeypatch.setattr(repeats, "STEP", step)
    texts = [" ".join(rng.choices(["a", "b", "cé", "\n", "\t"], k=rng.choice([0, 2, 12, 40, 120]))) for _ in range(40)]
    texts += [texts[7], None, " ".join(["lone"] * 30)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7])]
    words = [(t or "").split() for _, t in rows]
    held = {}
    for i, w in enumerate(words):
        for s in range(len(w) - 6):
            held.setdefault(tuple(w[s:s + 7]), set()).add(i)
    want = {}
    for i, (d, _) in enumerate(rows):
        want.setdefault(d, set()).update(p for s in range(len(words[i]) - 6) if len(held[tuple(words[i][s:s + 7])]) > 1 for p in range(s, s + 7))
    at = checkpoint_dir(spark)
    before = set(list_names(spark, at))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in repeats.word_spans(df, 7).collect():
        got.setdefault(r.d, set()).update(p for x in r.spans for p in range(x.lo, x.hi))
    assert got == {d: x for d, x in want.items() if x}
    repeats.remove_repeats(df, words=7).collect()
    ngram_join.keep_one(df).collect()
    assert not [x for x in set(list_names(spark, at)) - before if x.startswith("stage-") and list_names(spark, f"{at}/{x}")]


def test_word_runs_cover_every_window_once(monkeypatch):
    rng = random.Random(5)
    for step in (1 << 20, 200):
        monkeypatch.setattr(repeats, "STEP", step)
        texts = [" ".join(rng.choices("abcdef\n", k=n)).encode() for n in (0, 2, 10, 60, 300, 300)]
        runs = list(zip(*repeats.find_word_runs(texts, 13)))
        assert sorted((t, x) for t, s, m, *_ in runs for x in range(s, s + m)) == \
            [(t, x) for t, raw in enumerate(texts) for x in range(len(raw.split()) - 12)]
