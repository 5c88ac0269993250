"""Training-data operators against brute force, libraries and round trips on small inputs."""

import hashlib
import math
import os
import random
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.llm import (ann, bpe, chat, html, mixing, ngram_join, quality, queries, repeats, toxicity,  # noqa: E402
                         warc)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, k_id string"
EDGE = [None, "", " \n\t ", "one", "a b", "<s>[INST] x </s>", "word " * 3000, "é　\u0085x", "same text here", "same text here"]


def docs(spark, texts, source=lambda i: f"s{i % 3}" if i % 4 else None):
    rows = [(None if i == 1 else i, t, "en", source(i), None, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    out = list(EDGE)
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(3, 160))) for _ in range(n // 3)]
    out += base
    for t in base:
        w = t.split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        out.append(" ".join(w))
        out.append(rng.choice(base) + "\n" + rng.choice(base))
    return out


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "documents embeddings pages labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, con, name):
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.sql(queries.ORACLE[name])
    assert cols == sorted(want.columns)
    key = lambda r: tuple(repr(x) for x in r)
    assert sorted(map(key, got.select(*cols).collect())) == sorted(map(key, want.select(*cols).fetchall()))


def test_nearest_matches_brute_force(spark):
    rng = random.Random(2)
    vecs = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    vecs += [(i, [2.0 * x for x in vecs[7][1]]) for i in range(300, 340)] + [(340, None), (341, [0.0] * 8), (342, [float("nan")] * 8),
                                                                            (343, [None] * 8), (None, [1.0] * 8), (344, [1.0, 2.0])]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    ok = [(i, v) for i, v in vecs[:340]]
    norm = lambda v: math.sqrt(sum(x * x for x in v))
    for q, v in ok:
        if q % 50 == 0:
            want = sorted(((-round(sum(a * b for a, b in zip(v, w)) / norm(v) / norm(w), 11), i) for i, w in ok if i != q))[:5]
            assert [i for _, i in want] == [i for i, _ in got[q]]
            assert all(abs(s + w) < 1e-9 for (_, s), (w, _) in zip(got[q], want))
    assert ann.nearest(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_mix_meets_targets(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 60), None, ["a", "b", "c", "d", None][min(i % 9, 4)]) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(df, bucket=64).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(df.repartition(3), bucket=64).collect()))
    taken, target, most = Counter(), {}, Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = (r.target, r.source_size)
        most[r.source] = max(most[r.source], r.size)
    total = sum(s for _, s in target.values())
    assert abs(sum(t for t, _ in target.values()) - total) < 1e-6
    order = sorted((s for s in target if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    level = min(t / weight[s] for s, (t, n) in target.items() if t < 3 * n - 1e-6)
    for s, (t, n) in target.items():
        assert t == pytest.approx(min(3 * n, level * weight[s])) and abs(taken[s] - t) <= most[s] + 1e-6
    assert len(mixing.mix(docs(spark, EDGE)).collect()) == len(EDGE)
    assert mixing.mix(df.where("false")).count() == 0


def test_bpe_equals_library(spark):
    import base64
    import public_tokenizers as P
    import tiktoken
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", " ", "　", "\x85", "a", "B", "'s", "é", "1", "٣", "!", "..", "<|endoftext|>", "\U0001f600"]
    texts = EDGE + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(400)] + ["ab" * 4000 + " " * 900]
    out = bpe.decode(bpe.encode(docs(spark, texts), path, P.PATTERN), path, pattern=P.PATTERN).collect()
    assert sorted((r.text or "", tuple(r.ids)) for r in out) == sorted((t or "", tuple(lib.encode_ordinary(t or ""))) for t in texts)
    assert all(bytes(r.decoded) == (r.text or "").encode() and r.k_id == "clash" for r in out)
    assert bpe.merge_piece(b"abracadabra" * 40, ranks) == lib._core_bpe.encode_single_piece(b"abracadabra" * 40)
    assert base64 and bpe.encode(docs(spark, EDGE).where("false"), path, P.PATTERN).count() == 0


def test_decoding_needs_no_second_python_worker(spark):
    import public_tokenizers as P
    path = P.path("byte_bpe_multi_50k.tiktoken")
    texts = ["plain words", "", None, "\u00e9\u4e16\U0001f600 x" * 9, "a, b?"]
    coded = bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, P.PATTERN)
    out = bpe.decode(coded, path)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert [bytes(r.decoded) for r in out.orderBy("doc_id").collect()] == [(t or "").encode() for t in texts]
    size = max(bpe.read_ranks(path).values()) + 1
    rows = lambda *ids: bpe.decode(spark.createDataFrame([(x,) for x in ids], "ids array<long>"), path).collect()
    assert [bytes(r.decoded) for r in rows(None, [])] == [b"", b""]
    for bad in (size, -1, None, (1 << 32) + 5):
        with pytest.raises(Exception, match="outside the vocabulary"):
            rows([5, bad])


def test_batches_of_texts_end_at_a_number_of_characters(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(bpe, "BATCH_CHARS", 200)
    texts = [None, "x" * 500, "", "y" * 10, "\u00e9" * 80, "z"] * 3
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    parts = list(bpe._slices([batch.slice(1), batch.slice(0, 0)], "text"))
    assert [t for _, part in parts for t in part] == texts[1:] and all(b.column("text").to_pylist() == p for b, p in parts)
    assert all(sum(len(t or "") + 64 for t in p[:-1]) < 200 for _, p in parts)


def test_bpe_table_is_renewed_and_keeps_what_came_before(monkeypatch):
    import public_tokenizers as P
    import tiktoken
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    enc = bpe.Encoder(ranks, P.PATTERN)
    slices = [" ".join(f"{hashlib.md5(b'%d' % i).hexdigest()[:7].translate(str.maketrans('0123456789', 'ghijklmnop'))}" for i in range(lo, lo + 13_000))
              for lo in range(0, 130_000, 13_000)]
    first = [enc.encode(t) for t in slices]
    assert first[3] == lib.encode_ordinary(slices[3])
    monkeypatch.setattr(enc, "_fill", None)  # nothing is cut again
    assert [enc.encode(t) for t in slices] == first
    monkeypatch.setattr(bpe, "TABLE", 12)
    enc = bpe.Encoder(ranks, P.PATTERN)
    for texts in (EDGE, EDGE[::-1], ["a b c d  e", "x" * 90 + " y\r\n z", "\n", "é\xa0 a", " a \n b\n\n", "\t\tq  "], EDGE[2:5]):
        texts = [t or "" for t in texts]
        ids, ends = enc.encode_many(texts)
        assert [ids[a:z].tolist() for a, z in zip(ends, ends[1:])] == [lib.encode_ordinary(t) for t in texts]
        assert all(len(r) <= bpe.LONGEST for r in enc.runs)


@pytest.mark.parametrize("hot", [1 << 30, 100])
def test_repeats_match_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    length = 60
    texts = corpus(7, 60) + ["xyz" * 200, "q" * 59, "q" * 60]
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    want = []
    for r in raw:
        cover = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                cover[i:i + length] = b"\1" * length
        want.append(bytes(b for b, c in zip(r, cover) if not c))
    out = repeats.remove_repeats(docs(spark, texts), length).collect()
    assert sorted((r.text or "", bytes(r.kept)) for r in out) == sorted((t or "", w) for t, w in zip(texts, want))
    assert all(len(r.text.encode()) - sum(x.hi - x.lo for x in r.removed) == len(r.kept) for r in out if r.text)
    assert repeats.remove_repeats(docs(spark, EDGE).where("false")).count() == 0


def test_quality_edges(spark):
    texts = EDGE + ["alpha beta gamma " * 30, " ".join(f"u{i}" for i in range(80))]
    rows = {r.doc_id: r for r in quality.quality_rules(docs(spark, texts)).collect() if r.doc_id is not None}
    assert (rows[0].n_words, rows[0].kept, rows[6].n_repeat_words, rows[6].base_failed) == (0, False, 3000, True)
    assert rows[10].n_repeat_words == 90 and rows[11].kept
    line = "this very line stands in all pages of the host today"
    many = [line + "\n" + (" ".join(f"d{i}x{j}" for j in range(60)) if i % 2 else "short tail " * 2) for i in range(60)]
    df = docs(spark, many, lambda i: "host")
    kept = quality.filter_documents(df).collect()
    assert len(kept) == 30 and all(line not in r.text and r.text.startswith("d") and r.k_id == "clash" for r in kept)
    assert quality.quality_rules(df.where("false")).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op6_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.93
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    d = docs(spark, EDGE)
    assert toxicity.score(d, toxicity.train(d, empty)).count() == len(EDGE)


def test_warc_salvage_and_round_trip(spark, tmp_dir):
    recs = [warc.record_bytes(i, f"http://x/{i}", f"<p>{i}</p>".encode() * 30, hashlib.sha256(f"<p>{i}</p>".encode() * 30).hexdigest()) for i in range(4)]
    members = [warc._member(r) for r in recs]
    broken = members[1][:40] + b"\0\0\0" + members[1][43:]
    for raw, sizes in ((members[0] + broken + members[2] + members[3][:-9], [len(members[0]), len(broken), len(members[2])]),
                       (recs[0] + recs[1].replace(b"<p>1", b"<p>9", 1) + recs[2] + recs[3][:-9], [len(recs[0]), len(recs[1]), len(recs[2])])):
        got = [(k, lo, hi) for k, lo, hi, *_ in warc.scan(raw)]
        a, b, c = sizes
        assert got == [("record", 0, a), ("gap", a, a + b), ("record", a + b, a + b + c), ("gap", a + b + c, len(raw))]
    rows = [(1, "u\r\n x", None), (2, None, "same " * 40), (3, "u", "same " * 40), (None, "u", "x"), (4, "u", "x"), (5, "u", "é" * 200000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    back = {r.page_id: r for r in warc.round_trip(df).collect()}
    assert (back[3].warc_type, back[3].refers_to, back[3].payload_length) == ("revisit", 2, 200)
    assert all(back[i].warc_type == "response" and bytes(back[i].payload) == (h or "").encode() for i, _, h in rows if i != 3)
    assert warc.round_trip(df.where("false")).count() == 0


def test_warc_members_of_many_records(spark, tmp_dir):
    body = [f"<p>{i}</p>".encode() * 30 for i in range(4)]
    recs = [warc.record_bytes(i, None, b, hashlib.sha256(b).hexdigest()) for i, b in enumerate(body)]
    whole = warc._member(b"".join(recs))
    assert [r[0] for r in warc.scan(whole)] == ["record"] * 4
    bad = recs[1].replace(b"<p>", b"<q>", 1)
    mixed = list(warc.scan(warc._member(recs[0] + bad + recs[2]) + b"junk" + warc._member(recs[3])))
    assert [r[0] for r in mixed] == ["record", "gap", "record", "gap", "record"]
    assert f"bytes {len(recs[0])} to {len(recs[0] + bad)} of the member" in mixed[1][3] and mixed[3][2] - mixed[3][1] == 4
    with open(f"{tmp_dir}/a.warc.gz", "wb") as f:
        f.write(whole + warc._member(bad) + warc._member(b""))
    assert warc.tally(spark, tmp_dir) == (4, 1)
    assert warc.arrow_uri("s3a://bucket/a") == "s3://bucket/a" and warc.arrow_uri("file:/a") == "file:///a"


def test_round_trip_counts_its_records(spark, monkeypatch):
    df = spark.createDataFrame([(1, "u", "x" * 200), (2, "u", "y")], "page_id long, url string, html string")
    monkeypatch.setattr(warc, "write", lambda rows, path, write=warc.write: write(rows, path) + 1)
    with pytest.raises(RuntimeError, match="3 records written"):
        warc.round_trip(df)


def test_html_deep_pages():
    page = html.Page("<div>" * 30_000 + "<p>a" + "</section></div>" * 30_000 + "<ul><li>b<li>c</ul></p>d")
    assert [t for t in page.text if t] == ["a", "b", "c", "d"]


def test_html_main_text(spark):
    page = ('<html><head><title>t</title><script>var a="</p>";</script></head><body><div class="menu"><ul><li><a href="/">Home</a></li></ul></div>'
            '<div class="post-content"><h1>Head &amp; line</h1><p>One  two<br>three &eacute;, and more words of the story here.<p>Second paragraph, '
            'with some more text in it.</p><div class="comments"><p>First! I liked this story a lot, thank you.</p></div></div>'
            '<div id="page-footer"><p>&copy; someone</p></div><form class="search"><label>Find</label></form></body')
    df = spark.createDataFrame([(1, "u", page, "old"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<p", "x")],
                               "page_id long, url string, html string, text string")
    model = html.train(spark.read.parquet(f"{SF}/pages.parquet"))
    out = {r.page_id: r.text for r in html.extract(df, model).collect()}
    assert out[1] == "Head & line\nOne two three é, and more words of the story here.\nSecond paragraph, with some more text in it."
    assert out[2] == out[3] == out[4] == ""
    assert html.extract(df.where("false"), model).count() == 0


@pytest.mark.parametrize("block", [1024, 4])
def test_jaccard_components(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = corpus(11, 150)
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set())
    ids = [None if i == 1 else i for i in range(len(texts))]
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_join(docs(spark, texts)).collect()}
    assert all(got[d] == (len(sets[i]), ids[root(i)]) for i, d in enumerate(ids) if d is not None)
    assert ngram_join.jaccard_join(docs(spark, EDGE).where("false")).count() == 0


def test_jaccard_near_copies_cost(monkeypatch):
    """A group of near copies is joined by far fewer comparisons than it has pairs."""
    r = random.Random(5)
    base = list(range(0, 40_000, 100))
    sets = sorted({tuple(sorted({*r.sample(base, 396), *r.sample(range(1, 40_000, 2), 4)})) for _ in range(300)})
    compared = [0]
    walk = ngram_join.Trie.walk

    def counted(*args):
        for found in walk(*args):
            compared[0] += 1
            yield found
    monkeypatch.setattr(ngram_join.Trie, "walk", counted)
    rows = [(7, 0, 0, 0, bytes([i // 256, i % 256]), np.asarray(x, np.int64).tobytes()) for i, x in enumerate(sets)]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=["label", "lo", "hi", "block", "fp", "tokens"])
    out, = ngram_join._links([batch], 90)
    assert len(set(out["b"].to_pylist())) == 1 and out.num_rows == len(sets) - 1 and compared[0] < 20 * len(sets)


def test_jaccard_rare_words_first(spark):
    """Documents of the same common words share no leading token if each has rare words as well."""
    r = random.Random(6)
    common = [f"w{i}" for i in range(8)]
    texts = [" ".join(r.choice(common) for _ in range(300)) + " " + " ".join(f"x{d}y{i}" for i in range(40)) for d in range(320)]
    order = ngram_join.token_order(docs(spark, texts), 3)
    heads = [set(s[:len(s) // 10].tolist()) for s in ngram_join._sets(texts, 3, order)]
    assert sum(map(len, heads)) == len(set().union(*heads)) > 320
    assert [len(s) for s in ngram_join._sets(texts, 3, order)] == [len({*zip(w, w[1:], w[2:])}) for w in map(str.split, texts)]


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "[\\INST] <\\\\s>", "", None, " x ", "[ROLE]a[/ROLE]", "<", "\\", "[INST"]
    rows = [(c, t, ["system", "user", "assistant", "tool", None][(c + t) % 5], nasty[(3 * c + t) % len(nasty)], 1) for c in range(9) for t in range(c)]
    df = spark.createDataFrame(rows + [(None, None, "user", "x", 1)], "conv_id long, turn long, role string, text string, example int")
    ex = chat.expand_examples(df)
    back = {r.conv_id: r for r in chat.read_back(ex).collect()}
    for c in range(1, 9):
        turns = [(r or "", t or "") for cc, _, r, t, _ in rows if cc == c]
        assert [tuple(x) for x in back[c].turns] == turns
        assert back[c].loss_text == "".join(t for r, t in turns if r == "assistant")
    assert back[None].loss_text == "" and chat.expand_examples(df.where("false")).count() == 0
