"""Sources, spans and the corpus recipes."""

import gzip
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.keyed import h60
from tessera.operators import corpus
from tessera.plans import recipes
from tessera.sources import readers
from conftest import SF001


def test_paragraph_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p.txt")
    with open(path, "w") as f:
        f.write("a1\na2\n\nb1\n  \nc1\nc2\n\n\nd1\n")
    got = [list(r.lines) for r in readers.read_paragraphs(spark, path)
           .orderBy("record_id", "para_no").collect()]
    assert got == [["a1", "a2"], ["b1"], ["c1", "c2"], ["d1"]]


def test_paragraph_file_end_ends_paragraph(spark, tmp_dir):
    for name, body in (("a.txt", "x1\nx2"), ("b.txt", "y1\n")):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(body)
    got = sorted(tuple(r.lines) for r in readers.read_paragraphs(spark, tmp_dir).collect())
    assert got == [("x1", "x2"), ("y1",)]


def test_read_lines_gzip_and_glob(spark, tmp_dir):
    with gzip.open(os.path.join(tmp_dir, "a.txt.gz"), "wt") as f:
        f.write("l1\nl2\r\nl3\rl4\n")
    with open(os.path.join(tmp_dir, "noext"), "w") as f:
        f.write("skipped\n")
    got = sorted(r.line for r in readers.read_lines(spark, tmp_dir).collect())
    assert got == ["l1", "l2", "l3", "l4"]


def test_read_lines_rejects_xz(spark, tmp_dir):
    import pytest
    with pytest.raises(ValueError):
        readers.read_lines(spark, os.path.join(tmp_dir, "x.txt.xz"))


def test_json_docs_and_corrupt(spark, tmp_dir):
    path = os.path.join(tmp_dir, "d.json")
    with open(path, "w") as f:
        f.write('{"index": {"_id": 1}}\n{"title":"T","text":"abc"}\n{"title":"U","text":""}\n{broken\n')
    docs = readers.read_json_docs(spark, path).collect()
    assert [(r.title, r.text) for r in docs] == [("T", "abc")]
    r = readers.json_doc_stats(spark, path).first()
    assert (r.n_lines, r.n_docs, r.n_corrupt) == (4, 1, 1)


def test_dataset_formats(spark, tmp_dir):
    spark.createDataFrame([("a", 1)], "text string, n int").write.csv(os.path.join(tmp_dir, "c"), header=True)
    train, _ = readers.read_dataset(spark, os.path.join(tmp_dir, "c"))
    assert readers.text_column(train).first()[0] == "a"
    spark.createDataFrame([(7, "z")], "id int, body string").write.json(os.path.join(tmp_dir, "j"))
    train, _ = readers.read_dataset(spark, os.path.join(tmp_dir, "j"))
    assert readers.text_column(train).columns == ["text"]


def test_spans_given_draws(spark):
    docs = spark.createDataFrame([(1, "abcdefghij")], "doc_id int, text string")
    draws = spark.createDataFrame([(1, 0, 5), (1, 1, 3), (1, 2, 4), (1, 3, 4)],
                                  "doc_id int, span_no int, r int")
    got = [(r.span_len, r.span) for r in corpus.cut_spans(docs, draws, 3).orderBy("span_no").collect()]
    assert got == [(5, "abcde"), (3, "fgh")]


def test_random_spans_match_loop(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    lo, hi = 7, 30
    spans = corpus.random_spans(docs, lo, hi, seed=3)
    draw = {(r.doc_id, r.i): r.r for r in docs.select(
        "doc_id", F.explode(F.sequence(F.lit(0), F.ceil(F.length("text") / lo).cast("int") - 1)).alias("i"))
        .withColumn("r", lo + h60(F.lit(3), "doc_id", "i") % (hi - lo + 1)).collect()}
    got = {}
    for r in spans.collect():
        got.setdefault(r.doc_id, []).append((r.span_no, r.span))
    for d in docs.collect():
        want, start, i = [], 0, 0
        while len(d.text) - start >= lo:
            n = min(draw[(d.doc_id, i)], len(d.text) - start)
            want.append(d.text[start:start + n])
            start += n
            i += 1
        assert [s for _, s in sorted(got.get(d.doc_id, []))] == want


def test_corpus_plain_invariants(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = recipes.corpus_plain(docs, num_files=8, seed=5)
    per_doc = out.groupBy("doc_id").agg(F.countDistinct("shard").alias("s"), F.countDistinct("split").alias("p"))
    assert per_doc.where("s > 1 or p > 1").count() == 0
    assert out.where("(shard = 7) <> (split = 'valid')").count() == 0
    lines = corpus.nonempty_lines(corpus.explode_lines(docs)).count()
    assert out.count() == lines


def test_corpus_plain_valid_cap_exact(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = recipes.corpus_plain(docs, num_files=4, max_valid_sentences=50, seed=1)
    assert out.where("split = 'valid'").count() == 50


def test_corpus_wiki_from_json_dump(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dump.json")
    with open(path, "w") as f:
        f.write('{"index": {}}\n{"title": "T", "text": "A > T Hello there, world! Second [1]one?"}\n'
                '{"index": {}}\n{"title": "U", "text": "Hello there, world! Again and again."}\n')
    docs = readers.read_json_docs(spark, path)
    out = recipes.corpus_wiki(docs, num_files=2).orderBy("doc_id", "sent_no").collect()
    assert [r.sentence for r in out] == ["Hello there, world!", "Second one?", "Again and again."]


def test_corpus_wiki_lru_mode_large_cache_is_first_per_shard(spark):
    from pyspark.sql import Window
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(
        "doc_id", F.col("lang").alias("title"), "text")
    got = recipes.corpus_wiki(docs, num_files=3, dedup_mode="lru", cache_len=10 ** 6)
    allrows = recipes.corpus_wiki(docs, num_files=3, dedup_mode="none")
    w = Window.partitionBy("shard", "sentence").orderBy("doc_id", "sent_no")
    want = allrows.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.count() < allrows.count()


def test_random_spans_repeated_ids_are_cut_apart(spark):
    docs = spark.createDataFrame([(1, "a" * 20), (1, "b" * 20)], "doc_id long, text string")
    spans = corpus.random_spans(docs, 5, 5, seed=3).collect()
    assert sorted((r.span_no, r.start, r.span) for r in spans) == sorted(
        (i, 5 * i, c * 5) for i in range(4) for c in "ab")
    assert "Exchange" not in corpus.random_spans(docs, 5, 5)._jdf.queryExecution().executedPlan().toString()


def test_paragraphs_of_all_line_ends(spark, tmp_dir):
    for i, end in enumerate(["\n", "\r\n", "\r"]):
        with open(os.path.join(tmp_dir, f"{i}.txt"), "w", newline="") as f:
            f.write(end.join(["a", "b", "", "  ", "c", ""]))
    got = sorted(tuple(r.lines) for r in readers.read_paragraphs(spark, tmp_dir).collect())
    assert got == sorted([("a", "b"), ("c",)] * 3)


SMALL_SPLITS = {"spark.sql.files.maxPartitionBytes": "1024", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in SMALL_SPLITS}
    for k, v in SMALL_SPLITS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def brute_paragraphs(text):
    out, run = [], []
    for line in [*text.replace("\r\n", "\n").replace("\r", "\n").split("\n"), ""]:
        if line.strip():
            run.append(line)
        elif run:
            out.append(run)
            run = []
    return out


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_paragraphs_across_splits(spark, tmp_dir, small_splits, end):
    rng = random.Random(len(end))
    want, numbered = [], []
    for name in ("b.txt", "a.txt", "c.txt"):
        lines = []
        for _ in range(12):
            lines += [rng.choice(["x", "é" * 9, "long " * 40, " y "]) + str(rng.random()) for _ in range(rng.choice([1, 2, 9, 30]))]
            lines += [rng.choice(["", " ", "\t"])] * rng.choice([1, 1, 3])
        text = end.join([*rng.choice([[], ["", " "]]), *lines, *rng.choice([[], ["tail"]])])
        with open(os.path.join(tmp_dir, name), "w", newline="") as f:
            f.write(text)
        own = brute_paragraphs(text)
        want += own
        numbered.append((name, own))
    paras = readers.read_paragraphs(spark, tmp_dir)
    assert spark.read.text(tmp_dir).rdd.getNumPartitions() > 12
    assert sorted(list(r.lines) for r in paras.collect()) == sorted(want)
    in_order = [list(r.lines) for r in paras.orderBy("file", "record_id", "para_no").collect()]
    numbered.sort()
    assert in_order == [p for _, own in numbered for p in own]
    got = recipes.corpus_plain_files(spark, tmp_dir, 4).collect()
    docs = [[line.strip() for line in p] for _, own in numbered for p in own]
    assert sorted((r.doc_id, r.line_no, r.line) for r in got) == [(i, j, line) for i, p in enumerate(docs) for j, line in enumerate(p)]
    assert all(r.split == ("valid" if r.shard == 3 else "train") for r in got)


def test_line_runs_across_batches():
    rng = random.Random(8)
    for _ in range(60):
        rows, want = [], []
        for file, block in [("a", 0), ("a", 90), ("b", 0)][:rng.randint(1, 3)]:
            lines = [rng.choice(["", " \u3000", "\x1f", "x", " é ", "yy"]) for _ in range(rng.randint(1, 12))]
            rows += [(file, block, x) for x in lines]
            runs = [[]]
            for x in lines:
                runs[-1].append(x) if x.strip() else runs.append([])
            kept = [(i, r) for i, r in enumerate(runs) if r or i in (0, len(runs) - 1)]
            want += [(file, block, n, [x.strip() for x in r], i == 0, i == len(runs) - 1) for n, (i, r) in enumerate(kept)]
        cuts = sorted({0, len(rows), *(rng.randint(0, len(rows)) for _ in range(4))})
        batches = [pa.record_batch([pa.array(c) for c in zip(*rows[i:j])], names=["file", "record_id", "value"]) for i, j in zip(cuts, cuts[1:])]
        got = [tuple(r.values()) for ends in (False, True) for b in readers._line_runs(batches, ends, T.normalize_line_arrow) for r in b.to_pylist()]
        assert sorted(got) == sorted(want)


def test_plain_files_are_read_once_for_their_lines(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.txt"), "w") as f:
        f.write("a\n b\n\nc\n")
    out = recipes.corpus_plain_files(spark, tmp_dir, 4)
    assert sorted((r.doc_id, r.line_no, r.line) for r in out.collect()) == [(0, 0, "a"), (0, 1, "b"), (1, 0, "c")]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan text") == 1 and "regexp" not in plan


def test_paragraphs_of_nothing(spark, tmp_dir):
    for name, text in (("a.txt", ""), ("b.txt", "\n \r\n\t"), ("c.txt", "x")):
        with open(os.path.join(tmp_dir, name), "w", newline="") as f:
            f.write(text)
    assert [list(r.lines) for r in readers.read_paragraphs(spark, tmp_dir).collect()] == [["x"]]


def test_rows_are_numbered_by_file_name_and_place(spark, tmp_dir, small_splits):
    # the larger file is scanned first, but its name comes last
    files = {"a.txt": ["a0"], "b.txt": [f"b{i}" for i in range(500)], "0.txt": ["z"] * 3}
    for name, lines in files.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("\n".join(lines))
    got = recipes.index_rows(readers.read_lines(spark, tmp_dir)).orderBy("row_id").collect()
    want = [line for name in sorted(files) for line in files[name]]
    assert [r.row_id for r in got] == list(range(len(want))) and [r.line for r in got] == want
    kept = recipes.index_rows(readers.read_lines(spark, tmp_dir).where("line <> 'b7' AND line <> 'z'"), "n").orderBy("n").collect()
    assert [(r.n, r.line) for r in kept] == list(enumerate(x for x in want if x not in ("b7", "z")))
    plan = recipes.index_rows(readers.read_lines(spark, tmp_dir))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "BroadcastHashJoin" in plan
    rows = spark.createDataFrame([("q",), ("r",)], "line string")
    assert sorted(r.row_id for r in recipes.index_rows(rows).collect()) == [0, 1]
    with open(os.path.join(tmp_dir, "d.json"), "w") as f:
        f.write("\n".join(f'{{"title":"t","text":"{x}"}}' for x in range(9)))
    docs = recipes.index_rows(readers.read_json_docs(spark, os.path.join(tmp_dir, "d.json")), "doc_id").orderBy("doc_id").collect()
    assert [r.text for r in docs] == [str(x) for x in range(9)]
