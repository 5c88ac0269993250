"""Metrics (crafted values), sinks (round trips) and the entry contract."""

import math
import os

from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators import vocab as V
from tessera.sources import sinks



def test_accuracy_crafted(spark):
    df = spark.createDataFrame([(0, 1, 1), (0, 2, 3), (1, 7, -100)], "batch_id int, pred int, label int")
    assert M.masked_accuracy(df).first().accuracy == 0.5
    r = M.accuracy_by_batch(df).first()
    assert r.accuracy == 0.5 and r.n_scored == 2


def test_perplexity_crafted(spark):
    assert M.perplexity(spark.createDataFrame([(0.0,)], "loss double")).first().perplexity == 1.0
    assert math.isinf(M.perplexity(spark.createDataFrame([(1000.0,)], "loss double")).first().perplexity)


def test_argmax_ties_and_loss(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0], 1)], "logits array<double>, label int")
    r = df.select(M.argmax("logits").alias("a"), M.token_loss("logits", "label").alias("l")).first()
    lse = math.log(math.exp(1) + 2 * math.exp(3))
    assert r.a == 1 and abs(r.l - (lse - 3.0)) < 1e-12


def test_write_shards_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("train", 0, "a"), ("train", 1, "b"), ("valid", 2, "c")],
                               "split string, shard int, line string")
    path = os.path.join(tmp_dir, "out")
    sinks.write_shards(df, path, 3)
    sinks.write_shards(df.limit(1), path, 3, mode="append")
    back = sorted((r.split, r.shard, r.line) for r in sinks.read_shards(spark, path).collect())
    assert back == [("train", 0, "a"), ("train", 0, "a"), ("train", 1, "b"), ("valid", 2, "c")]


def test_vocab_round_trip(spark, tmp_dir):
    vocab = V.with_special_tokens(spark.createDataFrame([("b",), ("a",), ("##a",)], "piece string"))
    f = sinks.write_vocab(vocab, os.path.join(tmp_dir, "vocab"))
    with open(f) as fh:
        lines = fh.read().split("\n")
    assert lines[:5] == ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"] and lines[15:18] == ["##a", "a", "b"]
    back = V.load_vocab(spark, f).orderBy("token_id").collect()
    assert [(r.token_id, r.piece) for r in back] == [(r.token_id, r.piece)
                                                     for r in vocab.orderBy("token_id").collect()]


def test_cached_stage_reused(spark, tmp_dir):
    path = os.path.join(tmp_dir, "stage")
    src = os.path.join(tmp_dir, "src")
    spark.range(3).write.parquet(src)
    stamp = lambda: {f: os.stat(os.path.join(d, f)).st_mtime_ns
                     for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}
    assert sinks.cached_stage(spark.read.parquet(src), path).count() == 3
    first = stamp()
    assert sinks.cached_stage(spark.read.parquet(src), path).count() == 3 and stamp() == first   # reused
    assert sinks.cached_stage(spark.read.parquet(src).where("id > 0"), path).count() == 2        # another plan
    spark.range(5).write.mode("overwrite").parquet(src)
    assert sinks.cached_stage(spark.read.parquet(src), path).count() == 5                        # other files
    local = lambda n: spark.createDataFrame([(i,) for i in range(n)], "id long")
    assert [sinks.cached_stage(local(n), path).count() for n in (2, 4)] == [2, 4]
    assert [sinks.cached_stage(local(n), path, key="k").count() for n in (2, 4)] == [2, 2]
    assert sinks.cached_stage(local(4), path, overwrite=True, key="k").count() == 4


def test_cached_stage_tells_wide_plans_and_python_code_apart(spark, tmp_dir):
    from pyspark.sql import functions as F
    src, path = f"{tmp_dir}/src", f"{tmp_dir}/stage"
    spark.range(3).write.parquet(src)
    limit = spark.conf.get("spark.sql.debug.maxToStringFields")
    wide = lambda last: spark.read.parquet(src).select(*[(F.col("id") + (i if i < 36 else last * i)).alias(f"c{i}") for i in range(41)])
    assert [sinks.cached_stage(wide(n), path).agg(F.max("c40")).first()[0] for n in (1, 2)] == [42, 82]
    assert sinks.fingerprint(wide(1)) == sinks.fingerprint(wide(1)) != sinks.fingerprint(wide(2))
    assert spark.conf.get("spark.sql.debug.maxToStringFields") == limit

    def mapped(n):
        def add(batches):
            for b in batches:
                yield b.assign(id=b["id"] + n)
        return spark.read.parquet(src).mapInPandas(add, "id long")
    assert [sinks.cached_stage(mapped(n), path).agg(F.max("id")).first()[0] for n in (1, 2)] == [3, 4]


def test_write_shards_keeps_order_by_default(spark, tmp_dir):
    rows = [("train", 0, 0, i, f"{i:03d}") for i in range(200)]
    df = spark.createDataFrame(rows, "split string, shard int, doc_id long, sent_no int, sentence string")
    path = os.path.join(tmp_dir, "ordered")
    sinks.write_shards(df.repartition(8), path, 1, files_per_shard=1)
    folder = os.path.join(path, "split=train", "shard=0")
    (part,) = [f for f in os.listdir(folder) if f.startswith("part-")]
    with open(os.path.join(folder, part)) as fh:
        assert fh.read().split() == [r[4] for r in rows]


def test_write_metrics(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m")
    sinks.write_metrics(spark.createDataFrame([(0.5,)], "accuracy double"), path, "valid")
    assert spark.read.json(path).first().split == "valid"


def test_entry_contract(spark):
    import __spark_entry__ as entry
    out = entry.entry(spark)
    assert out.count() > 0
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 40


def test_write_shards_salted_keeps_documents_whole(spark, tmp_dir):
    rows = [("train", 0, d, i, f"d{d}l{i}") for d in range(40) for i in range(3)]
    df = spark.createDataFrame(rows, "split string, shard int, doc_id long, line_no int, line string")
    path = os.path.join(tmp_dir, "salted")
    sinks.write_shards(df, path, 2, order_cols=["doc_id", "line_no"], files_per_shard=4)
    files = [f for f in os.listdir(os.path.join(path, "split=train", "shard=0")) if f.startswith("part-")]
    assert len(files) > 1
    seen = {}
    for f in files:
        with open(os.path.join(path, "split=train", "shard=0", f)) as fh:
            for line in fh.read().split():
                doc = line.split("l")[0]
                seen.setdefault(doc, set()).add(f)
    assert len(seen) == 40 and all(len(v) == 1 for v in seen.values())
