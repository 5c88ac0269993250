"""Shards, caps and samples: exact sizes, partition independence."""

from pyspark.sql import functions as F

from tessera.operators import corpus, split
from tessera.operators.rowindex import with_row_index
from conftest import SF01


def lines(spark):
    return corpus.explode_lines(spark.read.parquet(f"{SF01}/documents.parquet"))


def test_row_index_dense_and_ordered(spark):
    df = lines(spark)
    idx = with_row_index(df, ["doc_id", "line_no"], "i", num_partitions=7)
    got = [(r.doc_id, r.line_no) for r in idx.orderBy("i").collect()]
    assert got == sorted(got)
    assert [r.i for r in idx.orderBy("i").collect()] == list(range(len(got)))


def test_row_index_groups(spark):
    df = split.assign_shard(lines(spark), 5)
    idx = with_row_index(df, ["doc_id", "line_no"], "pos", group_cols=["shard"], num_partitions=6)
    for r in idx.groupBy("shard").agg(F.min("pos").alias("a"), F.max("pos").alias("b"),
                                      F.count(F.lit(1)).alias("n")).collect():
        assert r.a == 0 and r.b == r.n - 1


def test_first_rows_index_equals_topk(spark):
    df = lines(spark)
    a = split.first_rows(df, 4321, ["doc_id", "line_no"], "index")
    b = split.first_rows(df, 4321, ["doc_id", "line_no"], "topk")
    assert sorted(a.collect()) == sorted(b.collect())


def test_shuffle_sample_exact_and_partition_free(spark):
    df = lines(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    a = sorted(split.shuffle_sample(df, 777, seed=9).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    b = sorted(split.shuffle_sample(df, 777, seed=9).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b and len(a) == 777
    brute = df.withColumn("k", F.lit(0)).orderBy(
        split.h60(F.lit(9), "doc_id", "line_no"), "doc_id", "line_no").limit(777)
    assert {(r.doc_id, r.line_no) for r in a} == {(r.doc_id, r.line_no) for r in brute.collect()}


def test_bootstrap_exact_k(spark):
    df = lines(spark)
    out = split.bootstrap_sample(df, 2000, seed=4)
    assert out.count() == 2000
    small = split.bootstrap_sample(df.limit(10), 50)
    assert small.count() == 10


def test_train_valid_disjoint(spark):
    df = split.train_valid_split(split.assign_shard(lines(spark), 32), 32)
    tr = {r.doc_id for r in df.where("split='train'").select("doc_id").distinct().collect()}
    va = {r.doc_id for r in df.where("split='valid'").select("doc_id").distinct().collect()}
    assert not tr & va and tr | va == {r.doc_id for r in lines(spark).select("doc_id").distinct().collect()}


def test_one_shard_rejected(spark):
    import pytest
    with pytest.raises(ValueError):
        split.assign_shard(lines(spark), 1)


def test_first_rows_prefix_equals_topk(spark):
    df = lines(spark)
    for n in (1, 37, 4321, 9343, 9344, 20000):
        a = split.first_rows(df, n, ["doc_id", "line_no"], "prefix")
        b = split.first_rows(df, n, ["doc_id", "line_no"], "topk")
        assert sorted(a.collect()) == sorted(b.collect()), n


def test_first_rows_prefix_hot_group(spark):
    # one document holds a third of the rows; the cut falls inside it
    rows = [(1, i, "h") for i in range(3000)] + [(d, 0, "x") for d in range(2, 6002)]
    df = spark.createDataFrame(rows, "doc_id long, line_no int, line string")
    a = split.first_rows(df, 1500, ["doc_id", "line_no"], "prefix")
    assert sorted(r.line_no for r in a.collect()) == list(range(1500))
    b = split.first_rows(df, 3500, ["doc_id", "line_no"], "prefix")
    assert b.count() == 3500 and b.where("doc_id = 1").count() == 3000


def test_positions_by_document_equal_index(spark):
    from tessera.operators.rowindex import positions_by_document
    df = corpus.nonempty_lines(corpus.explode_lines(
        spark.read.parquet(f"{SF01}/documents.parquet"), normalize=True))
    df = split.assign_shard(df, 4).where("line_no % 3 <> 1")     # gaps inside documents
    a = positions_by_document(df, "shard", "doc_id", "line_no", "pos")
    b = with_row_index(df, ["doc_id", "line_no"], "pos", group_cols=["shard"])
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_bootstrap_draws_the_numbered_rows(spark, monkeypatch):
    rows = [(None, 0, "n0"), (None, 1, "n1")] + [(5, i, f"hot{i}") for i in range(400)] + \
        [(d, i, f"{d}.{i}") for d in range(6, 200) for i in range(d % 4)]
    df = spark.createDataFrame(rows, "doc_id long, line_no int, line string").repartition(5)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    draws = spark.range(300).select("id", (split.h60(F.lit(9), "id") % len(rows)).alias("at")).collect()
    want = {(r.id, *order[r.at]) for r in draws}
    for bound in (1 << 20, 10):  # with and without groups that are numbered by range partitions
        monkeypatch.setattr(split, "GROUP_ROWS", bound)
        out = split.bootstrap_sample(df, 300, seed=9)
        assert out.columns == ["draw", "doc_id", "line_no", "line"]
        assert {tuple(r) for r in out.collect()} == want
    one = df.select("line").distinct()
    assert split.bootstrap_sample(one, 50, ["line"], seed=9).count() == 50
    assert split.bootstrap_sample(df.limit(0), 5).count() == 0


def test_staged_samples_equal(spark):
    df = lines(spark)
    order = ["doc_id", "line_no"]
    assert sorted(split.max_samples(df, 500, order, staged=True).collect()) == sorted(split.max_samples(df, 500, order).collect())
