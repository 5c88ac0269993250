"""Empty inputs and caps larger than the data."""

from tessera.operators import dedup, encode as E, split
from tessera.operators.rowindex import with_row_index


def lines(spark, n):
    return spark.createDataFrame([(i // 3, i % 3, f"l{i % 7}") for i in range(n)],
                                 "doc_id long, line_no int, line string")


def test_row_index_empty(spark):
    assert with_row_index(lines(spark, 0), ["doc_id", "line_no"]).count() == 0


def test_caps_larger_than_data(spark):
    df = lines(spark, 20)
    assert split.first_rows(df, 100, ["doc_id", "line_no"], "index").count() == 20
    assert split.shuffle_sample(df, 100).count() == 20
    assert split.bootstrap_sample(df, 100).count() == 20
    assert split.shuffle_sample(df, 0).count() == 0


def test_samples_on_empty(spark):
    df = lines(spark, 0)
    assert split.shuffle_sample(df, 5).count() == 0
    assert split.bootstrap_sample(df, 5).count() == 0


def test_dedup_on_empty(spark):
    df = spark.createDataFrame([], "shard int, pos long, sentence string")
    assert dedup.dedup_lru(df, 3).count() == 0
    assert dedup.dedup_recent(df, 3).count() == 0


def test_batches_smaller_than_one_batch(spark):
    df = spark.createDataFrame([(0, 3), (1, 5)], "row_id long, length int")
    out = E.length_batches(df, 32, seed=1).collect()
    assert sorted(r.batch_id for r in out) == [0, 0]
