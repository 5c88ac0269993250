"""Dense row positions without a single-task window.

``with_row_index`` numbers rows 0, 1, 2, ... in the order of ``order_cols``
(optionally restarting per value of ``group_cols``):

1. range-partition on the keys and sort inside each partition;
2. ``checkpoint()`` into the session's checkpoint folder, which fixes the
   partitioning (a recomputation could otherwise sample other bounds) and cuts
   the lineage;
3. count rows per (partition, group) -- a table with at most
   ``partitions + groups`` rows, whose exclusive running sum is the offset of
   each partition -- and add it to the row's position inside its partition
   (``monotonically_increasing_id`` keeps that in its low 33 bits).

The offsets table is broadcast; its size is bounded by the partition count
(plus the number of groups, which callers keep small, e.g. shards), so the
large side is never shuffled a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

#: File blocks whose offsets are broadcast (about 200 bytes each); more are joined by a shuffle.
BLOCKS = 200_000
_LOW33 = (1 << 33) - 1


def ordered_partitions(df: DataFrame, keys, num_partitions: int | None = None) -> DataFrame:
    """Range-partitioned, sorted and checkpointed copy of ``df``."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .checkpoint(eager=True))


def with_row_index(df: DataFrame, order_cols, index_col: str = "idx",
                   group_cols=(), num_partitions: int | None = None) -> DataFrame:
    """``df`` plus a dense 0-based ``index_col`` in ``order_cols`` order.

    ``order_cols`` should be unique (within a group); otherwise ties get an
    arbitrary but fixed order.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    ranged = ordered_partitions(df, group_cols + order_cols, num_partitions)
    located = (ranged.withColumn("_pid", F.spark_partition_id())
                     .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))))
    counts = located.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    if group_cols:
        w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (located.join(F.broadcast(offsets.drop("_n")), ["_pid", *group_cols])
                   .withColumn(index_col, F.col("_off") + F.col("_local") - F.col("_first"))
                   .drop("_pid", "_local", "_first", "_off"))


def with_running_total(df: DataFrame, order_cols, weight_col: str, out_col: str = "start",
                       group_cols=(), num_partitions: int | None = None) -> DataFrame:
    """``df`` plus the sum of ``weight_col`` over all earlier rows in
    ``order_cols`` order (an exclusive running total, restarting per
    ``group_cols``), without a single-task window: range partitions,
    per-(partition, group) totals (broadcast), and a running sum inside each
    partition."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    ranged = ordered_partitions(df, group_cols + order_cols, num_partitions)
    located = (ranged.withColumn("_pid", F.spark_partition_id())
                     .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))))
    totals = located.groupBy("_pid", *group_cols).agg(F.sum(weight_col).alias("_n"))
    w = Window.partitionBy(*group_cols).orderBy("_pid") if group_cols else Window.orderBy("_pid")
    offsets = totals.withColumn("_off", F.coalesce(
        F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inner = Window.partitionBy("_pid", *group_cols).orderBy("_local") \
                  .rowsBetween(Window.unboundedPreceding, -1)
    return (located.join(F.broadcast(offsets), ["_pid", *group_cols])
                   .withColumn(out_col, F.col("_off") + F.coalesce(F.sum(weight_col).over(inner), F.lit(0)))
                   .drop("_pid", "_local", "_off"))


def positions_by_document(df: DataFrame, group_col: str, doc_col: str, line_col: str,
                          pos_col: str = "pos") -> DataFrame:
    """Dense 0-based position of each row inside its ``group_col`` (a shard),
    in (document, line) order, when every document sits in one group.

    Position = the line's rank inside its document (a window over one
    document, which was one row of text) + the running total of the line
    counts of earlier documents of the group (computed on the per-document
    count table).  The rows are shuffled once, on (group, document), and the
    join with the starts reuses that partitioning; only the small count
    table is range-partitioned and checkpointed.
    """
    w = Window.partitionBy(group_col, doc_col).orderBy(line_col)
    ranked = df.withColumn("_r", F.row_number().over(w) - 1)
    counts = df.groupBy(group_col, doc_col).agg(F.count(F.lit(1)).alias("_c"))
    starts = with_running_total(counts, [doc_col], "_c", "_start", group_cols=[group_col])
    return (ranked.join(starts.select(group_col, doc_col, "_start"), [group_col, doc_col])
                  .withColumn(pos_col, F.col("_start") + F.col("_r"))
                  .drop("_r", "_start"))


def block_starts(counts: DataFrame) -> DataFrame:
    """What is added to a place in a block (``_file, _block, _first, _n``: its smallest place and rows) to number all rows."""
    starts = with_running_total(counts, ["_file", "_block"], "_n", "_start").select(
        "_file", "_block", (F.col("_start") - F.col("_first")).alias("_shift")).checkpoint(eager=True)
    return F.broadcast(starts) if starts.count() <= BLOCKS else starts


def with_block_index(df: DataFrame, file_col, block_col, place_col, index_col: str = "idx",
                     starts: DataFrame | None = None) -> DataFrame:
    """``df`` plus a dense 0-based ``index_col`` in the order of file, block and place in the block.

    The places of a block must be dense, from any number on.  Only the counts of the
    blocks are ordered and summed; the rows are neither sorted nor shuffled
    (as long as the blocks are few enough to broadcast, which is checked).  ``starts``
    (of ``block_starts``) saves counting the rows where the counts are known.
    """
    placed = df.withColumns({"_file": file_col, "_block": block_col, "_place": place_col})
    if starts is None:
        starts = block_starts(placed.groupBy("_file", "_block").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")))
    return (placed.join(starts, ["_file", "_block"])
            .withColumn(index_col, F.col("_shift") + F.col("_place")).drop("_file", "_block", "_place", "_shift"))


def interval_of(points: DataFrame, at_col: str, starts: DataFrame, start_col: str) -> DataFrame:
    """``points`` joined with the row of ``starts`` whose interval holds ``at_col``.

    An interval runs from its ``start_col`` to the next one's; starts are unique, and the
    smallest is at most every point.  Points and starts are range-partitioned together: the
    latest start is a running maximum in each partition, after that of the partitions before
    (one broadcast row a partition).
    """
    mark = F.struct(start_col, *[c for c in starts.columns if c != start_col])
    marks = starts.select(F.col(start_col).alias(at_col), F.lit(0).alias("_kind"), mark.alias("_mark"))
    both = points.withColumn("_kind", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    ranged = ordered_partitions(both, [at_col, "_kind"])
    located = (ranged.withColumn("_pid", F.spark_partition_id())
                     .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = (located.groupBy("_pid").agg(F.max("_mark").alias("_last"))
               .select("_pid", F.max("_last").over(before).alias("_carry")))
    inner = Window.partitionBy("_pid").orderBy("_local").rowsBetween(Window.unboundedPreceding, 0)
    seen = located.withColumn("_seen", F.max("_mark").over(inner)).where(F.col("_kind") == 1)
    return (seen.join(F.broadcast(carried), "_pid")
            .select(*points.columns, F.coalesce("_seen", "_carry").alias("_in"))
            .select(*points.columns, "_in.*"))
