"""Deduplication: D1 exact, D2 recency-window, D3 bounded recency cache."""

from __future__ import annotations

from collections import OrderedDict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, ByteType, IntegerType, LongType, ShortType, StringType

from tessera.session import checkpoint_dir

# Positions per sub-range in dedup_recent: a (shard, value) group is windowed
# in slices of this many positions, so one hot value never fills one task.
RECENT_SLICE = 1 << 20
# Bits of the integer types whose values dedup_exact packs.
WIDTHS = {ByteType(): 8, ShortType(): 16, IntegerType(): 32, LongType(): 64}


# ------------------------------------------------------------------ D1
def dedup_exact(df: DataFrame, value_col: str = "sentence",
                order_cols=("doc_id", "sent_no")) -> DataFrame:
    """Keep the first occurrence (smallest ``order_cols``) of each value.

    One aggregation on the value, combined map-side first, so a value held by
    a third of all rows reaches the shuffle as one row per map task.  Integer
    order columns are packed into one decimal, whose minimum a hash aggregate
    keeps in place; further columns, or other types, take
    ``min(struct(order..., rest...))``, which sorts.  Nulls come first.
    """
    order_cols = list(order_cols)
    rest = [c for c in df.columns if c not in order_cols and c != value_col]
    widths = [WIDTHS.get(df.schema[c].dataType, 128) for c in order_cols]
    if not rest and sum(widths) <= 104:
        packed = F.lit(0).cast("decimal(38,0)")
        for c, w in zip(order_cols, widths):
            packed = packed * _dec((1 << w) + 1) + F.coalesce(
                F.col(c).cast("decimal(20,0)") + _dec((1 << (w - 1)) + 1), _dec(0))
        first = df.groupBy(value_col).agg(F.min(packed.cast("decimal(38,0)")).alias("_p"))
        for c, w in reversed(list(zip(order_cols, widths))):
            digit = F.col("_p") % _dec((1 << w) + 1)
            first = first.withColumns({
                c: F.when(digit > 0, digit - _dec((1 << (w - 1)) + 1)).cast(df.schema[c].dataType),
                "_p": ((F.col("_p") - digit) / _dec((1 << w) + 1)).cast("decimal(38,0)")})
        return first.select(*df.columns)
    first = df.groupBy(value_col).agg(F.min(F.struct(*order_cols, *rest)).alias("_first"))
    return first.select(*[F.col(f"_first.{c}").alias(c) for c in order_cols + rest], value_col) \
                .select(*df.columns)


def _dec(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


# ------------------------------------------------------------------ D2
def dedup_recent(df: DataFrame, window: int, value_col: str = "sentence",
                 shard_col: str = "shard", pos_col: str = "pos",
                 slice_len: int = RECENT_SLICE) -> DataFrame:
    """Drop a row whose previous occurrence in its shard is at most ``window``
    positions back.

    ``lag`` over (shard, value) ordered by position, computed in two levels so
    that a hot value is split: within slices of ``slice_len`` positions, and
    for each slice's first row, the last position of the previous non-empty
    slice (from a per-slice aggregate, far smaller than the rows).
    """
    keys = [shard_col, value_col]
    sliced = df.withColumn("_slice", F.floor(F.col(pos_col) / slice_len))
    w_in = Window.partitionBy(*keys, "_slice").orderBy(pos_col)
    rows = sliced.withColumn("_prev", F.lag(pos_col).over(w_in))
    last = sliced.groupBy(*keys, "_slice").agg(F.max(pos_col).alias("_last"))
    w_slice = Window.partitionBy(*keys).orderBy("_slice")
    carry = last.withColumn("_carry", F.lag("_last").over(w_slice)).drop("_last")
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    # null-safe: rows without a value repeat each other like any other value
    carry = carry.toDF("_shard", "_value", "_at", "_carry")
    same = (F.col(shard_col).eqNullSafe(F.col("_shard")) & F.col(value_col).eqNullSafe(F.col("_value"))
            & (F.col("_slice") == F.col("_at")))
    return (rows.join(carry, same)
                .where(prev.isNull() | (F.col(pos_col) - prev > window))
                .select(*df.columns))


# ------------------------------------------------------------------ D3
# Positions per chunk in dedup_lru: each chunk is replayed by one task.
LRU_CHUNK = 1 << 20


# Neighbouring chunks that are summed up together, level by level.
LRU_FAN = 4


def _top_recent(df: DataFrame, cache_len: int, keys) -> DataFrame:
    """Per ``keys`` group, the ``cache_len`` values with the latest ``last``
    position (one row per value, its latest position kept)."""
    latest = df.groupBy(*keys, "_v").agg(F.max("_last").alias("_last"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_last"))
    return latest.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= cache_len).drop("_r")


def _recent_before(summary: DataFrame, chunks: int, cache_len: int) -> DataFrame:
    """Per chunk, the ``cache_len`` latest values of all chunks before it, from the latest of each chunk.

    ``LRU_FAN`` neighbours are summed up to one, and so on until one is left; on the
    way back each gets what came before its group and the neighbours before it.
    All levels together are a small multiple of the first, however many chunks there are.
    """
    keys, cols = ["_s", "_c"], ["_s", "_c", "_v", "_last"]
    levels, sizes = [summary], [chunks]
    while sizes[-1] > LRU_FAN:
        up = levels[-1].withColumn("_c", F.expr(f"_c div {LRU_FAN}")).select(*cols)
        levels.append(_top_recent(up, cache_len, keys).checkpoint(eager=True))
        sizes.append(-(-sizes[-1] // LRU_FAN))
    before = None
    for level, n in zip(reversed(levels), reversed(sizes)):
        child = F.col("_c") % LRU_FAN
        later = F.when(child < LRU_FAN - 1, F.sequence(F.col("_c") + 1, F.col("_c") - child + LRU_FAN - 1))
        down = level.select("_s", F.explode(later).alias("_c"), "_v", "_last")
        if before is not None:
            children = F.sequence(F.col("_c") * LRU_FAN, F.col("_c") * LRU_FAN + LRU_FAN - 1)
            down = down.unionByName(before.select("_s", F.explode(children).alias("_c"), "_v", "_last"))
        before = _top_recent(down.where(F.col("_c") < n), cache_len, keys)
        if level is not summary:
            before = before.checkpoint(eager=True)
    return before


def _lru_replay(cache_len: int, cols: list[str]):
    """Replay the recency cache over rows sorted by (shard, chunk, kind, order):
    kind 0 rows seed the cache (oldest first), kind 1 rows are decided."""
    def run(batches):
        cache: OrderedDict = OrderedDict()
        group = None
        for batch in batches:
            keep = []
            for s, c, kind, v in zip(*[batch.column(x).to_pylist() for x in ("_s", "_c", "_kind", "_v")]):
                if (s, c) != group:
                    cache.clear()
                    group = (s, c)
                hit = v in cache
                cache[v] = None
                cache.move_to_end(v)
                if len(cache) > cache_len:
                    cache.popitem(last=False)
                keep.append(kind == 1 and not hit)
            yield batch.select(cols).filter(pa.array(keep, pa.bool_()))
    return run


def dedup_lru(df: DataFrame, cache_len: int = 10_000, value_col: str = "sentence",
              shard_col: str = "shard", pos_col: str = "pos",
              chunk_len: int = LRU_CHUNK, num_partitions: int | None = None) -> DataFrame:
    """Exact bounded recency-cache semantics per shard, in parallel chunks.

    A row is dropped iff its value is still in the shard's cache: fewer than
    ``cache_len`` distinct values were seen since its last access (a hit
    refreshes recency).  The cache before any position holds exactly the
    ``cache_len`` most recently seen distinct values, so each chunk of
    ``chunk_len`` positions can be replayed on its own from that seed:

    1. per chunk, the ``cache_len`` latest distinct values (a window over one
       chunk);
    2. a prefix over chunks with the associative "latest ``cache_len`` of a
       union" (:func:`_recent_before`; every group at most ``2 * LRU_FAN *
       cache_len`` rows) gives the seed of every chunk;
    3. seed rows then chunk rows, sorted, stream through one ordered map of
       at most ``cache_len`` entries per task.

    Strings and bytes are told apart by their MD5 (128 bits), so that steps 1 and 2
    move 16 bytes a value.
    No group exceeds ``chunk_len + cache_len`` rows, whatever the shard size.
    """
    if cache_len <= 0:
        raise ValueError("cache_len must be positive")
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = df.columns
    value = F.col(value_col)
    if isinstance(df.schema[value_col].dataType, (StringType, BinaryType)):
        value = F.unhex(F.md5(value))
    rows = df.withColumn("_s", F.col(shard_col)).withColumn(
        "_c", F.floor(F.col(pos_col) / chunk_len)).withColumn("_v", value)
    checkpoint_dir(spark)
    summary = _top_recent(rows.select("_s", "_c", "_v", F.col(pos_col).alias("_last")),
                          cache_len, ["_s", "_c"]).checkpoint(eager=True)
    chunks = (summary.agg(F.max("_c")).first()[0] or 0) + 1      # one scalar
    # the seed of a chunk is the latest of the chunks before it
    seeds = _recent_before(summary, chunks, cache_len).select(
        "_s", "_c", "_v", F.lit(0).alias("_kind"), F.col("_last").alias("_ord"))
    body = rows.withColumn("_kind", F.lit(1)).withColumn("_ord", F.col(pos_col))
    both = body.unionByName(seeds, allowMissingColumns=True)
    ordered = both.repartition(n, "_s", "_c").sortWithinPartitions("_s", "_c", "_kind", "_ord")
    return ordered.mapInArrow(_lru_replay(cache_len, cols), schema=df.schema)
