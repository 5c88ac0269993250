"""Sharding, train/valid split, caps and sampling: P1-P2, L1-L6."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.keyed import h60
from tessera.operators.rowindex import interval_of, with_row_index, with_running_total
from tessera.session import checkpoint_dir

# Rows of a group up to which bootstrap_sample numbers them in one window.
GROUP_ROWS = 1 << 20
# Draws up to which their groups are broadcast; more are joined by a shuffle.
GROUPS_BROADCAST = 200_000


# ------------------------------------------------------------------ P1, P2
def assign_shard(df: DataFrame, num_files: int, key_cols=("doc_id",), seed: int = 42,
                 shard_col: str = "shard") -> DataFrame:
    """Every document goes to one keyed-uniform shard; its lines stay together.

    Narrow: no shuffle.
    """
    if num_files < 2:
        raise ValueError("num_files must be at least 2 (one shard is held out)")
    return df.withColumn(shard_col, (h60(F.lit(seed), *key_cols) % num_files).cast("int"))


def train_valid_split(df: DataFrame, num_files: int, shard_col: str = "shard",
                      split_col: str = "split") -> DataFrame:
    """Last shard = ``valid``, the others = ``train``."""
    return df.withColumn(split_col, F.when(F.col(shard_col) == num_files - 1, "valid")
                         .otherwise("train"))


# ------------------------------------------------------------------ L1, L2, L4, L6
def first_rows(df: DataFrame, n: int, order_cols, method: str = "auto") -> DataFrame:
    """The first ``n`` rows in ``order_cols`` order (all rows if fewer).

    Nulls come first.  ``method``: ``prefix``, which is also ``auto`` for every
    ``n`` (see ``_first_rows_by_group``: only the per-group counts are indexed),
    ``topk`` (Spark's TakeOrderedAndProject) or ``index`` (range partition +
    dense index of every row).
    """
    if n <= 0:
        return df
    order_cols = list(order_cols)
    if method == "topk":
        return df.orderBy(*order_cols).limit(n)
    if method in ("prefix", "auto"):
        return _first_rows_by_group(df, n, order_cols)
    return with_row_index(df, order_cols, "_idx").where(F.col("_idx") < n).drop("_idx")


def _first_rows_by_group(df: DataFrame, n: int, order_cols) -> DataFrame:
    """First ``n`` rows when the order starts with a group key (a document).

    Rows per group are counted (combined map-side), the far smaller count
    table gets an exclusive running total, and the one group that straddles
    ``n`` is found (two scalars).  The result is every row of earlier groups
    (a plain filter on the key, pushed to the scan) plus the first rows of
    the boundary group, capped by the same operator on that group alone, so
    a group holding a third of all rows is still split across tasks.
    """
    g, rest = order_cols[0], order_cols[1:]
    counts = df.groupBy(g).agg(F.count(F.lit(1)).alias("_c"))
    starts = with_running_total(counts, [g], "_c", "_start")
    last = starts.where(F.col("_start") < n).orderBy(F.desc("_start")).select(g, "_start", "_c").first()
    if last is None:
        return df.limit(0)
    key, start, count = last[0], last[1], last[2]
    boundary = df.where(F.col(g).eqNullSafe(F.lit(key)))
    head = df.limit(0) if key is None else df.where(F.col(g).isNull() | (F.col(g) < F.lit(key)))
    if start + count <= n:
        return head.unionByName(boundary)
    part = first_rows(boundary, n - start, rest) if rest else boundary.limit(n - start)
    return head.unionByName(part)


def limit_sentences(df: DataFrame, n: int, order_cols=("doc_id", "line_no"),
                    method: str = "auto") -> DataFrame:
    """L1: first ``n`` non-empty lines in input order; ``n = 0`` keeps all."""
    return first_rows(df, n, order_cols, method)


def limit_documents(df: DataFrame, n: int, order_cols=("doc_id",), method: str = "auto") -> DataFrame:
    """L2: first ``n`` records (exactly ``n``; the reference kept one more)."""
    return first_rows(df, n, order_cols, method)


def head_lines(df: DataFrame, k: int, order_cols=("doc_id", "line_no"),
               method: str = "auto") -> DataFrame:
    """L4: the first ``k`` lines when there are more than ``k``."""
    return first_rows(df, k, order_cols, method)


def max_samples(df: DataFrame, n: int | None, order_cols=("row_id",), method: str = "auto",
                staged: bool = False) -> DataFrame:
    """L6: first ``min(n, len)`` examples; ``None`` keeps all.

    ``staged`` checkpoints the input first, for examples that cost more to make
    than to copy (encoded ones), as they are read for counts, head and boundary.
    """
    if n is None:
        return df
    if staged:
        checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    return first_rows(df, n, order_cols, method)


# ------------------------------------------------------------------ L3
def bootstrap_sample(df: DataFrame, k: int, order_cols=("doc_id", "line_no"),
                     seed: int = 42, draw_col: str = "draw") -> DataFrame:
    """Exactly ``k`` rows drawn with replacement when the table has more than ``k``.

    Draw ``i`` picks row ``h60(seed, i) % n`` of the table in ``order_cols``
    order, nulls first.  The first order column is a group key (a document): its
    counts get a running total, and each draw finds the group whose interval
    holds it.  Only rows of drawn groups go on: they are numbered inside their
    group (by a window, groups of more than ``GROUP_ROWS`` rows by range
    partitions) and meet the draws in an equi-join on the number (a draw
    repeats a row only a few times, so no key is hot).  With ``n <= k`` every
    row is returned once and ``draw`` is its index.
    """
    g, rest = order_cols[0], list(order_cols[1:])
    counts = df.groupBy(F.col(g).alias("_g")).agg(F.count(F.lit(1)).alias("_c"))
    starts = with_running_total(counts, ["_g"], "_c", "_start")
    n, longest = starts.agg(F.coalesce(F.sum("_c"), F.lit(0)), F.max("_c")).first()   # two scalars
    if n <= k:
        return with_row_index(df, order_cols, draw_col)
    draws = df.sparkSession.range(k).select(F.col("id").alias(draw_col),
                                            (h60(F.lit(seed), "id") % n).alias("_idx"))
    found = interval_of(draws, "_idx", starts, "_start").checkpoint(eager=True)
    groups = found.select("_g", "_start", "_c").distinct()
    if k <= GROUPS_BROADCAST:   # at most one group a draw
        groups = F.broadcast(groups)
    small, large = F.col("_c") <= GROUP_ROWS, F.col("_c") > GROUP_ROWS

    def members(of):
        return df.join(groups.where(of), F.col(g).eqNullSafe(F.col("_g")))

    w = Window.partitionBy("_start").orderBy(*rest) if rest else Window.partitionBy("_start").orderBy("_start")
    numbered = members(small).withColumn("_at", F.row_number().over(w) - 1)
    if longest > GROUP_ROWS:
        numbered = numbered.unionByName(with_row_index(members(large), rest, "_at", ["_start"]))
    rows = numbered.withColumn("_idx", F.col("_start") + F.col("_at")).select("_idx", *df.columns)
    return found.select(draw_col, "_idx").join(rows, "_idx").drop("_idx")


# ------------------------------------------------------------------ L5
def shuffle_sample(df: DataFrame, n: int, key_cols=("doc_id", "line_no"), seed: int = 42,
                   bits: int = 16, rank_col: str = "sample_key") -> DataFrame:
    """Uniform sample of ``n`` rows without replacement (``shuf | head -n``).

    The rows with the ``n`` smallest ``h60(seed, key)``, found without a global
    sort: a histogram over the top ``bits`` hash bits (at most ``2**bits``
    rows, broadcast) gives each bucket's running count; only rows of buckets
    starting below ``n`` (about ``n`` rows) pass the broadcast join and are
    ranked inside their bucket.  Two scans of the input, no global sort.
    ``rank_col`` holds the hash, the order of the shuffle.
    """
    keyed = df.withColumn(rank_col, h60(F.lit(seed), *key_cols))
    keyed = keyed.withColumn("_b", F.shiftright(F.col(rank_col), 60 - bits))
    hist = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    hist = (hist.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
                .where(F.col("_before") < n))
    # only the buckets that start below n pass (about n rows); rank inside them
    rows = keyed.join(F.broadcast(hist), "_b")
    rw = Window.partitionBy("_b").orderBy(rank_col, *key_cols)
    return (rows.withColumn("_rn", F.row_number().over(rw))
                .where(F.col("_before") + F.col("_rn") <= n)
                .drop("_b", "_cnt", "_before", "_rn"))


def hash_rank(df: DataFrame, key_cols, seed: int = 42, rank_col: str = "rank",
              bits: int = 16) -> DataFrame:
    """Dense 0-based rank of every row in ``(h60(seed, key), key)`` order.

    The hash is uniform, so buckets on its top ``bits`` hold about equal
    shares: a histogram (at most ``2**bits`` rows, broadcast) gives each
    bucket's offset and a window partitioned by bucket ranks inside it.  No
    global sort and no copy of the input.
    """
    keyed = df.withColumn("_h", h60(F.lit(seed), *key_cols))
    keyed = keyed.withColumn("_b", F.shiftright(F.col("_h"), 60 - bits))
    hist = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hist.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    rw = Window.partitionBy("_b").orderBy("_h", *key_cols)
    return (keyed.join(F.broadcast(offsets), "_b")
                 .withColumn(rank_col, F.col("_before") + F.row_number().over(rw) - 1)
                 .drop("_h", "_b", "_before"))
