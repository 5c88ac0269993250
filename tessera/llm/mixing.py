"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target size (weights shared out again where a target would
exceed ``max_repeats`` times the source).  Each document of a source starts with
the same fractional number of copies, ``target / source size``.  Two documents
with fractional copies are paired: a random amount of mass, counted in words,
moves from one to the other until one of them is integral; directions are drawn
so that every document keeps its expected number of copies, and the words of
the pair stay the same.  Only the last document of a source is rounded, to the
nearest, which leaves the source within half a document of its target.

The pairing is a reduction tree: level 0 pairs inside buckets of about
``BUCKET`` documents of one source, each bucket passes its one fractional
document on, and the next level pairs those, until a source has one bucket.
Levels are checkpointed into the folder of ``spark.checkpoint.dir``.

All draws are keyed by ids and level, so reruns, retries and other partitionings
agree.  Defined cases: a null text has size 0; a null source is one source,
ranked last; documents of size 0 take their rounded share of no words; repeated
rows are documents of their own; with an empty table the result is empty;
other columns are not read.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tessera.operators.rowindex import with_row_index
from tessera.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a bucket of the reduction tree.
BUCKET = 512
#: Copies of the per-source table, so that one source's documents meet it in many tasks.
SALT = 32
WEIGHTS = (5.0, 2.0, 1.0)
_EPS = 1e-9


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, text_hash, size``: number of words of each whole text."""
    n = F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.xxhash64(text_col).alias("text_hash"), F.coalesce(n, F.lit(0).cast("long")).alias("size"))


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeats: float = 3.0) -> DataFrame:
    """``source, n_docs, source_size, target``.

    Sources rank by code point, null last, and take ``weights`` in turn.  With a
    level ``x``, a target is ``min(max_repeats * size, x * weight)``; each pass
    sets ``x`` so that the free sources take what the capped ones leave, until
    no further source is capped.  The passes run on the table of sources; the
    driver sees two sums of each.
    """
    spark = sized.sparkSession
    checkpoint_dir(spark)
    per = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    ranked = with_row_index(per.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "rank")
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.pmod("rank", F.lit(len(weights))).cast("int"))
    ranked = ranked.withColumn("weight", w).drop("_null", "rank").checkpoint()
    cap = F.lit(float(max_repeats)) * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = cap < F.lit(level) * F.col("weight")
        taken, free, n = ranked.agg(
            F.sum(F.when(over, cap).otherwise(F.lit(0.0))),
            F.sum(F.when(over, F.lit(0.0)).otherwise(F.col("weight"))),
            F.sum(over.cast("long"))).first()
        if n is None or n == capped or not free:
            break
        level, capped = (total - taken) / free, n
    return ranked.withColumn("target", F.least(cap, F.lit(level) * F.col("weight"))).drop("weight")


def _draw(*key) -> float:
    raw = hashlib.blake2b(repr(key).encode(), digest_size=8).digest()
    return int.from_bytes(raw, "big") / 2.0**64


def _pivot(pdf: pd.DataFrame, level: int, seed: int) -> pd.DataFrame:
    """Pairs the fractional rows in id order; at most one stays fractional."""
    pdf = pdf.sort_values(["no_id", "doc_id", "size", "text_hash"], kind="stable", ignore_index=True)
    share, ids, size = pdf["share"].tolist(), pdf["doc_id"].tolist(), pdf["size"].tolist()
    held = -1
    for j, p in enumerate(share):
        if not _EPS < p < 1 - _EPS:
            share[j] = float(round(p))
            continue
        if size[j] == 0:  # carries no words; rounded alone
            share[j] = float(_draw(seed, level, ids[j], j) < p)
            continue
        if held < 0:
            held = j
            continue
        i, a, b = held, size[held], size[j]
        up = min((1 - share[i]) * a, p * b)      # words that can move from j to i
        down = min(share[i] * a, (1 - p) * b)    # and from i to j
        moved = up if _draw(seed, level, ids[i], ids[j], i, j) * (up + down) < down else -down
        share[i] += moved / a
        share[j] = p - moved / b
        open_ = [k for k in (i, j) if _EPS < share[k] < 1 - _EPS]
        for k in (i, j):
            if k not in open_:
                share[k] = float(round(share[k]))
        held = open_[0] if open_ else -1
    pdf["share"] = share
    return pdf


def _settle(frac: DataFrame, bucket: Column, level: int, seed: int) -> DataFrame:
    return (frac.withColumn("bucket", bucket).groupBy("source", "bucket")
            .applyInPandas(lambda pdf: _pivot(pdf, level, seed), frac.withColumn("bucket", bucket).schema)
            .drop("bucket").checkpoint())


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: float = 3.0, seed: int = 7, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", bucket: int = BUCKET) -> DataFrame:
    """``doc_id, source, text_hash, size, source_size, target, copies, taken`` per document.

    ``copies`` is between 0 and ``ceil(max_repeats)``; ``taken = copies * size``.
    Only (id, source, size) rows shuffle, never texts.
    """
    sized = sizes(docs, id_col, text_col, source_col)
    goals = source_targets(sized, weights, max_repeats)
    salted = (goals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
              .select(F.col("source").alias("_s"), "salt", "n_docs", "source_size", "target"))
    rows = _with_goals(sized, salted)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    near = F.round(ratio)  # a ratio that is integral but for rounding needs no draw
    whole = F.when(F.abs(ratio - near) < _EPS, near).otherwise(F.floor(ratio))
    rows = rows.withColumn("whole", whole.cast("long")).withColumn("share", F.greatest(ratio - whole, F.lit(0.0)))
    level, per = 0, F.ceil(F.col("n_docs") / bucket)
    spread = F.pmod(F.xxhash64("doc_id", "size"), per)
    # pandas holds whole numbers exactly only where none is null
    frac = rows.withColumns({"no_id": F.col("doc_id").isNull(), "doc_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))})
    most = goals.agg(F.max("n_docs")).first()[0] or 0
    done = []
    while True:
        level_rows = _settle(frac, spread, level, seed)
        is_open = (F.col("share") > _EPS) & (F.col("share") < 1 - _EPS)
        done.append(level_rows.where(~is_open))
        most = -(-most // bucket)  # buckets of the largest source, one open document of each at most
        left = level_rows.where(is_open)
        if most <= 1:
            done.append(left)
            break
        level += 1
        per = F.ceil(per / bucket)
        spread = F.pmod(F.xxhash64("doc_id", "size", F.lit(level)), per)
        frac = left
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    copies = F.col("whole") + F.round("share").cast("long")
    return (out.withColumn("copies", copies).withColumn("taken", copies * F.col("size"))
            .select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "source", "text_hash", "size", "source_size",
                    "target", "copies", "taken"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kwargs) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all columns.

    Rows with the same id, source and text are one kind; the kind comes as often
    as its rows are taken together.
    """
    cols = docs.columns
    mixed = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **kwargs)
    kinds = (mixed.groupBy("doc_id", "source", "text_hash").agg(F.sum("copies").alias("_copies")).where("_copies > 0")
             .toDF("_id", "_source", "_hash", "_copies"))
    rows = docs.withColumn("_text_hash", F.xxhash64(text_col))
    same = (F.col(id_col).eqNullSafe(F.col("_id")) & F.col(source_col).eqNullSafe(F.col("_source"))
            & (F.col("_text_hash") == F.col("_hash")))
    return (rows.join(kinds, same).dropDuplicates(["_id", "_source", "_hash"])
            .select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_n")).drop("_n"))


def _with_goals(sized: DataFrame, salted: DataFrame) -> DataFrame:
    """Source totals for every document; salted, as one source may hold a third of all rows."""
    key = lambda c: F.concat(F.when(c.isNull(), F.lit("n")).otherwise(F.lit("s")), F.coalesce(c, F.lit("")))
    left = (sized.withColumn("_key", key(F.col("source")))
            .withColumn("_salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALT)).cast("int")))
    right = salted.withColumn("_key", key(F.col("_s"))).withColumnRenamed("salt", "_salt").drop("_s")
    return left.join(right, ["_key", "_salt"]).drop("_key", "_salt")
