"""Sinks K1-K6: shard files, vocabulary file, metric tables, cached stages."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.keyed import h60
from tessera.sources import fs


# ------------------------------------------------------------------ K1, K2, K3
def write_shards(df: DataFrame, path: str, num_files: int, line_col: str | None = None,
                 split_col: str = "split", shard_col: str = "shard", mode: str = "errorifexists",
                 order_cols=None, key_cols=("doc_id",), files_per_shard: int | None = None) -> None:
    """One text directory per (split, shard), one line per row.

    ``split=train/shard=3/part-*.txt`` replaces the renamed ``..._03.txt``
    files; ``mode="append"`` adds to existing shards (K3).  A shard is
    written by ``files_per_shard`` tasks (default: the shuffle partitions
    spread over the shards), each taking whole documents (salted by
    ``key_cols``), so no task holds a whole shard.  Inside a file rows are in
    input order: by document and line or sentence number, as far as the table
    has these columns; ``order_cols`` names others, ``()`` leaves the sort out.
    ``line_col`` is ``line``, or ``sentence`` where there is no ``line``.
    """
    spark = df.sparkSession
    if line_col is None:
        line_col = "line" if "line" in df.columns else "sentence"
    if order_cols is None:
        order_cols = [c for c in (*key_cols, "line_no", "sent_no") if c in df.columns]
    if files_per_shard is None:
        files_per_shard = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // num_files)
    keys = [c for c in key_cols if c in df.columns]
    salt = (h60(F.lit("file"), *keys) % files_per_shard) if keys and files_per_shard > 1 else F.lit(0)
    out = df.withColumn("_file", salt).repartition(num_files * files_per_shard, shard_col, "_file")
    if order_cols:
        out = out.sortWithinPartitions(shard_col, "_file", *order_cols)
    (out.select(split_col, shard_col, line_col)
        .write.mode(mode).partitionBy(split_col, shard_col).text(path))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards written by ``write_shards`` back as ``(line, split, shard)``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


# ------------------------------------------------------------------ K4
def write_vocab(vocab: DataFrame, path: str, mode: str = "overwrite") -> str:
    """``vocab.txt``: one piece per line in id order (a single file; the
    vocabulary is bounded by its size parameter).  Returns the file path."""
    (vocab.coalesce(1).sortWithinPartitions("token_id").select("piece")
          .write.mode(mode).text(path))
    parts = [n for n in fs.list_names(vocab.sparkSession, path) if n.startswith("part-")]
    return f"{path.rstrip('/')}/{parts[0]}" if parts else path


# ------------------------------------------------------------------ K5
def write_metrics(metrics_df: DataFrame, path: str, split: str, mode: str = "overwrite") -> None:
    """The one-row metric table of a split as JSON under ``path/split=...``."""
    metrics_df.withColumn("split", F.lit(split)).coalesce(1).write.mode(mode) \
        .partitionBy("split").json(path)


# ------------------------------------------------------------------ K6
def fingerprint(df: DataFrame) -> str | None:
    """Digest of the plan and of its input files (path, size, modification time).

    None if rows come from the driver's memory or from a checkpoint, or pass a
    Python function: a plan does not name those rows or that code.  Spark cuts
    wide nodes when it prints a plan, so the limit is raised for the call; a
    plan that is cut all the same has no digest either.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    if plan.containsPattern(spark._jvm.org.apache.spark.sql.catalyst.trees.TreePattern.PYTHON_UDF()):
        return None
    limit = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(2**31 - 1))
    try:
        text = f"{plan.canonicalized().toString()}\n{df.schema.json()}"
    finally:
        spark.conf.set(limit, before)
    if "LogicalRDD" in text or "LocalRelation" in text or " more fields" in text:
        return None
    files = df.inputFiles()
    if files:
        seen = (df.sparkSession.read.format("binaryFile").load(files)
                .select(F.xxhash64("path", "length", "modificationTime").alias("h"))
                .agg(F.bit_xor("h"), F.count(F.lit(1))).first())
        text += f"\n{tuple(seen)}"
    return hashlib.md5(text.encode()).hexdigest()


def cached_stage(df: DataFrame, path: str, overwrite: bool = False, key: str | None = None) -> DataFrame:
    """Write a stage once as parquet and read it back; reuse it for the same
    input unless ``overwrite`` (the map-result cache of the original).

    Every input has a folder of its own under ``path``, named by ``key`` or
    else by :func:`fingerprint`; an input without a fingerprint is written
    again each time."""
    spark = df.sparkSession
    name = key or fingerprint(df)
    at = f"{path.rstrip('/')}/stage={name or 'unnamed'}"
    if overwrite or name is None or not fs.exists(spark, f"{at}/_SUCCESS"):
        df.write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)
