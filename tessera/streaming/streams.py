"""Structured Streaming forms of the corpus operators: X1-X3.

The original consumes a bounded in-process queue until an end marker; here a
file source with ``maxFilesPerTrigger`` is the back-pressure knob and an
``availableNow`` trigger is the end marker.  The batch operators are reused
unchanged, so a stream over the same files gives the batch result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.keyed import h60
from tessera.operators import corpus
from tessera.session import scratch_path
from tessera.sources.readers import JSON_DOC_SCHEMA


def read_json_docs_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming JSON-lines documents ``doc_id, title, text, ingest_ts`` with non-empty text.

    ``doc_id`` is a keyed hash of the file path, title and text, the same in
    every run; equal documents of one file share it.  ``ingest_ts`` is the
    arrival time, for bounded-state operators."""
    raw = (spark.readStream.schema(JSON_DOC_SCHEMA)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    return (raw.where(F.col("_corrupt_record").isNull() & F.col("text").isNotNull()
                      & (F.col("text") != ""))
               .select(h60("_metadata.file_path", F.coalesce("title", F.lit("")), F.md5("text")).alias("doc_id"),
                       "title", "text", F.current_timestamp().alias("ingest_ts")))


# ------------------------------------------------------------------ X1
def stream_clean(docs: DataFrame, id_col: str = "doc_id", min_len: int = 10,
                 max_len: int = 1000, title_col: str | None = "title") -> DataFrame:
    """Clean-up chain -> sentences -> length filter on arriving documents."""
    title = F.col(title_col) if title_col else None
    extra = [c for c in ("ingest_ts",) if c in docs.columns]
    cleaned = docs.select(id_col, *extra, T.clean_wiki_text("text", title).alias("text"))
    sents = corpus.split_sentences(cleaned, "text", (id_col, *extra))
    return corpus.length_between(sents, "sentence", min_len, max_len)


# ------------------------------------------------------------------ X2
def stream_dedup(sents: DataFrame, delay: str = "1 hour", value_col: str = "sentence",
                 time_col: str = "ingest_ts") -> DataFrame:
    """Drop a sentence seen before within the watermark delay.

    State is bounded by event time (``dropDuplicatesWithinWatermark``), the
    streaming counterpart of the bounded recency cache; use the RocksDB state
    store at scale.
    """
    return sents.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([value_col])


# ------------------------------------------------------------------ X3
def stream_accuracy(preds: DataFrame, pred_col: str = "pred", label_col: str = "label") -> DataFrame:
    """Running masked accuracy over everything seen (complete output mode)."""
    s = preds.where(F.col(label_col) != -100)
    correct = F.when(F.col(pred_col) == F.col(label_col), 1).otherwise(0)
    return s.agg(F.sum(correct).alias("n_correct"), F.count(F.lit(1)).alias("n_scored")) \
            .withColumn("accuracy", F.col("n_correct") / F.col("n_scored"))


def run_available(stream: DataFrame, name: str, mode: str = "append",
                  checkpoint: str | None = None) -> DataFrame:
    """Run a streaming plan over everything available, wait for it, and return its rows.

    Appended rows go to Parquet files.  The other modes hold the result table in
    a memory table; they are meant for aggregates of a few rows."""
    spark = stream.sparkSession
    if mode == "append":
        out = scratch_path(spark, f"rows-{name}")
        q = (stream.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{name}"))
             .trigger(availableNow=True).start(out))
        q.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    q = (stream.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(name)
