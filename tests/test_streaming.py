"""Stream = batch for the streaming operators."""

import os

from pyspark.sql import functions as F

from tessera.plans import recipes
from tessera.streaming import streams
from conftest import SF001


def test_stream_clean_equals_batch(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(
        "doc_id", F.col("lang").alias("title"), "text")
    src = os.path.join(tmp_dir, "src")
    docs.repartition(4).write.parquet(src)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = streams.run_available(streams.stream_clean(stream), "x1", "append",
                                os.path.join(tmp_dir, "ck"))
    want = recipes.corpus_wiki(docs, 4, dedup_mode="none").select("doc_id", "sent_no", "sentence")
    assert sorted(got.select("doc_id", "sent_no", "sentence").collect()) == sorted(want.collect())


def test_stream_dedup_two_batches(spark, tmp_dir):
    src = os.path.join(tmp_dir, "s")
    schema = "doc_id long, sent_no int, sentence string, ingest_ts timestamp"
    spark.sql("select 1L doc_id, 0 sent_no, 'aaa' sentence, timestamp'2024-01-01 00:00:00' ingest_ts "
              "union all select 1L, 1, 'bbb', timestamp'2024-01-01 00:00:01'").write.parquet(src + "/1")
    spark.sql("select 2L doc_id, 0 sent_no, 'aaa' sentence, timestamp'2024-01-01 00:00:05' ingest_ts "
              "union all select 2L, 1, 'ccc', timestamp'2024-01-01 00:00:06'").write.parquet(src + "/2")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(src)
    got = streams.run_available(streams.stream_dedup(stream, "1 hour"), "x2", "append",
                                os.path.join(tmp_dir, "ck"))
    assert sorted(r.sentence for r in got.collect()) == ["aaa", "bbb", "ccc"]


def test_stream_accuracy(spark, tmp_dir):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    from tessera.operators import metrics as M
    preds = emb.select(M.argmax("embedding").alias("pred"), "label")
    src = os.path.join(tmp_dir, "p")
    preds.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(preds.schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = streams.run_available(streams.stream_accuracy(stream), "x3", "complete",
                                os.path.join(tmp_dir, "ck")).first()
    want = M.masked_accuracy(preds).first()
    assert got.n_scored == want.n_scored and abs(got.accuracy - want.accuracy) < 1e-12


def test_json_stream_clean_then_dedup(spark, tmp_dir):
    src = os.path.join(tmp_dir, "json")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write('{"index": {}}\n{"title": "T", "text": "First one! Shared line here!"}\n')
    with open(os.path.join(src, "b.json"), "w") as f:
        f.write('{"index": {}}\n{"title": "U", "text": "Shared line here! Last bit here!"}\nnot json\n')
    docs = streams.read_json_docs_stream(spark, src, max_files_per_trigger=1)
    sents = streams.stream_clean(docs, min_len=5)
    got = streams.run_available(streams.stream_dedup(sents, "1 hour"), "x12", "append",
                                os.path.join(tmp_dir, "ck"))
    assert sorted(r.sentence for r in got.collect()) == [
        "First one!", "Last bit here!", "Shared line here!"]
