"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import ann, bpe, chat, html, mixing, ngram_join, prefix_trie, quality, repeats, tokenfile, toxicity, warc, whiten

QUERIES: dict = {}
ORACLE: dict = {}


def _query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return put


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op2_mix_sources")
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@_query("op5_quality_rules", quality.ORACLE_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


@_query("op10_chat_formatting", chat.ORACLE_SQL)
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    back = chat.read_back(chat.expand_examples(turns.unionByName(probe)))
    turn = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", turn), ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


@_query("op1_nearest_neighbours")
def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, path, pattern).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))
    return bpe.decode(ids, path, pattern=pattern).select(
        "doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@_query("op7_warc_round_trip", warc.ORACLE_SQL)
def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(pages).select(
        "page_id", F.col("payload_length").alias("payload_bytes"), "payload_digest",
        F.col("warc_type").alias("record_type"), "refers_to")


@_query("op9_ngram_jaccard")
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(_table(spark, sf_dir, "documents"))


@_query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["hi"] - x["lo"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@_query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query("op8_html_text")
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages, html.train(pages)).withColumn("n_chars", F.length("text").cast("long"))


@_query("op11_token_ids")
def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    back = tokenfile.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(_table(spark, sf_dir, "embeddings"))


@_query("op13_prefix_trie", prefix_trie.ORACLE_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.trie(prefix_trie.rebuild(prefix_trie.sequences(turns)))
