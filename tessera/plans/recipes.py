"""End-to-end recipes R1-R5, each one lazy DataFrame plan (plus the index
checkpoints that caps and samples need)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import corpus, dedup, split


# ------------------------------------------------------------------ R1
def corpus_plain(docs: DataFrame, num_files: int = 32, max_sentences: int = 0,
                 max_valid_sentences: int = 0, seed: int = 42, text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """Plain-text corpus: documents -> lines -> strip+NFKC -> non-empty ->
    first ``max_sentences`` -> shard by document -> train/valid -> valid
    drawn with replacement down to ``max_valid_sentences``.

    Output ``(split, shard, doc_id, line_no, line)``; write it with
    ``sinks.write_shards``.
    """
    lines = corpus.explode_lines(docs, text_col, (id_col,), normalize=True)
    return _plain(lines, num_files, max_sentences, max_valid_sentences, seed, id_col)


def corpus_plain_files(spark: SparkSession, path, num_files: int = 32, max_sentences: int = 0,
                       max_valid_sentences: int = 0, seed: int = 42) -> DataFrame:
    """:func:`corpus_plain` from text files: lines that are blank after strip end a document, and so does a file's end.

    ``doc_id`` counts the documents in the order of file names and places; ``line_no`` the
    lines of a document, blank ones left out.
    """
    from tessera.sources.readers import numbered_paragraphs
    docs = numbered_paragraphs(spark, path, T.normalize_line_arrow)
    lines = docs.select("doc_id", F.posexplode("lines").alias("line_no", "line"))
    return _plain(lines, num_files, max_sentences, max_valid_sentences, seed, "doc_id")


def _plain(lines: DataFrame, num_files: int, max_sentences: int, max_valid_sentences: int, seed: int, id_col: str) -> DataFrame:
    lines = corpus.nonempty_lines(lines)
    if max_sentences > 0:
        lines = split.limit_sentences(lines, max_sentences, (id_col, "line_no"))
    lines = split.train_valid_split(split.assign_shard(lines, num_files, (id_col,), seed),
                                    num_files)
    cols = ["split", "shard", id_col, "line_no", "line"]
    if max_valid_sentences <= 0:
        return lines.select(*cols)
    train = lines.where(F.col("split") == "train").select(*cols)
    valid = lines.where(F.col("split") == "valid")
    valid = split.bootstrap_sample(valid, max_valid_sentences, (id_col, "line_no"), seed)
    return train.unionByName(valid.select(*cols))


# ------------------------------------------------------------------ R2
def corpus_wiki(docs: DataFrame, num_files: int = 32, max_documents: int = 0,
                min_len: int = 10, max_len: int = 1000, seed: int = 42,
                dedup_mode: str = "exact", cache_len: int = 10_000,
                id_col: str = "doc_id", title_col: str | None = "title") -> DataFrame:
    """Encyclopedia corpus: first ``max_documents`` -> non-empty text ->
    clean-up chain -> sentences -> length filter -> shard -> dedup -> split.

    ``dedup_mode``: ``exact`` (global keep-first, the default), ``lru``
    (the per-shard bounded recency cache of the original), or ``none``.
    Output ``(split, shard, doc_id, sent_no, sentence)``.  Documents without
    an ``id_col`` (a JSON dump) are numbered in file order first.
    """
    if id_col not in docs.columns:
        docs = index_rows(docs, id_col)
    if title_col and title_col not in docs.columns:
        title_col = None
    if max_documents > 0:
        docs = split.limit_documents(docs, max_documents, (id_col,))
    docs = corpus.drop_empty_text(docs, "text")
    title = F.col(title_col) if title_col else None
    cleaned = docs.select(id_col, T.clean_wiki_text("text", title).alias("text"))
    sents = corpus.split_sentences(cleaned, "text", (id_col,))
    sents = corpus.length_between(sents, "sentence", min_len, max_len)
    if dedup_mode == "exact":
        sents = dedup.dedup_exact(sents, "sentence", (id_col, "sent_no"))
    sents = split.assign_shard(sents, num_files, (id_col,), seed)
    if dedup_mode == "lru":
        from tessera.operators.rowindex import positions_by_document
        sents = positions_by_document(sents, "shard", id_col, "sent_no", "pos")
        sents = dedup.dedup_lru(sents, cache_len, "sentence").drop("pos")
    elif dedup_mode not in ("exact", "none"):
        raise ValueError("dedup_mode must be exact, lru or none")
    sents = split.train_valid_split(sents, num_files)
    return sents.select("split", "shard", id_col, "sent_no", "sentence")


# ------------------------------------------------------------------ R5
def evaluation(df: DataFrame, logits_col: str = "logits", label_col: str = "label",
               id_col: str = "row_id", batch_size: int = 32,
               max_samples: int | None = None) -> DataFrame:
    """Evaluation table: the first ``max_samples`` rows by id -> argmax ->
    scored positions -> accuracy over all batches -> perplexity -> sample
    count, as one row."""
    from tessera.operators import metrics
    df = split.max_samples(df, max_samples, (id_col,))
    pred = df.select(id_col, F.floor(F.col(id_col) / batch_size).alias("batch_id"),
                     metrics.argmax(logits_col).alias("pred"), F.col(label_col).alias("label"),
                     metrics.token_loss(logits_col, label_col).alias("loss"))
    s = metrics.scored(pred)
    acc = metrics.accuracy_by_batch(s)
    ppl = metrics.perplexity(s)
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    # three one-row aggregates side by side
    return (acc.select("accuracy", "n_scored").withColumn("_k", F.lit(1))
            .join(ppl.withColumn("_k", F.lit(1)), "_k")
            .join(n.withColumn("_k", F.lit(1)), "_k")
            .select("accuracy", "n_scored", F.round("eval_loss", 6).alias("eval_loss"),
                    F.round("perplexity", 6).alias("perplexity"), F.col("_n").alias("samples")))


# ------------------------------------------------------------------ R3
def vocabulary(train_lines: DataFrame, sample_size: int = 10_000_000, vocab_size: int = 32768,
               limit_alphabet: int = 6129, num_unused: int = 10, seed: int = 42,
               line_col: str = "line", key_cols=("doc_id", "line_no"),
               mode: str = "whitespace", splitter=None, min_frequency: int = 2) -> DataFrame:
    """Vocabulary: drop empty lines -> uniform sample of ``sample_size`` lines
    -> words -> counts -> WordPiece learner.  Output ``(token_id, piece)``;
    write it with ``sinks.write_vocab``."""
    from tessera.operators import vocab as V
    lines = corpus.drop_empty_lines(train_lines, line_col)
    if sample_size > 0:
        lines = split.shuffle_sample(lines, sample_size, key_cols, seed)
    words = V.pretokenize(lines, line_col, key_cols, mode, splitter)
    counts = V.word_counts(words)
    return V.learn_wordpiece(counts, vocab_size, limit_alphabet, num_unused, min_frequency)


# ------------------------------------------------------------------ R4
def index_rows(df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Numbers the rows: those of files by file name and place in the file, others in scan order.

    Rows of files are counted by file block; no row is moved for it.
    """
    from pyspark.errors import AnalysisException
    from tessera.operators.rowindex import with_block_index, with_row_index
    marked = df.withColumn("_scan", F.monotonically_increasing_id())
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    try:
        from_files = marked.select("*", file.alias("_path"), block.alias("_at"))
    except AnalysisException:  # not read from files
        return with_row_index(marked, ["_scan"], id_col).drop("_scan")
    return with_block_index(from_files, F.col("_path"), F.col("_at"), F.col("_scan"), id_col).drop("_scan", "_path", "_at")


def training_table(dataset: DataFrame, vocab: DataFrame, line_by_line: bool = True,
                   max_len: int = 512, max_samples: int | None = None, batch_size: int = 32,
                   mega_mult: int | None = None, mlm_probability: float = 0.15,
                   pad_multiple: int | None = 8, group_rows: int = 1000, seed: int = 42,
                   epoch: int = 0, id_cols=None) -> DataFrame:
    """Masked-LM training table: text column -> (line-by-line encoding | encode
    and pack) -> first ``max_samples`` -> length-grouped batches -> masking
    -> padding per batch.  Line by line, a row is an example, so the cap comes
    before the encoding.  ``id_cols`` default: rows numbered in file order.
    """
    from tessera.operators import encode as E
    from tessera.sources.readers import text_column
    if id_cols is None:
        rows, ids = index_rows(text_column(dataset)), ["row_id"]
    else:
        ids = list(id_cols)
        name = "text" if "text" in dataset.columns else [c for c in dataset.columns if c not in ids][0]
        rows = dataset.select(*ids, F.col(name).alias("text"))
    if line_by_line:
        rows = split.max_samples(corpus.drop_blank_lines(rows, "text"), max_samples, ids)
        enc = E.line_by_line(rows, vocab, max_len, "text", ids)
    else:
        enc = E.encode(rows, vocab, None, "text", ids, truncation=False)
        enc = E.pack_blocks(enc, max_len, ids, group_rows)
        ids = ["group_id", "block_no"]
        enc = split.max_samples(enc.withColumn("length", F.size("input_ids")), max_samples, ids, staged=True)
    batched = E.length_batches(enc, batch_size, mega_mult, seed, ids)
    n_vocab = vocab.count()   # one scalar
    mask_id = int(vocab.where(F.col("piece") == "[MASK]").select("token_id").first()[0])
    masked = E.mask_tokens(batched, n_vocab, mask_id, mlm_probability, seed, epoch, ids)
    multiple = pad_multiple if line_by_line else None
    return E.pad_batch(masked, "batch_id", multiple)
