"""Registered queries: one Spark plan and one DuckDB oracle per operator.

Each Spark callable takes ``(spark, sf_dir)`` and reads the driver's parquet
tables; the SQL runs on the same tables registered as views.  Column names
and types agree on both sides.  Cleaning functions are checked on
``documents`` with markers inserted by ``concat`` on both sides (the plain
prose has no brackets, braces or navigation prefixes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import corpus, dedup, metrics, split
from tessera.operators import encode as enc_ops
from tessera.operators import vocab as vocab_ops
from tessera.operators.rowindex import positions_by_document
from tessera.plans import recipes
from tessera.session import checkpoint_dir, scratch_path
from tessera.sources import readers, sinks
from tessera.streaming import streams

SEED = 42
NUM_FILES = 32
DEDUP_SHARDS = 4
RECENT_WINDOW = 200
LRU_CACHE = 50
LRU_CHUNK = 512          # several chunks per shard at sf 0.01: the parallel path

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- SQL pieces
def h60_sql(*parts: str) -> str:
    key = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"('0x' || substr(md5({key}), 1, 15))::BIGINT"


# The clean-up patterns, white space and delimiters, the same as in functions/text.py.
SQL_REF_NUMBER = r"\[\p{Nd}+?\]"
SQL_NEED_MARKER = r"\[要.+?\]"
SQL_TEMPLATE = r"\{\{+[^{}]+?\}\}+"
SQL_FOOTNOTE = r" \^ .+"
SQL_ANNOTATION = r"\[(要出典|リンク切れ|.+?\?)\]"
RE2_STRIP = r"^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+\z"
RE2_PIECE = r"[^．。?!？！\n]*[．。?!？！\n]|[^．。?!？！\n]+"
# RE2 has no look-ahead: keep an optional final delimiter through a group.
RE2_SENT_TRIM = r"^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+([．。?!？！]?)$"
# Python's unprintable set on this data: categories C*, Zl, Zp and Zs but U+0020.
RE2_UNPRINTABLE = (r"[\p{C}\p{Zl}\p{Zp}\x{a0}\x{1680}\x{2000}-\x{200a}"
                   r"\x{202f}\x{205f}\x{3000}]")

LINES_CTE = """
lines AS (
  SELECT doc_id, (generate_subscripts(l, 1) - 1)::INTEGER AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""

# normalised (strip; NFKC is the identity on this data) non-empty lines,
# with shard and split
CORPUS_CTE = LINES_CTE + f""",
norm AS (
  SELECT doc_id, line_no, regexp_replace(line, '{RE2_STRIP}', '', 'g') AS line FROM lines),
corpus AS (
  SELECT doc_id, line_no, line,
         ({h60_sql("'42'", "doc_id")} % {NUM_FILES})::INTEGER AS shard,
         CASE WHEN {h60_sql("'42'", "doc_id")} % {NUM_FILES} = {NUM_FILES - 1}
              THEN 'valid' ELSE 'train' END AS split
  FROM norm WHERE length(line) > 0)"""

def sents_sql(src: str = "documents", name: str = "sents") -> str:
    """CTE splitting ``src``'s ``text`` into ``(doc_id, sent_no, sentence)``."""
    return f"""
{name} AS (
  SELECT doc_id, (generate_subscripts(s, 1) - 1)::INTEGER AS sent_no, unnest(s) AS sentence
  FROM (SELECT doc_id,
          list_filter(
            list_transform(regexp_extract_all(text, '{RE2_PIECE}'),
                           lambda x: regexp_replace(x, '{RE2_SENT_TRIM}', '\\1', 'g')),
            lambda x: x <> '') AS s
        FROM {src}))"""


SENTS_CTE = sents_sql()

MARKED_SQL = ("concat('Home > ', lang, ' ', text, ' [', doc_id, '][要出典] {{cite ', source, "
              "'}} xx {{a{{b}}c}} [注', doc_id, '?] [', n_chars, ']', ' ^ note ', source)")


def marked_text() -> F.Column:
    """Same marker-injected text as ``MARKED_SQL``."""
    return F.concat(F.lit("Home > "), "lang", F.lit(" "), "text", F.lit(" ["),
                    F.col("doc_id").cast("string"), F.lit("][要出典] {{cite "), "source",
                    F.lit("}} xx {{a{{b}}c}} [注"), F.col("doc_id").cast("string"),
                    F.lit("?] ["), F.col("n_chars").cast("string"), F.lit("]"),
                    F.lit(" ^ note "), "source")


def marked_docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("title"), marked_text().alias("text"))


# ---------------------------------------------------------------- shared Spark
def doc_lines(spark, sf_dir) -> DataFrame:
    return corpus.explode_lines(table(spark, sf_dir, "documents"))


def corpus_lines(spark, sf_dir) -> DataFrame:
    """G3 -> T12 -> F1 -> P1 -> P2: the plain-text corpus before caps."""
    lines = corpus.explode_lines(table(spark, sf_dir, "documents"), normalize=True)
    lines = corpus.nonempty_lines(lines)
    lines = split.assign_shard(lines, NUM_FILES, seed=SEED)
    return split.train_valid_split(lines, NUM_FILES)


def shard_positions(spark, sf_dir) -> DataFrame:
    """Lines in ``DEDUP_SHARDS`` shards with a dense position inside the shard."""
    lines = split.assign_shard(doc_lines(spark, sf_dir), DEDUP_SHARDS, seed=SEED)
    return positions_by_document(lines, "shard", "doc_id", "line_no", "pos")


SHARD_POS_CTE = LINES_CTE + f""",
sh AS (SELECT *, ({h60_sql("'42'", "doc_id")} % {DEDUP_SHARDS})::INTEGER AS shard FROM lines),
pos AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id, line_no) - 1 AS pos FROM sh),
lagged AS (SELECT *, lag(pos) OVER (PARTITION BY shard, line ORDER BY pos) AS prev FROM pos)"""


# ================================================================ T: text
@register("strip_ws", f"""
SELECT doc_id, regexp_replace(text, '{RE2_STRIP}', '', 'g') AS text FROM documents""")
def q_strip_ws(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.strip_ws("text").alias("text"))


# NFKC is the identity on the driver's documents; full-width cases are in tests.
@register("nfkc", "SELECT doc_id, text FROM documents")
def q_nfkc(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.nfkc("text").alias("text"))


@register("nfkc_fullwidth", "SELECT doc_id, text FROM documents")
def q_nfkc_fullwidth(spark, sf_dir):
    """Signs ! to ~ in their full-width forms and spaces as ideographic ones, which NFKC turns back."""
    plain = "".join(map(chr, range(0x21, 0x7F)))
    wide = "".join(chr(ord(c) + 0xFEE0) for c in plain)
    text = F.translate("text", " " + plain, "\u3000" + wide)
    return table(spark, sf_dir, "documents").select("doc_id", T.nfkc(text).alias("text"))


@register("drop_unprintable", f"""
SELECT doc_id, regexp_replace(text, '{RE2_UNPRINTABLE}', '', 'g') AS text FROM documents""")
def q_drop_unprintable(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", T.drop_unprintable("text").alias("text"))


@register("drop_ref_numbers", f"""
SELECT doc_id, regexp_replace({MARKED_SQL}, '{SQL_REF_NUMBER}', '', 'g') AS text FROM documents""")
def q_drop_ref_numbers(spark, sf_dir):
    return marked_docs(spark, sf_dir).select("doc_id", T.drop_ref_numbers("text").alias("text"))


@register("drop_need_markers", f"""
SELECT doc_id, regexp_replace({MARKED_SQL}, '{SQL_NEED_MARKER}', '', 'g') AS text FROM documents""")
def q_drop_need_markers(spark, sf_dir):
    return marked_docs(spark, sf_dir).select("doc_id", T.drop_need_markers("text").alias("text"))


@register("drop_templates", f"""
SELECT doc_id, regexp_replace({MARKED_SQL}, '{SQL_TEMPLATE}', '', 'g') AS text FROM documents""")
def q_drop_templates(spark, sf_dir):
    return marked_docs(spark, sf_dir).select("doc_id", T.drop_templates("text").alias("text"))


def _nav_sql(c: str, title: str) -> str:
    needle = f"(' > ' || {title})"
    pos = f"(CASE WHEN strpos(substr({c}, 2), {needle}) > 0 THEN strpos(substr({c}, 2), {needle}) + 1 ELSE 0 END)"
    return (f"(CASE WHEN {title} IS NULL OR {pos} = 0 THEN {c} "
            f"ELSE substr({c}, {pos} + length({needle})) END)")


@register("drop_nav_prefix", f"""
SELECT doc_id, {_nav_sql(MARKED_SQL, 'lang')} AS text FROM documents""")
def q_drop_nav_prefix(spark, sf_dir):
    return marked_docs(spark, sf_dir).select("doc_id", T.drop_nav_prefix("text", "title").alias("text"))


@register("drop_footnotes", f"""
SELECT doc_id, regexp_replace({MARKED_SQL}, '{SQL_FOOTNOTE}', '', 'g') AS text FROM documents""")
def q_drop_footnotes(spark, sf_dir):
    return marked_docs(spark, sf_dir).select("doc_id", T.drop_footnotes("text").alias("text"))


@register("drop_annotations", f"""
SELECT doc_id, regexp_replace({MARKED_SQL}, '{SQL_ANNOTATION}', '', 'g') AS text FROM documents""")
def q_drop_annotations(spark, sf_dir):
    return marked_docs(spark, sf_dir).select("doc_id", T.drop_annotations("text").alias("text"))


@register("collapse_ws", f"""
SELECT doc_id, trim(regexp_replace(regexp_replace(text, '{RE2_UNPRINTABLE}', ' ', 'g'), ' +', ' ', 'g')) AS text
FROM documents""")
def q_collapse_ws(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    spaced = F.regexp_replace("text", RE2_UNPRINTABLE, " ")
    return docs.select("doc_id", T.collapse_ws(spaced).alias("text"))


def _clean_sql(c: str, title: str) -> str:
    x = f"regexp_replace({c}, '{RE2_UNPRINTABLE}', '', 'g')"
    x = f"regexp_replace({x}, '{SQL_REF_NUMBER}', '', 'g')"
    x = f"regexp_replace({x}, '{SQL_NEED_MARKER}', '', 'g')"
    x = f"regexp_replace({x}, '{SQL_TEMPLATE}', '', 'g')"
    x = _nav_sql(x, title)
    x = f"regexp_replace({x}, '{SQL_FOOTNOTE}', '', 'g')"
    x = f"regexp_replace({x}, '{SQL_ANNOTATION}', '', 'g')"
    return f"trim(regexp_replace({x}, ' +', ' ', 'g'))"


@register("clean_wiki_text", f"""
SELECT doc_id, {_clean_sql(MARKED_SQL, 'lang')} AS text FROM documents""")
def q_clean_wiki_text(spark, sf_dir):
    return marked_docs(spark, sf_dir).select("doc_id", T.clean_wiki_text("text", "title").alias("text"))


@register("normalize_line", f"""
WITH {LINES_CTE}
SELECT doc_id, line_no, regexp_replace(line, '{RE2_STRIP}', '', 'g') AS line FROM lines""")
def q_normalize_line(spark, sf_dir):
    return doc_lines(spark, sf_dir).withColumn("line", T.normalize_line("line"))


# ================================================================ G, F
@register("nonempty_lines", f"""
WITH {LINES_CTE}
SELECT doc_id, line_no, line FROM (
  SELECT doc_id, line_no, regexp_replace(line, '{RE2_STRIP}', '', 'g') AS line FROM lines)
WHERE length(line) > 0""")
def q_nonempty_lines(spark, sf_dir):
    return corpus.nonempty_lines(corpus.explode_lines(table(spark, sf_dir, "documents"), normalize=True))


@register("drop_blank_lines", f"""
WITH {LINES_CTE}
SELECT doc_id, line_no, line FROM lines
WHERE regexp_replace(line, '{RE2_STRIP}', '', 'g') <> ''""")
def q_drop_blank_lines(spark, sf_dir):
    return corpus.drop_blank_lines(doc_lines(spark, sf_dir), "line")


@register("split_sentences", f"""
WITH {SENTS_CTE}
SELECT doc_id, sent_no, sentence FROM sents""")
def q_split_sentences(spark, sf_dir):
    return corpus.split_sentences(table(spark, sf_dir, "documents"))


@register("length_between", f"""
WITH {SENTS_CTE}
SELECT doc_id, sent_no, sentence FROM sents WHERE length(sentence) BETWEEN 10 AND 1000""")
def q_length_between(spark, sf_dir):
    return corpus.length_between(corpus.split_sentences(table(spark, sf_dir, "documents")),
                                 "sentence", 10, 1000)


@register("random_spans", f"""
WITH d AS (SELECT doc_id, text, length(text) AS len FROM documents WHERE length(text) >= 50),
dr AS (
  SELECT doc_id, len, span_no, 50 + {h60_sql("'42'", "doc_id", "span_no")} % 151 AS r
  FROM (SELECT doc_id, len, unnest(range(0, ceil(len / 50.0)::BIGINT))::INTEGER AS span_no FROM d)),
st AS (
  SELECT *, coalesce(sum(r) OVER (PARTITION BY doc_id ORDER BY span_no
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM dr)
SELECT st.doc_id, span_no, start, least(r, st.len - start) AS span_len,
       substr(d.text, (start + 1)::BIGINT, least(r, st.len - start)) AS span
FROM st JOIN d ON st.doc_id = d.doc_id
WHERE st.len - start >= 50""")
def q_random_spans(spark, sf_dir):
    return corpus.random_spans(table(spark, sf_dir, "documents"), 50, 200, seed=SEED)


# ================================================================ P: shards
@register("assign_shard", f"""
WITH {LINES_CTE}
SELECT doc_id, line_no, line, ({h60_sql("'42'", "doc_id")} % {NUM_FILES})::INTEGER AS shard FROM lines""")
def q_assign_shard(spark, sf_dir):
    return split.assign_shard(doc_lines(spark, sf_dir), NUM_FILES, seed=SEED)


@register("train_valid_split", f"""
WITH {CORPUS_CTE}
SELECT split, count(*) AS n_lines, count(DISTINCT doc_id) AS n_docs FROM corpus GROUP BY split""")
def q_train_valid_split(spark, sf_dir):
    return corpus_lines(spark, sf_dir).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_lines"), F.countDistinct("doc_id").alias("n_docs"))


# ================================================================ L: caps, samples
@register("limit_sentences", f"""
WITH {CORPUS_CTE}
SELECT doc_id, line_no, line FROM corpus ORDER BY doc_id, line_no LIMIT 5000""")
def q_limit_sentences(spark, sf_dir):
    lines = corpus_lines(spark, sf_dir).select("doc_id", "line_no", "line")
    return split.limit_sentences(lines, 5000, method="prefix")


@register("limit_documents", """
SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 300""")
def q_limit_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split.limit_documents(docs, 300)


@register("head_lines", f"""
WITH {CORPUS_CTE}
SELECT doc_id, line_no, line FROM corpus WHERE split = 'valid' ORDER BY doc_id, line_no LIMIT 200""")
def q_head_lines(spark, sf_dir):
    valid = corpus_lines(spark, sf_dir).where("split = 'valid'").select("doc_id", "line_no", "line")
    return split.head_lines(valid, 200)


@register("bootstrap_sample", f"""
WITH {CORPUS_CTE},
v AS (SELECT doc_id, line_no, line, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS idx
      FROM corpus WHERE split = 'valid'),
d AS (SELECT range AS draw, {h60_sql("'42'", "range")} % (SELECT count(*) FROM v) AS idx FROM range(300))
SELECT d.draw, v.doc_id, v.line_no, v.line FROM d JOIN v ON d.idx = v.idx""")
def q_bootstrap_sample(spark, sf_dir):
    valid = corpus_lines(spark, sf_dir).where("split = 'valid'").select("doc_id", "line_no", "line")
    return split.bootstrap_sample(valid, 300, seed=SEED).select("draw", "doc_id", "line_no", "line")


@register("shuffle_sample", f"""
WITH {CORPUS_CTE}
SELECT doc_id, line_no, line, {h60_sql("'42'", "doc_id", "line_no")} AS sample_key
FROM corpus WHERE split = 'train' AND line <> ''
ORDER BY sample_key, doc_id, line_no LIMIT 1000""")
def q_shuffle_sample(spark, sf_dir):
    train = corpus.drop_empty_lines(
        corpus_lines(spark, sf_dir).where("split = 'train'").select("doc_id", "line_no", "line"))
    return split.shuffle_sample(train, 1000, seed=SEED)


# ================================================================ D: dedup
@register("dedup_exact", f"""
WITH {SENTS_CTE},
f AS (SELECT * FROM sents WHERE length(sentence) BETWEEN 10 AND 1000)
SELECT doc_id, sent_no, sentence FROM (
  SELECT *, row_number() OVER (PARTITION BY sentence ORDER BY doc_id, sent_no) AS rn FROM f)
WHERE rn = 1""")
def q_dedup_exact(spark, sf_dir):
    sents = corpus.length_between(corpus.split_sentences(table(spark, sf_dir, "documents")),
                                  "sentence", 10, 1000)
    return dedup.dedup_exact(sents, "sentence", ["doc_id", "sent_no"])


@register("dedup_recent", f"""
WITH {SHARD_POS_CTE}
SELECT doc_id, line_no, line, shard, pos FROM lagged
WHERE prev IS NULL OR pos - prev > {RECENT_WINDOW}""")
def q_dedup_recent(spark, sf_dir):
    return dedup.dedup_recent(shard_positions(spark, sf_dir), RECENT_WINDOW, value_col="line") \
        .select("doc_id", "line_no", "line", "shard", "pos")


@register("dedup_lru", f"""
WITH {SHARD_POS_CTE}
SELECT a.doc_id, a.line_no, a.line, a.shard, a.pos FROM lagged a
WHERE a.prev IS NULL
   OR (SELECT count(DISTINCT b.line) FROM pos b
       WHERE b.shard = a.shard AND b.pos > a.prev AND b.pos < a.pos) >= {LRU_CACHE}""")
def q_dedup_lru(spark, sf_dir):
    return dedup.dedup_lru(shard_positions(spark, sf_dir), LRU_CACHE, value_col="line",
                           chunk_len=LRU_CHUNK) \
        .select("doc_id", "line_no", "line", "shard", "pos")


# ================================================================ S: sources
def _stage(spark, name: str, df: DataFrame, fmt: str = "text") -> str:
    """Write a table derived from the driver data under the checkpoint folder."""
    path = scratch_path(spark, name)
    df.write.format(fmt).save(path)
    return path


@register("read_lines", """
SELECT unnest(string_split(text, chr(10))) AS line FROM documents""")
def q_read_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    return readers.read_lines(spark, _stage(spark, "lines", docs))


@register("read_paragraphs", """
SELECT text, len(string_split(text, chr(10)))::INTEGER AS n_lines FROM documents""")
def q_read_paragraphs(spark, sf_dir):
    # one document per paragraph: its text, then a blank line
    docs = table(spark, sf_dir, "documents").select(F.concat("text", F.lit("\n")).alias("t"))
    paras = readers.read_paragraphs(spark, _stage(spark, "paras", docs))
    return paras.select(F.array_join("lines", "\n").alias("text"), F.size("lines").alias("n_lines"))


@register("json_docs", """
SELECT source AS title, text FROM documents WHERE text IS NOT NULL AND text <> ''""")
def q_json_docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # a metadata line before every document, as in search-index dumps
    meta = docs.select(F.to_json(F.struct(F.struct(F.col("doc_id").alias("_id")).alias("index")))
                       .alias("j"))
    body = docs.select(F.to_json(F.struct(F.col("source").alias("title"), "text")).alias("j"))
    return readers.read_json_docs(spark, _stage(spark, "json", meta.unionByName(body)))


@register("read_dataset", "SELECT text FROM documents")
def q_read_dataset(spark, sf_dir):
    train, _ = readers.read_dataset(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return readers.text_column(train)


@register("text_column", "SELECT doc_id AS text FROM labels")
def q_text_column(spark, sf_dir):
    return readers.text_column(table(spark, sf_dir, "labels"))


# ================================================================ R1, R2, E6
def _first_lines_cte(n: int) -> str:
    return LINES_CTE + f""",
norm AS (
  SELECT doc_id, line_no, regexp_replace(line, '{RE2_STRIP}', '', 'g') AS line FROM lines),
firstn AS (SELECT * FROM norm WHERE length(line) > 0 ORDER BY doc_id, line_no LIMIT {n}),
c AS (
  SELECT doc_id, line_no, line,
         ({h60_sql("'42'", "doc_id")} % {NUM_FILES})::INTEGER AS shard,
         CASE WHEN {h60_sql("'42'", "doc_id")} % {NUM_FILES} = {NUM_FILES - 1}
              THEN 'valid' ELSE 'train' END AS split
  FROM firstn)"""


@register("corpus_plain", f"""
WITH {_first_lines_cte(8000)},
v AS (SELECT *, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS idx FROM c WHERE split = 'valid'),
d AS (SELECT range AS draw, {h60_sql("'42'", "range")} % (SELECT count(*) FROM v) AS idx FROM range(200))
SELECT split, shard, doc_id, line_no, line FROM c WHERE split = 'train'
UNION ALL
SELECT v.split, v.shard, v.doc_id, v.line_no, v.line FROM d JOIN v ON d.idx = v.idx""")
def q_corpus_plain(spark, sf_dir):
    return recipes.corpus_plain(table(spark, sf_dir, "documents"), NUM_FILES,
                                max_sentences=8000, max_valid_sentences=200, seed=SEED)


@register("corpus_plain_all", f"""
WITH {CORPUS_CTE}
SELECT split, shard, doc_id, line_no, line FROM corpus""")
def q_corpus_plain_all(spark, sf_dir):
    return recipes.corpus_plain(table(spark, sf_dir, "documents"), NUM_FILES, seed=SEED)


@register("corpus_plain_files", f"""
WITH {LINES_CTE},
cut AS (SELECT doc_id, line_no, regexp_replace(line, '{RE2_STRIP}', '', 'g') AS line FROM lines),
-- a document without a line is no paragraph
keys AS (SELECT source_id, row_number() OVER (ORDER BY source_id) - 1 AS doc_id
         FROM (SELECT DISTINCT doc_id AS source_id FROM cut WHERE line <> '')),
para AS (SELECT k.doc_id, (row_number() OVER (PARTITION BY k.doc_id ORDER BY line_no) - 1)::INTEGER AS line_no, line
         FROM cut c JOIN keys k ON c.doc_id = k.source_id WHERE line <> '')
SELECT CASE WHEN {h60_sql("'42'", "doc_id")} % {NUM_FILES} = {NUM_FILES - 1} THEN 'valid' ELSE 'train' END AS split,
       ({h60_sql("'42'", "doc_id")} % {NUM_FILES})::INTEGER AS shard, doc_id, line_no, line FROM para""")
def q_corpus_plain_files(spark, sf_dir):
    """The documents as text files in id order, lines ended by CR LF, a blank line after each, and back as a corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered = docs.select(F.concat(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s*\n\s*", "\r\n"), F.lit("\r\n \t\r")).alias("t"))
    path = scratch_path(spark, "files")
    ordered.write.text(path)
    return recipes.corpus_plain_files(spark, path, NUM_FILES, seed=SEED)


@register("corpus_counts", f"""
WITH {CORPUS_CTE}
SELECT split, count(*) AS n_sentences, count(DISTINCT shard) AS n_files FROM corpus GROUP BY split""")
def q_corpus_counts(spark, sf_dir):
    lines = recipes.corpus_plain(table(spark, sf_dir, "documents"), NUM_FILES, seed=SEED)
    return metrics.corpus_counts(lines)


@register("corpus_wiki", f"""
WITH cleaned AS (SELECT doc_id, {_clean_sql(MARKED_SQL, 'lang')} AS text FROM documents),
{sents_sql("cleaned", "s")},
f AS (SELECT * FROM s WHERE length(sentence) BETWEEN 10 AND 1000),
d AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY sentence ORDER BY doc_id, sent_no) AS rn FROM f)
      WHERE rn = 1)
SELECT CASE WHEN {h60_sql("'42'", "doc_id")} % {NUM_FILES} = {NUM_FILES - 1}
            THEN 'valid' ELSE 'train' END AS split,
       ({h60_sql("'42'", "doc_id")} % {NUM_FILES})::INTEGER AS shard,
       doc_id, sent_no, sentence
FROM d""")
def q_corpus_wiki(spark, sf_dir):
    return recipes.corpus_wiki(marked_docs(spark, sf_dir), NUM_FILES, seed=SEED)


# ================================================================ W: words, vocabulary
SPECIALS_SQL = " UNION ALL ".join(
    f"SELECT {i}::INTEGER AS token_id, '{p}' AS piece"
    for i, p in enumerate(vocab_ops.special_token_list(10)))

WORDS_CTE = f"""
words AS (
  SELECT doc_id, (generate_subscripts(w, 1) - 1)::INTEGER AS word_no, unnest(w) AS word
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '{T.WHITE_SPACE_CLASS}+'),
                                   lambda x: x <> '') AS w FROM documents)),
counts AS (SELECT word, count(*) AS n FROM words GROUP BY word)"""

# Query vocabulary, derived from ``documents``: every character, its ``##``
# form, the 2,000 most frequent words and ``##`` + the 500 most frequent.
VOCAB_CTE = WORDS_CTE + f""",
chars AS (SELECT DISTINCT unnest(regexp_extract_all(word, '(?s).')) AS c FROM counts),
topw AS (SELECT word FROM counts ORDER BY n DESC, word LIMIT 2000),
top5 AS (SELECT word FROM counts ORDER BY n DESC, word LIMIT 500),
pieces AS (SELECT c AS piece FROM chars UNION SELECT '##' || c FROM chars
           UNION SELECT word FROM topw UNION SELECT '##' || word FROM top5),
specials AS ({SPECIALS_SQL}),
vocab AS (
  SELECT token_id, piece FROM specials
  UNION ALL
  SELECT (row_number() OVER (ORDER BY piece) + 14)::INTEGER AS token_id, piece
  FROM pieces WHERE piece NOT IN (SELECT piece FROM specials))"""


def doc_words(spark, sf_dir) -> DataFrame:
    return vocab_ops.pretokenize(table(spark, sf_dir, "documents"), "text", ["doc_id"])


def data_vocab(spark, sf_dir) -> DataFrame:
    checkpoint_dir(spark)
    # the counts feed four selections below: compute them once
    counts = vocab_ops.word_counts(doc_words(spark, sf_dir)).checkpoint(eager=True)
    chars = vocab_ops.alphabet(counts, None).select(F.col("char").alias("piece"))
    top = counts.orderBy(F.desc("n"), "word").limit(2000).select(F.col("word").alias("piece"))
    top5 = counts.orderBy(F.desc("n"), "word").limit(500).select(F.col("word").alias("piece"))
    cont = F.concat(F.lit("##"), F.col("piece")).alias("piece")
    pieces = chars.unionByName(chars.select(cont)).unionByName(top).unionByName(top5.select(cont))
    return vocab_ops.with_special_tokens(pieces, 10)


@register("pretokenize", f"""
WITH {WORDS_CTE}
SELECT doc_id, word_no, word FROM words""")
def q_pretokenize(spark, sf_dir):
    return doc_words(spark, sf_dir)


@register("word_counts", f"""
WITH {WORDS_CTE}
SELECT word, n FROM counts""")
def q_word_counts(spark, sf_dir):
    return vocab_ops.word_counts(doc_words(spark, sf_dir))


@register("alphabet", f"""
WITH {WORDS_CTE}
SELECT c AS char, sum(n)::BIGINT AS n
FROM (SELECT unnest(regexp_extract_all(word, '(?s).')) AS c, n FROM counts)
GROUP BY c ORDER BY n DESC, c LIMIT 50""")
def q_alphabet(spark, sf_dir):
    return vocab_ops.alphabet(vocab_ops.word_counts(doc_words(spark, sf_dir)), 50)


@register("special_tokens", f"""
WITH {VOCAB_CTE}
SELECT token_id, piece FROM vocab""")
def q_special_tokens(spark, sf_dir):
    return data_vocab(spark, sf_dir)


@register("pair_counts", f"""
WITH {WORDS_CTE},
sym AS (SELECT n, list_transform(regexp_extract_all(word, '(?s).'),
                                 lambda c, i: CASE WHEN i = 1 THEN c ELSE '##' || c END) AS s
        FROM counts),
p AS (SELECT n, s, unnest(range(1, len(s))) AS i FROM sym)
SELECT s[i] AS "left", s[i + 1] AS "right", sum(n)::BIGINT AS n FROM p GROUP BY 1, 2""")
def q_pair_counts(spark, sf_dir):
    counts = vocab_ops.word_counts(doc_words(spark, sf_dir))
    symbols = vocab_ops.word_symbols(counts)          # the whole alphabet
    return vocab_ops.pair_counts(symbols)


# ---------------------------------------------------------------- W6, W7, M*
def conv_words_cte(max_len: int | None = None) -> str:
    return f"""
rows AS (SELECT conv_id, turn, text FROM conversations),
rw AS (
  SELECT conv_id, turn, (generate_subscripts(w, 1) - 1)::INTEGER AS word_no, unnest(w) AS word
  FROM (SELECT conv_id, turn,
               list_filter(regexp_split_to_array(text, '{T.WHITE_SPACE_CLASS}+'),
                           lambda x: x <> '') AS w FROM rows)),
dwords AS (SELECT DISTINCT word FROM rw)"""


SEG_CTE = """
vlen AS (SELECT max(CASE WHEN starts_with(piece, '##') THEN length(piece) - 2
                         ELSE length(piece) END) AS p FROM vocab),
ws AS (SELECT word, length(word) AS len FROM dwords WHERE length(word) <= 100),
st AS (SELECT word, len, unnest(range(0, len)) AS s FROM ws),
cand AS (SELECT word, len, s, unnest(range(1, least((SELECT p FROM vlen), len - s) + 1)) AS l FROM st),
hit AS (
  SELECT c.word, c.len, c.s, c.l, v.token_id FROM cand c JOIN vocab v
    ON v.piece = CASE WHEN c.s = 0 THEN substr(c.word, c.s + 1, c.l)
                      ELSE '##' || substr(c.word, c.s + 1, c.l) END),
best AS (SELECT word, len, s, max(l) AS l, arg_max(token_id, l) AS token_id FROM hit GROUP BY word, len, s),
walk(word, len, pos, ids) AS (
  SELECT word, len, 0::BIGINT, []::INTEGER[] FROM ws
  UNION ALL
  SELECT w.word, w.len, w.pos + b.l, list_append(w.ids, b.token_id::INTEGER)
  FROM walk w JOIN best b ON b.word = w.word AND b.s = w.pos WHERE w.pos < w.len),
seg AS (
  SELECT d.word, coalesce(f.ids, [1]::INTEGER[]) AS ids
  FROM dwords d LEFT JOIN (SELECT word, ids FROM walk WHERE pos = len) f ON d.word = f.word)"""


def enc_cte(max_len: int | None) -> str:
    body = "coalesce(per.ids, []::INTEGER[])"
    if max_len is not None:
        body = f"coalesce(per.ids[1:{max_len - 2}], []::INTEGER[])"
    return f"""
per AS (SELECT conv_id, turn, flatten(list(ids ORDER BY word_no)) AS ids
        FROM rw JOIN seg USING (word) GROUP BY conv_id, turn),
enc AS (SELECT r.conv_id, r.turn, [2]::INTEGER[] || {body} || [3]::INTEGER[] AS input_ids
        FROM rows r LEFT JOIN per ON r.conv_id = per.conv_id AND r.turn = per.turn),
encm AS (SELECT conv_id, turn, input_ids,
                list_transform(input_ids, lambda x: 0) AS token_type_ids,
                list_transform(input_ids, lambda x, i: CASE WHEN i = 1 OR i = len(input_ids)
                                                           THEN 1 ELSE 0 END) AS special_tokens_mask,
                list_transform(input_ids, lambda x: 1) AS attention_mask,
                len(input_ids)::INTEGER AS length
         FROM enc)"""


def full_enc_sql(max_len: int | None) -> str:
    return ("WITH RECURSIVE " + VOCAB_CTE + "," + conv_words_cte() + "," + SEG_CTE + ","
            + enc_cte(max_len))


def _s(c: str) -> str:
    return f"array_to_string({c}, ' ') AS {c}"


def _render(df: DataFrame, cols) -> DataFrame:
    """Arrays as space-joined strings, so both engines hash the same text."""
    for c in cols:
        df = df.withColumn(c, F.array_join(F.col(c).cast("array<string>"), " "))
    return df


ENC_FIELDS = ("input_ids", "token_type_ids", "special_tokens_mask", "attention_mask")


def conv_encoded(spark, sf_dir, max_len: int | None = 64, padding: bool = False,
                 vocab: DataFrame | None = None) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return enc_ops.encode(rows, data_vocab(spark, sf_dir) if vocab is None else vocab, max_len, "text", ["conv_id", "turn"],
                          padding=padding, truncation=max_len is not None)


@register("wordpiece_segment", full_enc_sql(64) + """
SELECT word, array_to_string(ids, ' ') AS ids FROM seg""")
def q_wordpiece_segment(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    words = vocab_ops.pretokenize(rows, "text", ["conv_id", "turn"])
    return _render(enc_ops.wordpiece_segment(words, data_vocab(spark, sf_dir)), ["ids"])


@register("encode", full_enc_sql(64) + f"""
SELECT conv_id, turn, {', '.join(_s(c) for c in ENC_FIELDS)}, length FROM encm""")
def q_encode(spark, sf_dir):
    return _render(conv_encoded(spark, sf_dir, 64), ENC_FIELDS)


@register("encode_whole", full_enc_sql(None) + f"""
SELECT conv_id, turn, {', '.join(_s(c) for c in ENC_FIELDS)}, length FROM encm""")
def q_encode_whole(spark, sf_dir):
    """Without truncation, so that every piece reaches the result."""
    return _render(conv_encoded(spark, sf_dir, None), ENC_FIELDS)


@register("line_by_line", full_enc_sql(64) + f"""
, pad AS (
  SELECT conv_id, turn, length,
         input_ids || list_transform(range(64 - len(input_ids)), lambda x: 0) AS input_ids,
         token_type_ids || list_transform(range(64 - len(input_ids)), lambda x: 0) AS token_type_ids,
         special_tokens_mask || list_transform(range(64 - len(input_ids)), lambda x: 1) AS special_tokens_mask,
         attention_mask || list_transform(range(64 - len(input_ids)), lambda x: 0) AS attention_mask
  FROM encm e JOIN rows r USING (conv_id, turn)
  WHERE regexp_replace(r.text, '{RE2_STRIP}', '', 'g') <> '')
SELECT conv_id, turn, {', '.join(_s(c) for c in ENC_FIELDS)}, length FROM pad""")
def q_line_by_line(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    out = enc_ops.line_by_line(rows, data_vocab(spark, sf_dir), 64, "text", ["conv_id", "turn"],
                               padding=True)
    return _render(out, ENC_FIELDS)


@register("max_samples", full_enc_sql(64) + f"""
SELECT conv_id, turn, {_s('input_ids')}, length FROM encm ORDER BY conv_id, turn LIMIT 100""")
def q_max_samples(spark, sf_dir):
    enc = conv_encoded(spark, sf_dir, 64).select("conv_id", "turn", "input_ids", "length")
    return _render(split.max_samples(enc, 100, ["conv_id", "turn"], staged=True), ["input_ids"])


def _u01_sql(*parts: str) -> str:
    return f"({h60_sql(*parts)} / 1152921504606846976.0)"


@register("pack_blocks", full_enc_sql(None) + """,
ix AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx FROM encm),
gx AS (SELECT *, idx // 100 AS group_id, len(input_ids) AS n FROM ix),
ox AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY group_id ORDER BY idx
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off,
              (sum(n) OVER (PARTITION BY group_id))::BIGINT AS total FROM gx),
tok AS (SELECT group_id, total, off + j AS q, input_ids[j + 1] AS t_id, token_type_ids[j + 1] AS t_tt,
               attention_mask[j + 1] AS t_am, special_tokens_mask[j + 1] AS t_sm
        FROM (SELECT *, unnest(range(0, n)) AS j FROM ox)),
kept AS (SELECT *, q // 128 AS block_no FROM tok WHERE total < 128 OR q < (total // 128) * 128)
SELECT group_id, block_no,
       array_to_string(list(t_id ORDER BY q), ' ') AS input_ids,
       array_to_string(list(t_tt ORDER BY q), ' ') AS token_type_ids,
       array_to_string(list(t_am ORDER BY q), ' ') AS attention_mask,
       array_to_string(list(t_sm ORDER BY q), ' ') AS special_tokens_mask
FROM kept GROUP BY group_id, block_no""")
def q_pack_blocks(spark, sf_dir):
    enc = conv_encoded(spark, sf_dir, None)
    return _render(enc_ops.pack_blocks(enc, 128, ["conv_id", "turn"], group_rows=100), ENC_FIELDS)


def _md5_field_sql(digest: str, k: int) -> str:
    return f"(('0x' || substr({digest}, {10 * k + 1}, 10))::BIGINT)"


MASK_CTE = f""",
d AS (SELECT conv_id, turn, input_ids, special_tokens_mask, (SELECT count(*) FROM vocab) AS nv,
             list_transform(input_ids, lambda x, i: md5('42:0:' || CAST(conv_id AS VARCHAR) || ':'
                 || CAST(turn AS VARCHAR) || ':' || CAST(i - 1 AS VARCHAR))) AS dg
      FROM encm),
m AS (SELECT *, list_transform(input_ids, lambda x, i: special_tokens_mask[i] = 0
                 AND {_md5_field_sql("dg[i]", 0)} / 1099511627776.0 < 0.15) AS chosen FROM d),
masked AS (SELECT conv_id, turn,
  list_transform(input_ids, lambda x, i: CASE
      WHEN NOT chosen[i] THEN x
      WHEN {_md5_field_sql("dg[i]", 1)} / 1099511627776.0 < 0.8 THEN 4
      WHEN {_md5_field_sql("dg[i]", 1)} / 1099511627776.0 < 0.9
        THEN ({_md5_field_sql("dg[i]", 2)} % nv)::INTEGER
      ELSE x END) AS input_ids,
  list_transform(input_ids, lambda x, i: CASE WHEN chosen[i] THEN x ELSE -100 END) AS labels
FROM m)"""


@register("mask_tokens", full_enc_sql(64) + MASK_CTE + f"""
SELECT conv_id, turn, {_s('input_ids')}, {_s('labels')} FROM masked""")
def q_mask_tokens(spark, sf_dir):
    vocab = data_vocab(spark, sf_dir)
    n_vocab = vocab.count()
    enc = conv_encoded(spark, sf_dir, 64, vocab=vocab)
    out = enc_ops.mask_tokens(enc, n_vocab, 4, 0.15, SEED, 0, ["conv_id", "turn"])
    return _render(out.select("conv_id", "turn", "input_ids", "labels"), ["input_ids", "labels"])


@register("mask_tokens_whole", full_enc_sql(None) + MASK_CTE + f"""
SELECT conv_id, turn, {_s('input_ids')}, {_s('labels')} FROM masked""")
def q_mask_tokens_whole(spark, sf_dir):
    """Of whole texts."""
    vocab = data_vocab(spark, sf_dir)
    n_vocab = vocab.count()
    enc = conv_encoded(spark, sf_dir, None, vocab=vocab)
    out = enc_ops.mask_tokens(enc, n_vocab, 4, 0.15, SEED, 0, ["conv_id", "turn"])
    return _render(out.select("conv_id", "turn", "input_ids", "labels"), ["input_ids", "labels"])


LB_CTE = f""",
hx AS (SELECT conv_id, turn, length, {h60_sql("'42'", "conv_id", "turn")} AS h FROM encm),
rx AS (SELECT *, row_number() OVER (ORDER BY h, conv_id, turn) - 1 AS rank FROM hx),
nn AS (SELECT greatest(least(count(*) // 128, 50), 1) AS mult FROM hx),
mx AS (SELECT *, rank // (32 * (SELECT mult FROM nn)) AS mega FROM rx),
px AS (SELECT *, row_number() OVER (PARTITION BY mega ORDER BY length DESC, rank) - 1 AS pos FROM mx),
star AS (SELECT mega AS m FROM px WHERE pos = 0 ORDER BY length DESC, mega LIMIT 1),
sw AS (SELECT *, CASE WHEN pos = 0 AND mega = 0 THEN (SELECT m FROM star)
                      WHEN pos = 0 AND mega = (SELECT m FROM star) THEN 0 ELSE mega END AS mega2 FROM px),
lb AS (SELECT conv_id, turn, length, rank, (mega2 * (SELECT mult FROM nn) + pos // 32)::BIGINT AS batch_id,
              (pos % 32)::INTEGER AS batch_pos FROM sw)"""


@register("length_batches", full_enc_sql(64) + LB_CTE + """
SELECT conv_id, turn, length, rank, batch_id, batch_pos FROM lb""")
def q_length_batches(spark, sf_dir):
    enc = conv_encoded(spark, sf_dir, 64).select("conv_id", "turn", "length")
    return enc_ops.length_batches(enc, 32, None, SEED, ["conv_id", "turn"]).select(
        "conv_id", "turn", "length", "rank", "batch_id", "batch_pos")


@register("length_batches_whole", full_enc_sql(None) + LB_CTE + """
SELECT conv_id, turn, length, rank, batch_id, batch_pos FROM lb""")
def q_length_batches_whole(spark, sf_dir):
    """Of whole texts."""
    enc = conv_encoded(spark, sf_dir, None).select("conv_id", "turn", "length")
    return enc_ops.length_batches(enc, 32, None, SEED, ["conv_id", "turn"]).select(
        "conv_id", "turn", "length", "rank", "batch_id", "batch_pos")


@register("pad_batch", full_enc_sql(64) + LB_CTE + """,
tg AS (SELECT lb.conv_id, lb.turn, lb.batch_id, e.input_ids, e.attention_mask,
              (ceil(max(lb.length) OVER (PARTITION BY lb.batch_id) / 8.0) * 8)::INTEGER AS target
       FROM lb JOIN encm e ON lb.conv_id = e.conv_id AND lb.turn = e.turn)
SELECT conv_id, turn, batch_id,
  array_to_string(input_ids || list_transform(range(target - len(input_ids)), lambda x: 0), ' ') AS input_ids,
  array_to_string(attention_mask || list_transform(range(target - len(input_ids)), lambda x: 0), ' ')
    AS attention_mask
FROM tg""")
def q_pad_batch(spark, sf_dir):
    enc = conv_encoded(spark, sf_dir, 64)
    lb = enc_ops.length_batches(enc, 32, None, SEED, ["conv_id", "turn"])
    out = enc_ops.pad_batch(lb, "batch_id", 8)
    return _render(out.select("conv_id", "turn", "batch_id", "input_ids", "attention_mask"),
                   ["input_ids", "attention_mask"])


# ================================================================ E: evaluation
PRED_CTE = """
pred AS (SELECT vec_id, vec_id // 32 AS batch_id, embedding,
                (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS pred, label
         FROM embeddings)"""

LOSS_SQL = ("(list_max(list_transform(embedding, lambda x: x::DOUBLE)) + ln(list_sum(list_transform("
            "embedding, lambda x: exp(x::DOUBLE - list_max(list_transform(embedding, lambda y: y::DOUBLE)))))) "
            "- embedding[label + 1]::DOUBLE)")


def predictions(spark, sf_dir) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", F.floor(F.col("vec_id") / 32).alias("batch_id"), "embedding",
                      metrics.argmax("embedding").alias("pred"), "label")


@register("argmax", f"WITH {PRED_CTE} SELECT vec_id, pred FROM pred")
def q_argmax(spark, sf_dir):
    return predictions(spark, sf_dir).select("vec_id", "pred")


@register("masked_accuracy", f"""
WITH {PRED_CTE}
SELECT avg(CASE WHEN pred = label THEN 1 ELSE 0 END) AS accuracy, count(*) AS n_scored
FROM pred WHERE label <> -100""")
def q_masked_accuracy(spark, sf_dir):
    return metrics.masked_accuracy(predictions(spark, sf_dir))


@register("accuracy_by_batch", f"""
WITH {PRED_CTE},
b AS (SELECT batch_id, sum(CASE WHEN pred = label THEN 1 ELSE 0 END) AS c, count(*) AS t
      FROM pred WHERE label <> -100 GROUP BY batch_id)
SELECT sum(c) / sum(t) AS accuracy, sum(c)::BIGINT AS n_correct, sum(t)::BIGINT AS n_scored,
       count(*) AS n_batches FROM b""")
def q_accuracy_by_batch(spark, sf_dir):
    return metrics.accuracy_by_batch(predictions(spark, sf_dir))


# Every label of an even class is -100, so that about half of the positions are not scored.
IGNORED_CTE = PRED_CTE.replace(", label\n", ", CASE WHEN label % 2 = 0 THEN -100 ELSE label END AS label\n")


def ignored(spark, sf_dir) -> DataFrame:
    return predictions(spark, sf_dir).withColumn("label", F.when(F.col("label") % 2 == 0, -100).otherwise(F.col("label")))


@register("accuracy_by_batch_ignored", f"""
WITH {IGNORED_CTE},
b AS (SELECT batch_id, sum(CASE WHEN pred = label THEN 1 ELSE 0 END) AS c, count(*) AS t
      FROM pred WHERE label <> -100 GROUP BY batch_id)
SELECT sum(c) / sum(t) AS accuracy, sum(c)::BIGINT AS n_correct, sum(t)::BIGINT AS n_scored,
       count(*) AS n_batches FROM b""")
def q_accuracy_by_batch_ignored(spark, sf_dir):
    return metrics.accuracy_by_batch(ignored(spark, sf_dir))


@register("masked_accuracy_ignored", f"""
WITH {IGNORED_CTE}
SELECT avg(CASE WHEN pred = label THEN 1 ELSE 0 END) AS accuracy, count(*) AS n_scored
FROM pred WHERE label <> -100""")
def q_masked_accuracy_ignored(spark, sf_dir):
    return metrics.masked_accuracy(ignored(spark, sf_dir))


@register("perplexity_ignored", f"""
WITH {IGNORED_CTE},
l AS (SELECT {LOSS_SQL} AS loss FROM pred WHERE label <> -100)
SELECT round(avg(loss), 6) AS eval_loss, round(exp(avg(loss)), 6) AS perplexity FROM l""")
def q_perplexity_ignored(spark, sf_dir):
    p = metrics.scored(ignored(spark, sf_dir))
    out = metrics.perplexity(p.select(metrics.token_loss("embedding", "label").alias("loss")))
    return out.select(F.round("eval_loss", 6).alias("eval_loss"), F.round("perplexity", 6).alias("perplexity"))


@register("evaluation_ignored", f"""
WITH {IGNORED_CTE},
s AS (SELECT *, {LOSS_SQL} AS loss FROM pred WHERE label <> -100)
SELECT (sum(CASE WHEN pred = label THEN 1 ELSE 0 END) / count(*)) AS accuracy,
       count(*) AS n_scored, round(avg(loss), 6) AS eval_loss, round(exp(avg(loss)), 6) AS perplexity,
       (SELECT count(*) FROM embeddings) AS samples
FROM s""")
def q_evaluation_ignored(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("label") % 2 == 0, -100).otherwise(F.col("label")))
    return recipes.evaluation(rows, "embedding", "label", "vec_id")


@register("perplexity", f"""
WITH {PRED_CTE},
l AS (SELECT {LOSS_SQL} AS loss FROM pred WHERE label <> -100)
SELECT round(avg(loss), 6) AS eval_loss, round(exp(avg(loss)), 6) AS perplexity FROM l""")
def q_perplexity(spark, sf_dir):
    p = metrics.scored(predictions(spark, sf_dir))
    out = metrics.perplexity(p.select(metrics.token_loss("embedding", "label").alias("loss")))
    return out.select(F.round("eval_loss", 6).alias("eval_loss"), F.round("perplexity", 6).alias("perplexity"))


@register("sample_counts", f"""
WITH {CORPUS_CTE}
SELECT split, least(500, count(*)) AS samples FROM corpus GROUP BY split""")
def q_sample_counts(spark, sf_dir):
    return metrics.sample_counts(corpus_lines(spark, sf_dir), 500)


@register("evaluation", f"""
WITH {PRED_CTE},
first AS (SELECT * FROM pred ORDER BY vec_id LIMIT 1000),
s AS (SELECT *, {LOSS_SQL} AS loss FROM first WHERE label <> -100)
SELECT (sum(CASE WHEN pred = label THEN 1 ELSE 0 END) / count(*)) AS accuracy,
       count(*) AS n_scored, round(avg(loss), 6) AS eval_loss, round(exp(avg(loss)), 6) AS perplexity,
       least(1000, (SELECT count(*) FROM embeddings)) AS samples
FROM s""")
def q_evaluation(spark, sf_dir):
    return recipes.evaluation(table(spark, sf_dir, "embeddings"), "embedding", "label",
                              "vec_id", max_samples=1000)


# ================================================================ R3, R4, W4
def learn_sql(size: int, counts: str = "counts", least: int = 2) -> str:
    """One merge a step over whole words in a recursive query; symbols stand between two private-use signs."""
    return f"""
sym AS (SELECT n, list_transform(regexp_extract_all(word, '(?s).'), lambda c, i: CASE WHEN i = 1 THEN c ELSE '##' || c END) AS s FROM {counts}),
firsts AS (SELECT DISTINCT unnest(regexp_extract_all(word, '(?s).')) AS piece FROM {counts}),
nexts AS (SELECT DISTINCT unnest(s[2:]) AS piece FROM sym),
base AS (
  SELECT token_id, piece FROM ({SPECIALS_SQL}) UNION ALL
  SELECT 14 + row_number() OVER (ORDER BY kind, piece), piece FROM (
    SELECT 1 AS kind, piece FROM firsts UNION ALL SELECT 2, piece FROM nexts WHERE piece NOT IN (SELECT piece FROM firsts))),
learn(i, n, s, new) AS (
  SELECT 0, n, chr(57344) || array_to_string(s, chr(57345) || chr(57344)) || chr(57345), NULL::VARCHAR FROM sym WHERE len(s) > 1
  UNION ALL
  SELECT l.i + 1, l.n, replace(l.s, chr(57344) || p.a || chr(57345) || chr(57344) || p.b || chr(57345), chr(57344) || p.new || chr(57345)), p.new
  FROM learn l, (
    SELECT a, b, a || substr(b, 3) AS new FROM (
      SELECT n, s[k] AS a, s[k + 1] AS b FROM (
        SELECT n, s, unnest(range(1, len(s))) AS k FROM (
          SELECT n, string_split(substr(s, 2, length(s) - 2), chr(57345) || chr(57344)) AS s FROM learn)))
    GROUP BY a, b HAVING sum(n) >= {least}
    ORDER BY sum(n) DESC, length(a) + length(b) - 2 - CASE WHEN starts_with(a, '##') THEN 2 ELSE 0 END, a, b LIMIT 1) p
  WHERE l.i < {size} - (SELECT count(*) FROM base)),
found AS (SELECT new, min(i) AS i FROM learn WHERE new IS NOT NULL GROUP BY new)
SELECT token_id::INTEGER AS token_id, piece FROM base
UNION ALL SELECT ((SELECT count(*) FROM base) + row_number() OVER (ORDER BY i) - 1)::INTEGER, new FROM found"""

@register("learn_wordpiece", f"WITH RECURSIVE {WORDS_CTE}, {learn_sql(400)}")
def q_learn_wordpiece(spark, sf_dir):
    counts = vocab_ops.word_counts(doc_words(spark, sf_dir))
    return vocab_ops.learn_wordpiece(counts, vocab_size=400, limit_alphabet=6129)


@register("vocabulary", f"""
WITH RECURSIVE {CORPUS_CTE},
drawn AS (SELECT line FROM corpus WHERE split = 'train' AND line <> ''
          ORDER BY {h60_sql("'42'", "doc_id", "line_no")}, doc_id, line_no LIMIT 5000),
lwords AS (SELECT unnest(list_filter(regexp_split_to_array(line, '{T.WHITE_SPACE_CLASS}+'), lambda x: x <> '')) AS word FROM drawn),
lcounts AS (SELECT word, count(*) AS n FROM lwords GROUP BY word), {learn_sql(600, "lcounts")}""")
def q_vocabulary(spark, sf_dir):
    """R3: a sample of the training lines to the learned vocabulary; the sample and the size are the recipe's parameters."""
    train = corpus_lines(spark, sf_dir).where("split = 'train'").select("doc_id", "line_no", "line")
    return recipes.vocabulary(train, sample_size=5000, vocab_size=600, seed=SEED)


def _pad_sql(c: str, fill: int) -> str:
    return f"array_to_string({c} || list_transform(range(target - n), lambda x: {fill}), ' ') AS {c}"


@register("training_table", full_enc_sql(64) + LB_CTE + MASK_CTE + f""",
tg AS (SELECT lb.conv_id, lb.turn, lb.batch_id, lb.batch_pos, k.input_ids, e.token_type_ids,
              e.special_tokens_mask, e.attention_mask, k.labels, lb.length AS n,
              (ceil(max(lb.length) OVER (PARTITION BY lb.batch_id) / 8.0) * 8)::INTEGER AS target
       FROM lb JOIN encm e ON lb.conv_id = e.conv_id AND lb.turn = e.turn
               JOIN masked k ON lb.conv_id = k.conv_id AND lb.turn = k.turn)
SELECT conv_id, turn, batch_id, batch_pos, {_pad_sql('input_ids', 0)}, {_pad_sql('token_type_ids', 0)},
       {_pad_sql('special_tokens_mask', 1)}, {_pad_sql('attention_mask', 0)}, {_pad_sql('labels', -100)}
FROM tg""")
def q_training_table(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    out = recipes.training_table(conv, data_vocab(spark, sf_dir), True, 64, None, 32,
                                 seed=SEED, id_cols=["conv_id", "turn"])
    return _render(out.select("conv_id", "turn", "batch_id", "batch_pos", *ENC_FIELDS, "labels"),
                   [*ENC_FIELDS, "labels"])


# ================================================================ K: sinks, written and read again
@register("write_shards", f"""
WITH {CORPUS_CTE}
SELECT split, shard, line FROM corpus""")
def q_write_shards(spark, sf_dir):
    path = scratch_path(spark, "shards")
    sinks.write_shards(corpus_lines(spark, sf_dir), path, NUM_FILES)
    return sinks.read_shards(spark, path).select("split", "shard", "line")


@register("append_shards", f"""
WITH {CORPUS_CTE}
SELECT split, shard, line FROM corpus""")
def q_append_shards(spark, sf_dir):
    """The valid split is added to the written train split."""
    path, lines = scratch_path(spark, "appended"), corpus_lines(spark, sf_dir)
    sinks.write_shards(lines.where("split = 'train'"), path, NUM_FILES)
    sinks.write_shards(lines.where("split = 'valid'"), path, NUM_FILES, mode="append")
    return sinks.read_shards(spark, path).select("split", "shard", "line")


@register("write_vocab", f"""
WITH {VOCAB_CTE}
SELECT token_id, piece FROM vocab""")
def q_write_vocab(spark, sf_dir):
    """K4 and W8: the vocabulary file, read back with its ids."""
    file = sinks.write_vocab(data_vocab(spark, sf_dir), scratch_path(spark, "vocab"))
    return vocab_ops.load_vocab(spark, file).select(F.col("token_id").cast("int").alias("token_id"), "piece")


@register("write_metrics", f"""
WITH {PRED_CTE}
SELECT avg(CASE WHEN pred = label THEN 1 ELSE 0 END) AS accuracy, count(*) AS n_scored, 'valid' AS split
FROM pred WHERE label <> -100""")
def q_write_metrics(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(metrics.masked_accuracy(predictions(spark, sf_dir)), path, "valid")
    return spark.read.json(path).select("accuracy", "n_scored", "split")


@register("cached_stage", "SELECT doc_id, text FROM documents")
def q_cached_stage(spark, sf_dir):
    """The second call reads what the first one wrote."""
    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "stage")
    sinks.cached_stage(docs, path)
    return sinks.cached_stage(docs, path)


# ================================================================ X: streams over everything available
def _stream(spark, name: str, df: DataFrame) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


STREAM_SENTS_CTE = f"""cleaned AS (SELECT doc_id, {_clean_sql(MARKED_SQL, 'lang')} AS text FROM documents),
{sents_sql("cleaned", "s")},
f AS (SELECT * FROM s WHERE length(sentence) BETWEEN 10 AND 1000)"""


@register("stream_clean", f"""
WITH {STREAM_SENTS_CTE}
SELECT doc_id, sent_no, sentence FROM f""")
def q_stream_clean(spark, sf_dir):
    docs = _stream(spark, "stream-docs", marked_docs(spark, sf_dir))
    return streams.run_available(streams.stream_clean(docs), "clean").select("doc_id", "sent_no", "sentence")


@register("stream_dedup", f"""
WITH {STREAM_SENTS_CTE}
SELECT DISTINCT sentence FROM f""")
def q_stream_dedup(spark, sf_dir):
    """Sentences only: which of the equal ones arrives first is open."""
    docs = marked_docs(spark, sf_dir).withColumn("ingest_ts", F.timestamp_seconds(F.lit(1_704_067_200)))
    sents = streams.stream_clean(_stream(spark, "stream-sents", docs))
    return streams.run_available(streams.stream_dedup(sents), "dedup").select("sentence")


@register("stream_accuracy", f"""
WITH {PRED_CTE}
SELECT sum(CASE WHEN pred = label THEN 1 ELSE 0 END)::BIGINT AS n_correct, count(*) AS n_scored,
       avg(CASE WHEN pred = label THEN 1 ELSE 0 END) AS accuracy
FROM pred WHERE label <> -100""")
def q_stream_accuracy(spark, sf_dir):
    preds = _stream(spark, "stream-preds", predictions(spark, sf_dir).select("pred", "label"))
    return streams.run_available(streams.stream_accuracy(preds), "accuracy", "complete")
