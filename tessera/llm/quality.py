"""Quality rules with cross-document line frequency (DataFrame functions only).

Per document: word and symbol counts, repeated lines, words in repeated
three-word windows.  Across documents: every normalised line (lower case,
white space collapsed, trimmed) is hashed with its host, the documents of the
host that hold it are counted, lines held by more than
``max(min_docs, share * documents of the host)`` are removed, and a document is
depleted when too little of it is left.

What counts as a document is the caller's: ``per="id"`` counts distinct ids that
hold the line against the rows of the host, as the query's SQL does (a null id
holds no line); ``per="text"`` counts distinct texts against the host's distinct
texts, so copies of one text count once and never make its lines boiler-plate.

Defined cases: a null text counts as empty (no words, so it fails the base
rule); a null host is a host of its own; rows with the same id are judged row
by row; identical rows get identical verdicts; an empty table gives an empty
result.  Only ``id_col``, ``text_col`` and ``host_col`` are read, other columns
pass through untouched in :func:`filter_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORD = r"[^\x20\x09-\x0D]+"
NOT_WORD = r"[\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
#: A line is boiler-plate when more documents of its host hold it than both of these.
MIN_DOCS, SHARE = 20, 0.05
#: A document is depleted when fewer words than MIN_WORDS, or a smaller share than MIN_LEFT, are left.
MIN_WORDS, MIN_LEFT = 50, 0.3
#: Copies of the (small) boiler-plate table, so that a line of a third of all documents meets in many tasks.
SALT = 16
#: Up to so many repeated windows, membership is tested by scanning them; beyond, by sorting.
SCAN = 48


def _row_key(id_col: str, text_col: str, host_col: str) -> Column:
    return F.struct(F.col(id_col).alias("k_id"),
                    F.xxhash64(F.col(host_col), F.col(text_col), F.col(host_col).isNull()).alias("k_row"))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))


def _line_hash(host: Column, line: Column) -> Column:
    norm = F.trim(F.regexp_replace(F.lower(line), NOT_WORD, " "))
    return F.xxhash64(host, host.isNull(), norm)


def _covered(starts: Column) -> Column:
    """Words that three-word windows at ascending ``starts`` cover together."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(
        starts, zero,
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"])


def base_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts added; one scan, no shuffle.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long) and
    ``base_failed``.  Windows are compared by a 64-bit hash of their words.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.col("_q_lines")
    words = F.col("_q_words")
    win = F.col("_q_win")
    d = docs.withColumns({"_q_words": F.regexp_extract_all(t, F.lit(WORD), 0), "_q_lines": _lines(t)})
    d = d.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(t, NOT_WORD, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(t, NOT_SYMBOL, "")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "_q_win": F.when(F.size(words) >= 3, F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
        .otherwise(F.array().cast("array<bigint>")),
    }).drop("_q_words", "_q_lines")
    d = d.withColumn("_q_sorted", F.when(F.size(F.array_distinct(win)) < F.size(win), F.sort_array(win))
                     .otherwise(F.array().cast("array<bigint>")))
    s = F.col("_q_sorted")
    d = d.withColumn("_q_rep", F.array_distinct(F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1)))))
    rep, pairs = F.col("_q_rep"), F.col("_q_pairs")
    few = F.filter(F.transform(win, lambda h, i: F.when(F.array_contains(rep, h), i)), lambda p: p.isNotNull())
    d = d.withColumn("_q_pairs", F.when(
        F.size(rep) > SCAN, F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    many = F.sort_array(F.transform(F.filter(
        pairs, lambda x, i: F.coalesce(F.get(pairs, i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(pairs, i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))
    d = d.withColumn("n_repeat_words", F.when(F.size(rep) == 0, F.lit(0).cast("long"))
                     .when(F.size(rep) > SCAN, _covered(many)).otherwise(_covered(few)))
    # through a generator, so that a filter on the counts is not moved below them and evaluated many times over
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    d = d.select(*docs.columns, F.inline(F.array(F.struct(*counts))))
    return d.withColumn("base_failed", (F.col("n_words") < 50)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def boilerplate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      host_col: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE,
                      per: str = "id") -> DataFrame:
    """``line_hash, n_docs``: lines held by more than ``max(min_docs, share * n)`` of a host's ``n`` documents.

    The hash covers the host.  Each document, by ``per``, counts once for a line: the
    rows are dealt by host, line and document, so a line of every document is spread.
    """
    if per not in ("id", "text"):
        raise ValueError(f"per must be 'id' or 'text', not {per!r}")
    host = F.col(host_col)
    t = F.coalesce(F.col(text_col), F.lit(""))
    one = F.col(id_col) if per == "id" else F.xxhash64(t)
    per_line = (docs.select(host.alias("_h"), one.alias("_d"), _lines(t).alias("_l"))
                .select("_h", "_d", F.explode(F.array_distinct(F.transform(
                    F.col("_l"), lambda x: _line_hash(F.col("_h"), x)))).alias("line_hash"))
                .groupBy("_h", "line_hash").agg(F.countDistinct("_d").alias("n_docs"))
                .where(F.col("n_docs") > min_docs))
    hosts = docs.groupBy(host.alias("_g")).agg((F.count(F.lit(1)) if per == "id" else F.countDistinct(one)).alias("_n"))
    return (per_line.join(hosts, F.col("_h").eqNullSafe(F.col("_g")))
            .where(F.col("n_docs") > share * F.col("_n"))
            .select("line_hash", "n_docs"))


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE,
                  per: str = "id") -> DataFrame:
    """``key, removed_words, line_hashes`` of the rows that hold boiler-plate lines.

    Only (key, hash, words) rows meet the boiler-plate table; the join is salted
    by document, so a very common line is spread over SALT tasks at least.
    """
    host = F.col(host_col)
    t = F.coalesce(F.col(text_col), F.lit(""))
    frequent = (boilerplate_lines(docs, id_col, text_col, host_col, min_docs, share, per)
                .select("line_hash", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")))
    key = _row_key(id_col, text_col, host_col)
    per_row = (docs.select(key.alias("key"), host.alias("_h"), _lines(t).alias("_l"))
               .select("key", F.posexplode(F.transform(F.col("_l"), lambda x: F.struct(
                   _line_hash(F.col("_h"), x).alias("line_hash"),
                   F.size(F.regexp_extract_all(x, F.lit(WORD), 0)).alias("words")))).alias("pos", "l"))
               .select("key", "pos", F.col("l.line_hash"), F.col("l.words"),
                       F.pmod(F.xxhash64("key"), F.lit(SALT)).cast("int").alias("salt")))
    # identical rows share a key: one row per line position, whatever their number
    return (per_row.join(frequent, ["line_hash", "salt"])
            .groupBy("key", "pos").agg(F.min("line_hash").alias("line_hash"), F.min("words").alias("words"))
            .groupBy("key").agg(F.sum("words").alias("removed_words"),
                                F.collect_set("line_hash").alias("line_hashes")))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  min_docs: int = MIN_DOCS, share: float = SHARE,
                  min_words: int = MIN_WORDS, min_left: float = MIN_LEFT, per: str = "id") -> DataFrame:
    """One row per row of ``docs``: id, base counts, ``removed_words, depleted, kept``.

    Texts do not shuffle: counts and the removed words meet on the row key.
    """
    key = _row_key(id_col, text_col, host_col)
    base = (base_metrics(docs.select(F.col(id_col).alias("doc_id"), key.alias("key"),
                                     F.col(text_col).alias("_t")), "_t").drop("_t"))
    gone = (removed_lines(docs, id_col, text_col, host_col, min_docs, share, per)
            .select(F.col("key").alias("_k"), "removed_words"))
    left = F.col("n_words") - F.col("removed_words")
    return (base.join(gone, F.col("key").eqNullSafe(F.col("_k")), "left")
            .withColumn("removed_words", F.coalesce(F.col("removed_words"), F.lit(0).cast("long")))
            .withColumn("depleted", (F.col("removed_words") > 0)
                        & ((left < min_words) | (left < min_left * F.col("n_words"))))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
            .drop("key", "_k"))


def filter_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                     min_docs: int = MIN_DOCS, share: float = SHARE,
                     min_words: int = MIN_WORDS, min_left: float = MIN_LEFT, per: str = "id") -> DataFrame:
    """Kept rows with all their columns; boiler-plate lines are cut from ``text_col``.

    A text without such a line is returned byte for byte.  Columns may have any names.
    """
    cols = docs.columns
    id_col, text_col, host_col = (f"in_{cols.index(c)}" for c in (id_col, text_col, host_col))
    docs = docs.toDF(*[f"in_{i}" for i in range(len(cols))])
    key = _row_key(id_col, text_col, host_col)
    base = base_metrics(docs.withColumn("_key", key), text_col)
    gone = (removed_lines(docs, id_col, text_col, host_col, min_docs, share, per)
            .select(F.col("key").alias("_k"), F.col("removed_words").alias("_gone"), F.col("line_hashes").alias("_cut")))
    left = F.col("n_words") - F.col("_gone")
    out = (base.where(~F.col("base_failed"))
           .join(gone, F.col("_key").eqNullSafe(F.col("_k")), "left")
           .where(F.col("_gone").isNull() | ((left >= min_words) & (left >= min_left * F.col("n_words")))))
    kept = F.array_join(F.filter(
        F.split(F.col(text_col), "\n", -1),
        lambda x: ~(x.rlike(WORD) & F.array_contains(F.col("_cut"), _line_hash(F.col(host_col), x)))), "\n")
    return (out.withColumn(text_col, F.when(F.col("_cut").isNull(), F.col(text_col)).otherwise(kept))
            .select(*docs.columns).toDF(*cols))


#: DuckDB restatement of the query; limits as above.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
x AS (SELECT doc_id, unnest(list_transform(range(1, len(words) - 1), lambda i: {'i': i, 'g': words[i:i+2]})) AS u
      FROM w WHERE len(words) >= 3),
r AS (SELECT doc_id, u.i AS i, count(*) OVER (PARTITION BY doc_id, u.g) AS c FROM x),
p AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS l FROM r WHERE c > 1),
rep AS (SELECT doc_id, sum(CASE WHEN l IS NULL THEN 3 ELSE least(3, i - l) END)::BIGINT AS n FROM p GROUP BY doc_id),
base AS (SELECT w.doc_id, source, len(words)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
ln AS (SELECT doc_id, source, unnest(lines) AS line FROM w),
nl AS (SELECT doc_id, source, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
        len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM ln),
freq AS (SELECT source, line, count(DISTINCT doc_id) AS c FROM nl GROUP BY source, line),
hosts AS (SELECT source, count(*) AS n FROM d GROUP BY source),
bad AS (SELECT f.source, f.line FROM freq f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
        WHERE c > 20 AND c > 0.05 * n),
gone AS (SELECT nl.doc_id, sum(nl.words)::BIGINT AS removed FROM nl JOIN bad
         ON nl.line = bad.line AND nl.source IS NOT DISTINCT FROM bad.source GROUP BY nl.doc_id),
j AS (SELECT base.*, coalesce(removed, 0)::BIGINT AS removed_words FROM base LEFT JOIN gone ON base.doc_id = gone.doc_id),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        removed_words > 0 AND (n_words - removed_words < 50 OR n_words - removed_words < 0.3 * n_words) AS depleted FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words, depleted,
       NOT base_failed AND NOT depleted AS kept FROM v
"""
