"""Generators (flat-maps) and filters over text tables: G1-G3, F1-F5."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tessera.functions import text as T
from tessera.functions.keyed import h60


# ------------------------------------------------------------------ G3
def explode_lines(df: DataFrame, text_col: str = "text", id_cols=("doc_id",),
                  line_col: str = "line", normalize: bool = False) -> DataFrame:
    """Document -> numbered lines ``(ids..., line_no, line)``.

    Lines end at ``\\n``, ``\\r\\n`` or ``\\r``, as when reading a text file.
    With ``normalize`` each line is stripped and NFKC'd (T12) before the
    explode, in one Arrow call per batch of documents.
    """
    lines = F.split(F.col(text_col), r"\r\n|\r|\n")
    if normalize:
        lines = T.nfkc_array(F.transform(lines, T.strip_ws))
    return df.select(*id_cols, F.posexplode(lines).alias("line_no", line_col))


# ------------------------------------------------------------------ G1
def split_sentences(df: DataFrame, text_col: str = "text", id_cols=("doc_id",),
                    normalize: bool = True, sentence_col: str = "sentence") -> DataFrame:
    """Sentences ``(ids..., sent_no, sentence)``, numbered after dropping empties.

    Cuts after each of the delimiters in ``text.SENTENCE_DELIMS``; the
    ASCII full stop never cuts.  With ``normalize`` each sentence is NFKC'd
    after splitting.
    """
    sents = T.sentence_array(text_col)
    if normalize:
        sents = T.nfkc_array(sents)
    return df.select(*id_cols, F.posexplode(sents).alias("sent_no", sentence_col))


# ------------------------------------------------------------------ G2
def cut_spans(docs: DataFrame, draws: DataFrame, min_len: int, text_col: str = "text",
              id_col: str = "doc_id") -> DataFrame:
    """Spans from given draws ``(id, span_no, r)``: span ``i`` starts after
    the earlier draws, exists while at least ``min_len`` characters remain,
    and is cut to what remains.  ``(id, span_no, start, span_len, span)``."""
    lens = docs.select(id_col, F.length(text_col).alias("_len"))
    w = (Window.partitionBy(id_col).orderBy("span_no")
         .rowsBetween(Window.unboundedPreceding, -1))
    spans = (draws.join(lens, id_col)
                  .withColumn("start", F.coalesce(F.sum("r").over(w), F.lit(0)))
                  .where(F.col("_len") - F.col("start") >= min_len)
                  .select(id_col, "span_no", "start",
                          F.least(F.col("r"), F.col("_len") - F.col("start")).alias("span_len")))
    return (spans.join(docs.select(id_col, text_col), id_col)
                 .select(id_col, "span_no", "start", "span_len",
                         F.col(text_col).substr(F.col("start") + 1, F.col("span_len")).alias("span")))


@F.arrow_udf(ArrayType(LongType()))
def running_starts(draws: pa.Array) -> pa.Array:
    """Sums of the earlier numbers of each array, by one cumulative sum over all of them."""
    flat = draws.values.to_numpy(zero_copy_only=False).astype(np.int64)
    first = draws.offsets.to_numpy().astype(np.int64)
    before = np.append(np.cumsum(flat) - flat, 0)
    starts = before[:-1] - np.repeat(before[first[:-1]], np.diff(first))
    return pa.ListArray.from_arrays(draws.offsets, pa.array(starts, pa.int64()))


def random_spans(df: DataFrame, min_len: int, max_len: int, text_col: str = "text",
                 id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """Contiguous spans of keyed-random length in ``[min_len, max_len]``.

    Draw ``i`` of a document is ``min_len + h60(seed, id, i) % width``; a span
    starts where the previous ones end, is cut to what remains, and a rest
    shorter than ``min_len`` is dropped.  Draws and cuts are array expressions of one
    row and the running starts one cumulative sum over a batch's draws, so the work grows
    with the text, nothing shuffles, and rows that repeat an id are cut each on their own.
    """
    if not 0 < min_len <= max_len:
        raise ValueError("need 0 < min_len <= max_len")
    width = max_len - min_len + 1
    size = F.length(text_col).cast("bigint")
    docs = df.select(id_col, text_col).where(size >= min_len)
    numbers = F.sequence(F.lit(0), F.ceil(size / min_len).cast("int") - 1)
    draws = F.transform(numbers, lambda i: F.lit(min_len) + h60(F.lit(seed), id_col, i) % width)

    def cut(start, i):
        n = F.least(F.get("_r", i), size - start)
        return F.struct(i.alias("span_no"), start.alias("start"), n.alias("span_len"),
                        F.col(text_col).substr((start + 1).cast("int"), n.cast("int")).alias("span"))

    spans = F.transform(F.filter("_starts", lambda start: size - start >= min_len), cut)
    return (docs.withColumn("_r", draws).withColumn("_starts", running_starts("_r"))
                .select(id_col, F.inline(spans)))


# ------------------------------------------------------------------ filters
def nonempty_lines(df: DataFrame, col: str = "line") -> DataFrame:
    """keep lines that are non-empty (after whatever normalisation ran)."""
    return df.where(F.length(col) > 0)


def drop_empty_lines(df: DataFrame, col: str = "line") -> DataFrame:
    """drop exactly-empty lines; whitespace-only lines stay."""
    return df.where(F.col(col) != "")


def drop_blank_lines(df: DataFrame, col: str = "text") -> DataFrame:
    """drop empty and whitespace-only lines."""
    return df.where(T.strip_ws(col) != "")


def drop_empty_text(df: DataFrame, col: str = "text") -> DataFrame:
    """drop records with null or empty text."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def length_between(df: DataFrame, col: str, lo: int = 10, hi: int = 1000) -> DataFrame:
    """``lo <= length(col) <= hi`` in code points."""
    return df.where(F.length(col).between(lo, hi))
