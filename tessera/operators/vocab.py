"""Words, counts and the WordPiece vocabulary: W1-W5, W8."""

from __future__ import annotations

from typing import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tessera.functions import text as T
from tessera.operators.merging import PairMerger, product as merged_piece  # noqa: F401
from tessera.operators.rowindex import with_row_index
from tessera.session import checkpoint_dir

# ---------------------------------------------------------------------------
# The special tokens, in id order, then <unusedN> tokens.
SPECIAL_TOKENS = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]")
UNUSED_TEMPLATE = "<unused{}>"
CONTINUATION_PREFIX = "##"
# Unicode White_Space, stripped by the normaliser before an analyser runs.
WHITE_SPACE_CHARS = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
                     "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
ANALYSER_MODES = ("unidic_lite", "unidic", "ipadic")
# ---------------------------------------------------------------------------


def special_token_list(num_unused: int = 10) -> list[str]:
    return list(SPECIAL_TOKENS) + [UNUSED_TEMPLATE.format(i) for i in range(num_unused)]


# ------------------------------------------------------------------ W1
def pretokenize(df: DataFrame, text_col: str = "text", id_cols=("doc_id",),
                mode: str = "whitespace",
                splitter: Callable[[str], list[str]] | None = None,
                outer: bool = False) -> DataFrame:
    """NFKC, then words ``(ids..., word_no, word)``.

    The normaliser's strip removes Unicode White_Space at the ends, which the
    whitespace split drops anyway, so it is not a separate step.

    ``whitespace`` splits on Unicode White_Space inside the JVM.  The analyser
    modes need a caller-supplied ``splitter(text) -> list[str]`` (the
    morphological analyser is a per-row library); it runs in one Arrow batch
    UDF.  Any other mode is an error.  ``outer`` keeps rows without words
    (one row with a null word).
    """
    explode = F.posexplode_outer if outer else F.posexplode
    return df.select(*id_cols, explode(word_array(text_col, mode, splitter)).alias("word_no", "word"))


def word_array(text_col: str, mode: str = "whitespace",
               splitter: Callable[[str], list[str]] | None = None) -> Column:
    """The words of :func:`pretokenize` as an array column."""
    normalized = T.nfkc(F.col(text_col))
    if mode == "whitespace":
        return T.whitespace_words(normalized)
    if mode in ANALYSER_MODES:
        if splitter is None:
            raise ValueError(f"mode {mode!r} needs a splitter function")

        @F.arrow_udf(ArrayType(StringType()))
        def _split(s: pa.Array) -> pa.Array:
            return pa.array([None if t is None else [w for w in splitter(t.strip(WHITE_SPACE_CHARS)) if w]
                             for t in s.to_pylist()], pa.list_(s.type))

        return _split(normalized)
    raise ValueError(f"unknown word mode {mode!r}")


# ------------------------------------------------------------------ W2
def word_counts(words: DataFrame, word_col: str = "word") -> DataFrame:
    """Corpus word frequencies ``(word, n)`` (combined map-side first)."""
    return words.groupBy(F.col(word_col).alias("word")).agg(F.count(F.lit(1)).alias("n"))


def chars_of(col) -> F.Column:
    """Array of the code points of a string, as strings."""
    return F.regexp_extract_all(col, F.lit("(?s)."), 0)


# ------------------------------------------------------------------ W3
def alphabet(counts: DataFrame, limit: int | None = 6129) -> DataFrame:
    """Characters weighted by word count; the ``limit`` most frequent kept.

    Ties at the cut go to the smaller code point.  Output ``(char, n)``.
    """
    chars = counts.select(F.explode(chars_of(F.col("word"))).alias("char"), "n")
    totals = chars.groupBy("char").agg(F.sum("n").alias("n"))
    if limit is None:
        return totals
    return totals.orderBy(F.desc("n"), "char").limit(limit)


# ------------------------------------------------------------------ W5
def with_special_tokens(pieces: DataFrame, num_unused: int = 10,
                        piece_col: str = "piece") -> DataFrame:
    """Vocabulary ``(token_id, piece)``: special tokens first (ids 0..),
    then the distinct pieces in code-point order.

    The learned pieces are numbered with the range-partitioned row index,
    so the vocabulary never passes through one task.
    """
    spark = pieces.sparkSession
    specials = special_token_list(num_unused)
    head = spark.createDataFrame([(i, p) for i, p in enumerate(specials)],
                                 "token_id int, piece string")
    rest = (pieces.select(F.col(piece_col).alias("piece")).distinct()
            .where(~F.col("piece").isin(specials)))
    rest = with_row_index(rest, ["piece"], "_i").select(
        (F.col("_i") + len(specials)).cast("int").alias("token_id"), "piece")
    return head.unionByName(rest)


# ------------------------------------------------------------------ W8
def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``vocab.txt`` -> ``(token_id, piece)``; the id is the line number."""
    lines = spark.read.text(path).withColumn("_m", F.monotonically_increasing_id())
    return with_row_index(lines, ["_m"], "_i").select(
        F.col("_i").cast("int").alias("token_id"), F.col("value").alias("piece"))


# ------------------------------------------------------------------ W4
def word_symbols(counts: DataFrame, alphabet_df: DataFrame | None = None) -> DataFrame:
    """Initial symbols of each distinct word ``(word, n, symbols)``: its
    characters, ``##`` before every character but the word's first;
    characters outside the alphabet (``None``: keep all) are then dropped
    (the prefix follows the position in the original word)."""
    chars = chars_of(F.col("word"))
    syms = F.transform(chars, lambda c, i: F.struct(
        c.alias("c"), F.when(i == 0, c).otherwise(F.concat(F.lit(CONTINUATION_PREFIX), c)).alias("s")))
    if alphabet_df is None:
        return counts.select("word", "n", F.transform(syms, lambda x: x["s"]).alias("symbols"))
    exploded = counts.select("word", "n", F.posexplode_outer(syms).alias("i", "x"))
    marked = exploded.join(F.broadcast(alphabet_df.select(F.col("char").alias("_c"))),
                           F.col("x.c") == F.col("_c"), "left")
    kept = F.when(F.col("_c").isNotNull(), F.struct("i", F.col("x.s").alias("s")))
    return marked.groupBy("word", "n").agg(
        F.transform(F.array_sort(F.collect_list(kept)), lambda t: t["s"]).alias("symbols"))


def pair_counts(symbols: DataFrame) -> DataFrame:
    """Adjacent symbol pairs weighted by word count ``(left, right, n)``."""
    size = F.greatest(F.size("symbols") - 1, F.lit(0))
    pairs = symbols.select("n", F.explode(F.arrays_zip(
        F.slice("symbols", 1, size).alias("l"), F.slice("symbols", 2, size).alias("r"))).alias("p"))
    return (pairs.select(F.col("p.l").alias("left"), F.col("p.r").alias("right"), "n")
            .groupBy("left", "right").agg(F.sum("n").alias("n")))


def learn_wordpiece(counts: DataFrame, vocab_size: int = 32768, limit_alphabet: int | None = 6129,
                    num_unused: int = 10, min_frequency: int = 2, batch: bool = True) -> DataFrame:
    """WordPiece vocabulary by pair merging over the distinct words.

    Start: special tokens, the alphabet in code-point order, then the ``##``
    forms of the characters that occur after a word's first character.  Then
    the best pair is merged again and again, by count (most first), covered characters
    (fewest first), left and right symbol, until there are ``vocab_size`` pieces or the best
    count is below ``min_frequency``.  With ``batch`` a round merges every pair that is known to
    come at its present count (:mod:`tessera.operators.merging`); the result is that of
    one pair at a time.  A ``vocab_size`` below the special tokens and the alphabet
    is an error, never a cut alphabet.

    The counts are checkpointed, as the alphabet and the symbols each read them.
    Output ``(token_id, piece)``.
    """
    spark = counts.sparkSession
    checkpoint_dir(spark)
    counts = counts.select("word", "n").checkpoint(eager=True)
    alpha = alphabet(counts, limit_alphabet)
    alpha_chars = sorted(r["char"] for r in alpha.select("char").collect())  # <= limit rows
    symbols = word_symbols(counts, alpha if limit_alphabet is not None else None) \
        .checkpoint(eager=True)
    cont_rows = symbols.select(F.explode("symbols").alias("s")).where(
        F.col("s").startswith(CONTINUATION_PREFIX)).distinct().collect()
    cont = sorted(r["s"] for r in cont_rows)
    vocab = special_token_list(num_unused)
    known = set(vocab)
    for p in alpha_chars + cont:
        if p not in known:
            vocab.append(p)
            known.add(p)
    if len(vocab) > vocab_size:
        raise ValueError(f"vocab_size {vocab_size} is below the {len(vocab)} special tokens and characters")
    if len(vocab) < vocab_size:
        merger = PairMerger(symbols, sorted({*known, *alpha_chars, *cont}), min_frequency)
        vocab += merger.run(vocab_size - len(vocab), one_at_a_time=not batch)
        merger.close()
    return spark.createDataFrame(list(enumerate(vocab)), "token_id int, piece string")
