"""Scalar text functions (Column -> Column).

All cleaning steps except Unicode normalisation are JVM regular expressions,
so they stay inside whole-stage codegen.  NFKC and the printable-character
filter have no JVM built-in with Python's Unicode tables; they share one
Arrow UDF hop.  Strings that are ASCII (and printable) stay Arrow data as they
are; of the others a worker holds ``PIECE`` bytes at a time as Python strings,
so its memory does not grow with the batch or the table.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
#
# Python's str.strip() whitespace set, written as a Java / RE2 class.
PY_WS_CLASS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
PY_WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# Sentence delimiters: FULLWIDTH FULL STOP, IDEOGRAPHIC FULL STOP, ?, !,
# FULLWIDTH QUESTION MARK, FULLWIDTH EXCLAMATION MARK, newline.
SENTENCE_DELIMS = "．。?!？！\n"
# Encyclopedia clean-up: reference numbers, "needs ..." markers, templates,
# footnotes to the end, annotations ("citation needed", "dead link", doubts).
RE_REF_NUMBER = r"\[\p{Nd}+?\]"
RE_NEED_MARKER = r"\[要.+?\]"
RE_TEMPLATE = r"\{\{+[^{}]+?\}\}+"
RE_FOOTNOTE = r" \^ .+"
RE_ANNOTATION = r"\[(要出典|リンク切れ|.+?\?)\]"
# Unicode White_Space (the whitespace pre-tokeniser's split set).
WHITE_SPACE_CLASS = (
    r"[\t-\r\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]"
)
# ---------------------------------------------------------------------------

_DELIM_CLASS = "[" + SENTENCE_DELIMS.replace("\n", r"\n") + "]"
_NON_DELIM_CLASS = "[^" + SENTENCE_DELIMS.replace("\n", r"\n") + "]"
_NON_NL_DELIMS = "[" + SENTENCE_DELIMS.replace("\n", "") + "]"

RE_STRIP = rf"^{PY_WS_CLASS}+|{PY_WS_CLASS}+\z"
RE_SENTENCE_PIECE = rf"{_NON_DELIM_CLASS}*{_DELIM_CLASS}|{_NON_DELIM_CLASS}+"
# leading blanks, or blanks just before an optional final non-newline delimiter
RE_SENTENCE_TRIM = rf"^{PY_WS_CLASS}+|{PY_WS_CLASS}+(?={_NON_NL_DELIMS}?\z)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- T1, T10
def strip_ws(col) -> Column:
    """Strip Python whitespace at both ends (``trim`` strips ASCII space only)."""
    return F.regexp_replace(_c(col), RE_STRIP, "")


def collapse_ws(col) -> Column:
    """Runs of spaces to one space, then strip (input has no other blanks)."""
    return F.trim(F.regexp_replace(_c(col), " +", " "))


# ---------------------------------------------------------------- T2, T3
def nfkc_py(s):
    return None if s is None else unicodedata.normalize("NFKC", s)


def printable_py(s):
    """Drop the characters ``str.isprintable`` rejects (categories C*, Z*
    except U+0020).  Line breaks and tabs, the usual culprits, go first with
    ``str.replace``; only if something else remains are the string's distinct
    characters tested."""
    if s is None or s.isprintable():
        return s
    for c in _USUAL_UNPRINTABLE:
        if c in s:
            s = s.replace(c, "")
    if s.isprintable():
        return s
    for c in {c for c in set(s) if not c.isprintable()}:
        s = s.replace(c, "")
    return s


_USUAL_UNPRINTABLE = ("\n", "\r", "\t")


#: Bytes of text that a worker turns into Python strings at once.
PIECE = 1 << 20


def each_string(values: pa.Array, plain: pa.Array, fn) -> pa.Array:
    """``values`` with ``fn`` applied where ``plain`` is not true, piece by piece; nulls stay."""
    same = pc.or_kleene(plain, values.is_null()).fill_null(False).to_numpy(zero_copy_only=False)
    if same.all():
        return values
    sizes = pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = np.cumsum(sizes) // PIECE
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(values)]]).tolist()
    parts = []
    for lo, hi in zip(cuts, cuts[1:]):
        part = values.slice(lo, hi - lo)
        if not same[lo:hi].all():
            part = pa.array([None if x is None else fn(x) for x in part.to_pylist()], values.type)
        parts.append(part)
    return pa.concat_arrays(parts)


def nfkc_arrow(values: pa.Array) -> pa.Array:
    """NFKC of an Arrow array of strings; ASCII is its own."""
    return each_string(values, pc.string_is_ascii(values), nfkc_py)


def strip_arrow(values: pa.Array) -> pa.Array:
    """:func:`strip_ws` of an Arrow array of strings."""
    return pc.utf8_trim(values, characters=PY_WS)


def normalize_line_arrow(values: pa.Array) -> pa.Array:
    """:func:`normalize_line` of an Arrow array of strings."""
    return nfkc_arrow(strip_arrow(values))


def printable_arrow(values: pa.Array) -> pa.Array:
    """:func:`printable_py` of an Arrow array of strings."""
    return each_string(values, pc.ascii_is_printable(values), printable_py)


@F.arrow_udf(StringType())
def nfkc(s: pa.Array) -> pa.Array:
    """Unicode NFKC (T2)."""
    return nfkc_arrow(s)


@F.arrow_udf(StringType())
def nfkc_printable(s: pa.Array) -> pa.Array:
    """NFKC, then drop characters Python deems unprintable (T2 then T3)."""
    return each_string(s, pc.ascii_is_printable(s), lambda v: printable_py(nfkc_py(v)))


@F.arrow_udf(ArrayType(StringType()))
def nfkc_array(s: pa.Array) -> pa.Array:
    """NFKC of every element of an array column.

    Normalising the whole array before an explode keeps later filters on the
    elements from being pushed below the Python hop (which would run it twice).
    """
    return pa.ListArray.from_arrays(s.offsets, nfkc_arrow(s.values), mask=s.is_null() if s.null_count else None)


@F.arrow_udf(StringType())
def drop_unprintable(s: pa.Array) -> pa.Array:
    """Delete characters of categories C* and Z* except U+0020 (T3)."""
    return printable_arrow(s)


# ---------------------------------------------------------------- T4..T9
def drop_ref_numbers(col) -> Column:
    """Remove reference numbers such as ``[12]`` (any Unicode digits)."""
    return F.regexp_replace(_c(col), RE_REF_NUMBER, "")


def drop_need_markers(col) -> Column:
    """Remove "needs ..." markers, shortest match."""
    return F.regexp_replace(_c(col), RE_NEED_MARKER, "")


def drop_templates(col) -> Column:
    """Remove ``{{...}}`` without inner braces; one pass."""
    return F.regexp_replace(_c(col), RE_TEMPLATE, "")


def drop_nav_prefix(col, title) -> Column:
    """Remove everything up to the first `` > title`` (at least one char before).

    The title is matched literally; a null title leaves the text unchanged.
    """
    c, t = _c(col), _c(title)
    needle = F.concat(F.lit(" > "), t)
    pos = F.position(needle, c, F.lit(2))
    return F.when(t.isNull() | (pos == 0), c).otherwise(
        c.substr(pos + F.length(needle), F.lit(2147483647)))


def drop_footnotes(col) -> Column:
    """Remove from the first `` ^ `` (followed by text) to the end."""
    return F.regexp_replace(_c(col), RE_FOOTNOTE, "")


def drop_annotations(col) -> Column:
    """Remove citation-needed / dead-link annotations and ``[...?]``."""
    return F.regexp_replace(_c(col), RE_ANNOTATION, "")


# ---------------------------------------------------------------- T11, T12
def clean_wiki_text(text, title=None) -> Column:
    """The encyclopedia clean-up chain T2 T3 T4 T5 T6 T7 T8 T9 T10."""
    c = nfkc_printable(_c(text))
    c = drop_ref_numbers(c)
    c = drop_need_markers(c)
    c = drop_templates(c)
    if title is not None:
        c = drop_nav_prefix(c, title)
    c = drop_footnotes(c)
    c = drop_annotations(c)
    return collapse_ws(c)


def normalize_line(col) -> Column:
    """Strip, then NFKC (in this order; NFKC may add a leading space)."""
    return nfkc(strip_ws(col))


# ---------------------------------------------------------------- helpers
def sentence_array(col) -> Column:
    """Sentences of a text as an array, before NFKC (G1 without normalising).

    Cut after each delimiter; strip the text part, keep the delimiter unless
    it is a newline, drop empty pieces.
    """
    pieces = F.regexp_extract_all(_c(col), F.lit(RE_SENTENCE_PIECE), 0)
    trimmed = F.transform(pieces, lambda p: F.regexp_replace(p, RE_SENTENCE_TRIM, ""))
    return F.filter(trimmed, lambda p: p != "")


def whitespace_words(col) -> Column:
    """Words split on Unicode White_Space, empties removed."""
    return F.filter(F.split(_c(col), WHITE_SPACE_CLASS + "+"), lambda w: w != "")
