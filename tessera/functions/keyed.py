"""Keyed pseudo-random draws.

Every random choice in the library is a hash of a stable key, so a result
does not depend on partitioning, retries or task order, and an SQL engine
can recompute it.  ``h60`` takes the first 15 hex digits (60 bits) of the MD5
of the ``:``-joined key parts; DuckDB computes the same number as
``('0x' || substr(md5(key), 1, 15))::BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_60 = float(2 ** 60)


def _as_col(part) -> Column:
    if isinstance(part, Column):
        return part.cast("string")
    if isinstance(part, str):
        return F.col(part).cast("string")
    return F.lit(str(part))


def hash_key(*parts) -> Column:
    """``part1:part2:...`` as a string column (ints and columns allowed).

    Plain Python strings name columns; wrap literal strings in ``F.lit``.
    """
    return F.concat_ws(":", *[_as_col(p) for p in parts])


def h60(*parts) -> Column:
    """Uniform 60-bit non-negative bigint from the key parts."""
    return F.conv(F.substring(F.md5(hash_key(*parts)), 1, 15), 16, 10).cast("bigint")


def u01(*parts) -> Column:
    """Uniform double on [0, 1) from the key parts."""
    return h60(*parts) / F.lit(TWO_POW_60)


def h60_sql(key_sql: str) -> str:
    """DuckDB expression for ``h60`` given an SQL expression of the key."""
    return f"('0x' || substr(md5({key_sql}), 1, 15))::BIGINT"
