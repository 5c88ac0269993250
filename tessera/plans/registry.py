"""The query registry as seen by ``__spark_entry__``."""

from __future__ import annotations

from tessera.plans import queries as _q


def queries() -> dict:
    return dict(_q.QUERIES)


def oracle_sql() -> dict:
    return dict(_q.ORACLE)
