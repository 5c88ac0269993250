"""Every registered query against its DuckDB oracle at sf 0.01 (the
driver's correctness gate, run locally)."""

import math

import duckdb
import pytest

from tessera.plans import registry
from conftest import SF01

TABLES = ("documents embeddings pages benchmark labels conversations events").split()
NAMES = sorted(registry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for _, r in pdf.iterrows()), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = registry.queries()[name](spark, SF01).toPandas()
    want = con.sql(registry.oracle_sql()[name]).df()
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(NAMES)))
def test_query_without_oracle_runs(spark, name):
    assert registry.queries()[name](spark, SF01).count() > 0
