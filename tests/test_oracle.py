"""Every registered query with an oracle agrees with DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from textmill.sources.tables import TABLES

SKIP = {name for name in entry.queries() if not name.startswith("q_")}  # those have tests of their own


def _norm(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(r[c]) for c in cols) for _, r in df.iterrows()), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SKIP))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL).toPandas()
    ddf = con.sql(entry.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert _rows(sdf) == _rows(ddf)


def test_every_query_has_a_callable():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "chunk_no", "subset", "text", "hash"]
    assert df.count() >= 0
