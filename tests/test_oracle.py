"""Every panel query against its SQL twin in DuckDB, on the smallest tables."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

from panelforge.plans.catalog import ORACLE, QUERIES

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return str(v) if isinstance(v, (dt.date, dt.datetime)) else v


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(ORACLE[name])
    names = list(rel.columns)
    assert sorted(names) == cols
    want = sorted((tuple(norm(dict(zip(names, r, strict=True))[c]) for c in cols) for r in rel.fetchall()), key=repr)
    assert got == want
