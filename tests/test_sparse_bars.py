"""Intraday queries against their SQL where most bars lack a price."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pytest

from panelforge.plans.catalog import ORACLE, QUERIES

from .test_odd_bars import same


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    """Ten days a kind, of 40 bars; fewer pairs of returns than returns, pairs of one value, none."""
    d, rnd = str(tmp_path_factory.mktemp("sparse")), random.Random(3)
    kinds = {"half": 0.5, "most": 0.7, "nearly all": 0.85, "some": 0.1}
    rows = []
    for kind, lost in kinds.items():
        for day in range(10):
            for i in range(40):
                ts = dt.datetime(2024, 1, 1 + day, 10) + dt.timedelta(minutes=7 * i)
                rows.append((len(rows), ts, i % 17, kind, None if rnd.random() < lost else round(rnd.uniform(1, 9), 2), f'{{"k": {rnd.randint(0, 99)}}}'))
    c = duckdb.connect()
    c.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    c.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?, ?)", rows)
    c.execute(f"COPY events TO '{d}/events.parquet'")
    return d, c


@pytest.mark.parametrize("name", ["intraday_autocorr", "intraday_session_corr", "intraday_signed"])
def test_query(spark, made, name):
    d, c = made
    rel = c.sql(ORACLE[name])
    cols = list(rel.columns)
    want = {r[:2]: dict(zip(cols[2:], r[2:], strict=True)) for r in rel.fetchall()}
    got = {(r.entity, r.day): r.asDict() for r in QUERIES[name](spark, d).collect()}
    assert got.keys() == want.keys() and len(got) == 40
    assert {(k, x): (got[k][x], v) for k, row in want.items() for x, v in row.items() if not same(got[k][x], v)} == {}
