"""Bars of equal time and id: their order is that of the files' names and the places in them, not of the files' sizes, by which Spark reads.

The SQL leaves that order open, and no two runs of it need agree: only the queries are compared, not their SQL."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pytest

from panelforge.plans.catalog import QUERIES

NAMES = ["intraday_extremes", "intraday_rolling_extremes", "intraday_windows"]


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    """The same rows in one file and in three that grow; each time and id thrice, with other values."""
    one, many = (tmp_path_factory.mktemp(x) for x in ("one", "many"))
    (many / "events.parquet").mkdir()
    rnd, rows = random.Random(11), []
    for _ in range(3):
        for i in range(60):
            rows.append((i, dt.datetime(2024, 1, 1 + i // 20, 10) + dt.timedelta(minutes=i % 20), i, "a", round(rnd.uniform(1, 50), 2), f'{{"k": {rnd.randint(0, 9)}}}'))
    c = duckdb.connect()
    c.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    c.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?, ?)", rows)
    c.execute(f"COPY events TO '{one}/events.parquet'")
    for i, (a, b) in enumerate(((0, 20), (20, 70), (70, 180))):
        c.execute(f"COPY (SELECT * FROM events WHERE rowid >= {a} AND rowid < {b} ORDER BY rowid) TO '{many}/events.parquet/part-{i}.parquet'")
    return str(one), str(many)


@pytest.mark.parametrize("name", NAMES)
def test_order_of_files(spark, made, name):
    one, many = (sorted(repr(tuple(r)) for r in QUERIES[name](spark, d).collect()) for d in made)
    assert len(many) == 3 and many == one
