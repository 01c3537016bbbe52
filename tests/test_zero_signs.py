"""Extremes of short days that hold zeros of both signs: of equal ones the SQL keeps the last, whose sign decides that of an infinite quotient.

The SQL takes each day alone: beside other days it may meet a day's bars in another order.
"""

from __future__ import annotations

import datetime as dt
import random

import duckdb

from panelforge.plans.catalog import ORACLE, QUERIES


def test_extremes_keep_the_last_zero(spark, tmp_path):
    rnd, rows = random.Random(5), []
    prices = {"zeros": [0.0, -0.0], "below": [0.0, -0.0, -1.0, -2.5], "around": [0.0, -0.0, -0.0, 1.0, -1.0]}
    for kind, some in prices.items():
        for day in range(20):
            for i in range(rnd.randint(3, 12)):
                rows.append((len(rows), dt.datetime(2024, 1, 1, 10) + dt.timedelta(days=day, minutes=4 * i), i, kind, rnd.choice(some), f'{{"k": {rnd.randint(0, 9)}}}'))
    c = duckdb.connect()
    c.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    c.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?, ?)", rows)
    c.execute(f"COPY events TO '{tmp_path}/events.parquet'")
    want, cols = {}, []
    for kind, day in c.execute("SELECT DISTINCT event_type, ts::DATE FROM events").fetchall():
        c.execute(f"CREATE OR REPLACE TEMP VIEW one AS SELECT * FROM events WHERE event_type = '{kind}' AND ts::DATE = '{day}'")
        rel = c.sql(ORACLE["intraday_extremes"].replace("FROM events WINDOW", "FROM one WINDOW"))
        cols = list(rel.columns)
        want |= {r[:2]: r for r in rel.fetchall()}
    got = {(r.entity, r.day): tuple(r[x] for x in cols) for r in QUERIES["intraday_extremes"](spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() and len(got) == 60
    assert {(k, x): (a, b) for k in want for x, a, b in zip(cols, got[k], want[k], strict=True) if repr(a) != repr(b)} == {}
