"""Skewness and kurtosis of a day against their SQL where a return is huge, and about the mean where returns hardly vary."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from panelforge.operators import intraday
from panelforge.plans.catalog import ORACLE, QUERIES

from .test_odd_bars import same


def test_moments_of_huge_returns(spark, tmp_path):
    """One price of 1e52 to 1e110: sums of squares are finite and their products not, then cubes and fourth powers are not."""
    rnd, rows = random.Random(11), []
    for day in range(5):
        for e, top in enumerate((52, 60, 80, 100, 110)):
            for i in range(60):
                price = 10.0**top if i == 20 + day else round(rnd.uniform(1, 9), 2)
                rows.append((len(rows), dt.datetime(2024, 1, 1 + day, 10) + dt.timedelta(minutes=4 * i), e, f"e{top}", price, '{"k": 3}'))
    c = duckdb.connect()
    c.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    c.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?, ?)", rows)
    c.execute(f"COPY events TO '{tmp_path}/events.parquet'")
    want = {r[:2]: r[2:] for r in c.sql(ORACLE["intraday_moments"]).fetchall()}
    got = {tuple(r)[:2]: tuple(r)[2:] for r in QUERIES["intraday_moments"](spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() and len(got) == 25
    assert {k: (got[k], v) for k, v in want.items() if not all(map(same, got[k], v))} == {}


def test_operator_keeps_moments_about_the_mean(spark):
    r = [0.01 + 1e-9 * (i % 4 == 0) for i in range(40)]
    df = spark.createDataFrame([(v,) for v in r], "r double").agg(*[c.alias(k) for k, c in intraday.moments().items()])
    row = df.select(F.col("intraday_return_skew"), F.col("realized_kurtosis")).first()
    assert row[0] == pytest.approx(2 / 3**0.5, rel=1e-4) and row[1] == pytest.approx(-2 / 3, rel=1e-4)
