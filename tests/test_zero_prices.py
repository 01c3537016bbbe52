"""Intraday queries against their SQL on bars whose price is zero (kept, and divided by as IEEE has it) and on days of equal bars."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from panelforge.functions.nulls import ieee_div
from panelforge.operators import intraday
from panelforge.plans.catalog import ORACLE, QUERIES

NAMES = sorted(n for n in QUERIES if n.startswith("intraday_"))


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    """Zeros at the start, in the first, middle and last bars, at the close, twice in a row and all day; one without; one of equal bars."""
    d = str(tmp_path_factory.mktemp("zero"))
    days = {"start": {0}, "first": {7}, "middle": {45, 46, 70}, "last": {90}, "close": {99}, "all": set(range(100)), "none": set(), "flat": set()}
    rows, i = [], 0
    for day in range(3):
        for e, (kind, zero) in enumerate(days.items()):
            for k in range(100):
                ts = dt.datetime(2024, 1, 1 + day, 9, 25) + dt.timedelta(minutes=3 * k, seconds=e)
                v = 0.0 if k in zero and day != 1 else round(20 + 5 * math.sin(k * (e + 2) + day) + (k * 37 + e) % 11, 2)
                v, size = (20.0, 7) if kind == "flat" else (v, (k * 13 + e) % 40)
                rows.append((i, ts, i % 17, kind, v, f'{{"k": {size}}}'))
                i += 1
    c = duckdb.connect()
    c.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    c.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?, ?)", rows)
    c.execute(f"COPY events TO '{d}/events.parquet'")
    return d, c


def norm(v):
    """NaN, infinity and NULL stay apart."""
    if isinstance(v, (float, Decimal)):
        return "nan" if math.isnan(v) else round(float(v), 6) + 0.0
    return str(v) if isinstance(v, dt.date) else v


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, made, name):
    d, c = made
    rel = c.sql(ORACLE[name])
    cols = list(rel.columns)
    want = {r[:2]: dict(zip(cols, map(norm, r), strict=True)) for r in rel.fetchall()}
    got = {(r.entity, r.day): {k: norm(v) for k, v in r.asDict().items()} for r in QUERIES[name](spark, d).collect()}
    assert got.keys() == want.keys() and len(got) == 24
    assert {(k, x): (got[k][x], want[k][x]) for k in want for x in cols if got[k][x] != want[k][x]} == {}


def test_ieee_div(spark):
    df = spark.sql("SELECT * FROM VALUES (1D, 0D), (-1D, 0D), (0D, 0D), (double('NaN'), 0D), (3D, 2D), (1D, NULL), (NULL, 0D) AS t(a, b)")
    assert [norm(r[0]) for r in df.select(ieee_div("a", "b")).collect()] == [math.inf, -math.inf, "nan", "nan", 1.5, None, None]


def test_operators_keep_dropping_invalid_bars(spark):
    """The default: a bar without a price counts nowhere, and nothing but finite numbers and nulls comes out."""
    bars = spark.createDataFrame([("e", "d", f"10:{i:02d}", *([0.0 if i == 5 else 10.0 + i % 4] * 4), 0.0, 0.0) for i in range(8)], "entity string, day string, hm string, open double, high double, low double, close double, vol double, amount double")
    out = intraday.day_features(intraday.prepare(bars, ["entity", "day"], ["hm"], 3), ["entity", "day"])
    row = out.first().asDict()
    assert row["minute_bar_count"] == 7 and row["minute_daily_vwap"] is None and row["first_5m_amount_ratio"] is None
    assert all(v is None or math.isfinite(v) for v in row.values() if isinstance(v, float))
    raw = intraday.day_features(intraday.prepare(bars, ["entity", "day"], ["hm"], 3, raw=True), ["entity", "day"], "totals", "rolling_extremes", raw=True)
    assert raw.select("minute_bar_count", F.isnan("minute_daily_vwap"), "max_5m_range").first() == (8, True, math.inf)
