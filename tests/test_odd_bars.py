"""Intraday queries against their SQL on odd bars: missing ids, prices and entities, zeros with a sign, tiny and huge prices, quotients that are halves at the seventh digit."""

from __future__ import annotations

import datetime as dt
import math
import random

import duckdb
import pytest

from panelforge.functions.nulls import ieee_div
from panelforge.plans.catalog import ORACLE, QUERIES
from panelforge.plans.q_intraday import _round

NAMES = ["intraday_autocorr", "intraday_bipower", "intraday_concentration", "intraday_contrasts", "intraday_entropy", "intraday_extremes", "intraday_gap", "intraday_late", "intraday_moments", "intraday_rolling_extremes", "intraday_session_corr", "intraday_signed", "intraday_vol", "intraday_windows"]


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    """Three days a kind; every second row of ``ids`` lacks its id and shares its time with the row before; days of 640 and 641 bars."""
    d, rnd = str(tmp_path_factory.mktemp("odd")), random.Random(7)
    price = lambda: round(rnd.uniform(1, 50), 2)
    kinds = {
        "ids": lambda i: price(), "missing": lambda i: None if rnd.random() < 0.1 else price(), "none": lambda i: None, "signed": lambda i: -0.0 if i % 20 == 5 else price(),
        "negative": lambda i: price() - 25, "nan": lambda i: math.nan if i == 50 else price(), "infinite": lambda i: -math.inf if i == 40 else price(), "tiny": lambda i: 5e-324 if i % 11 == 0 else price(),
        "huge": lambda i: 1e200 * price() if i % 7 == 0 else price(), "large": lambda i: price(), "flat": lambda i: 7.0, None: lambda i: price(), "640": lambda i: price(), "641": lambda i: price(),
    }
    rows = []
    for kind, f in kinds.items():
        for day in range(3):
            for i in range(int(kind) if kind in ("640", "641") else 100):
                ts = dt.datetime(2024, 1, 1 + day, 9) + dt.timedelta(minutes=1 if kind in ("640", "641") else 4) * (i - i % 2 if kind == "ids" else i)
                size = "1e300" if kind == "large" and i % 10 == 3 else rnd.randint(0, 99)
                rows.append((None if kind == "ids" and i % 2 else len(rows), ts, i % 17, kind, f(i), f'{{"k": {size}}}'))
    rnd.shuffle(rows)
    c = duckdb.connect()
    c.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    c.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?, ?)", rows)
    c.execute(f"COPY events TO '{d}/events.parquet'")
    return d, c


def same(a, b):
    """NaN, infinity and NULL stay apart; of finite numbers the last bits may differ, a digit of the rounding may not."""
    if a is None or b is None or isinstance(a, str):
        return a == b
    return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-12)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, made, name):
    d, c = made
    rel = c.sql(ORACLE[name])
    cols = list(rel.columns)
    want = {r[:2]: dict(zip(cols[2:], r[2:], strict=True)) for r in rel.fetchall()}
    got = {(r.entity, r.day): r.asDict() for r in QUERIES[name](spark, d).collect()}
    assert got.keys() == want.keys() and len(got) == 42
    assert {(k, x): (got[k][x], v) for k, row in want.items() for x, v in row.items() if not same(got[k][x], v)} == {}


def test_divisor_zero_has_a_sign(spark):
    row = spark.sql("SELECT 1D AS a, double('-0.0') AS b, 0D AS z").select(ieee_div("a", "b"), ieee_div("z", "b"), ieee_div("a", "z")).first()
    assert row[0] == -math.inf and math.isnan(row[1]) and row[2] == math.inf


def test_round_is_that_of_the_sql(spark):
    """Where shares of 640 bars are halves at the seventh digit, decimal digits and scaled doubles round apart."""
    x = [k / 640 for k in range(641)] + [-0.0000001, 1e305, math.inf, math.nan, None]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = [r[0] for r in df.select(_round("x")).collect()]
    c = duckdb.connect()
    want = [c.execute("SELECT round(?::DOUBLE, 6)", [v]).fetchone()[0] for v in x]
    assert list(map(repr, got)) == list(map(repr, want))
