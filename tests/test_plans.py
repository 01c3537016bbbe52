"""Shapes of physical plans that scale depends on."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelforge.operators import crosssec as cs
from panelforge.operators import features, intraday, setops
from panelforge.operators import windows as win
from panelforge.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|Single|RoundRobin)", plan(df)))


@pytest.fixture
def panel(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") % 20).alias("entity"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 20).cast("int")).alias("date"), *[F.rand(i).alias(c) for i, c in enumerate(("open", "high", "low", "close", "amount", "vol", "pct_chg", "adj_factor", "turnover_rate_f"))])
    df.write.parquet(str(tmp_path / "p"))
    return spark.read.parquet(str(tmp_path / "p"))


def test_windows_of_an_entity_share_one_exchange_and_sort(panel):
    w = win.over("entity", "date")
    df = panel.select("entity", "date", win.zscore("close", w, 20), win.baseline_z("vol", w, 10), win.log_momentum("close", w, 5), *win.lag_ladder({"close": (1, 2, 3), "vol": (1, 5)}, w))
    assert exchanges(df) == 1 and len(re.findall(r"\bSort \[", plan(df))) == 1


def test_nested_blocks_need_no_further_exchange(panel):
    df = features.add_blocks(panel, "entity", "date", "adjusted", "price", "trend", "range_scores", "turnover", "turnover_states", long=20)
    assert exchanges(df) == 1


def test_columns_and_dates_reach_the_scan(panel):
    df = panel.where(F.col("date") >= "2024-02-01").select("entity", "close")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2024-02-01)]" in text
    assert re.search(r"ReadSchema: struct<entity:bigint,date:date,close:double>", text)


def test_top_k_limits_before_the_exchange(panel):
    text = plan(cs.top_k(panel, 3, ["date"], F.desc("vol"), "entity"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_keep_last_is_a_group_limit(panel):
    assert "WindowGroupLimit" in plan(setops.keep_last(panel, ["entity"], "date"))


def test_day_features_aggregate_where_their_windows_ran(spark):
    bars = spark.createDataFrame([("e", "d", f"10:{i:02d}", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0) for i in range(5)], "entity string, day string, hm string, open double, close double, high double, low double, vol double, amount double")
    df = intraday.day_features(intraday.prepare(bars, ["entity", "day"], ["hm"], 3), ["entity", "day"])
    assert exchanges(df) == 1


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")
def test_no_query_has_a_cross_join_or_python_rows(spark):
    for name, f in QUERIES.items():
        text = plan(f(spark, SF))
        assert "CartesianProduct" not in text and "BatchEvalPython" not in text, name


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")
def test_whole_order_and_universe_have_no_row_cap(spark):
    order, universe = (QUERIES[x](spark, SF) for x in ("mixed_order_whole", "universe_whole"))
    assert "TakeOrdered" not in plan(order) and "Sort [" in plan(order)
    assert order.count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    assert universe.count() == spark.read.parquet(f"{SF}/part.parquet").select(F.trim("p_brand")).distinct().count()
    rows = [(r.o_orderpriority, r.o_orderkey) for r in order.collect()]
    assert [x for x, _ in rows] == sorted(x for x, _ in rows)


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")
@pytest.mark.parametrize(("name", "scans", "shuffles"), [("intraday_runs", 1, 2), ("layer_filters", 2, 6), ("failure_overlap", 1, 8), ("sim_refill", 7, 17), ("perf_overall_by_layer", 4, 13)])
def test_shared_frames_are_planned_once(spark, name, scans, shuffles):
    df = QUERIES[name](spark, SF)
    assert len(re.findall(r"FileScan parquet", plan(df))) <= scans and exchanges(df) <= shuffles, (plan(df).count("FileScan parquet"), exchanges(df))
