"""Edge cases of the operators on small frames, against plain Python."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import crosssec as cs
from panelforge.operators import features, intraday, joins, rules, scoring, setops, simulate, validity
from panelforge.operators import evaluate as ev
from panelforge.operators import windows as win

from .conftest import rows

D0 = dt.date(2024, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def series(spark, *values):
    return spark.createDataFrame([("e", day(i), v) for i, v in enumerate(values)], "entity string, date date, x double")


def column(df, c):
    w = win.over("entity", "date")
    return [r[0] for r in df.select("date", c(w).alias("y")).orderBy("date").select("y").collect()]


def test_rolling_needs_a_full_frame(spark):
    df = series(spark, 1.0, 2.0, None, 4.0, 5.0, 6.0)
    assert column(df, lambda w: win.mean("x", w, 2)) == [None, 1.5, None, None, 4.5, 5.5]
    assert column(df, lambda w: win.total("x", w, 2, 1)) == [1.0, 3.0, 2.0, 4.0, 9.0, 11.0]
    assert column(df, lambda w: win.mean("x", w, 2, end=-1)) == [None, None, 1.5, None, None, 4.5]  # yesterday's frame


def test_past_percentile_counts_positions_not_values(spark):
    df = series(spark, 3.0, None, 1.0, 2.0, None, 2.0)
    assert column(df, lambda w: win.past_percentile("x", w, 2)) == [None, None, 0.0, 1.0, None, 1.0]


def test_beta_needs_both(spark):
    df = spark.createDataFrame([("e", day(i), float(i * i), float(i) if i != 4 else None) for i in range(10)], "entity string, date date, r double, m double")
    got = column(df, lambda w: win.beta("r", "m", w, 3))
    assert got[:2] == [None, None] and got[4:7] == [None] * 3
    r, m = np.array([0.0, 1.0, 4.0]), np.array([0.0, 1.0, 2.0])
    assert math.isclose(got[2], np.cov(r, m)[0, 1] / (np.var(m, ddof=1) + 1e-9))


def test_days_since(spark):
    df = series(spark, 0.0, 1.0, 0.0, 0.0, 1.0)
    out = win.add_days_since(df, "d", F.col("x") > 0, win.over("entity", "date"), cap=60)
    assert [r.d for r in out.orderBy("date").collect()] == [60, 0, 1, 2, 0]


def test_longest_run_first_of_equals(spark):
    df = spark.createDataFrame([("a", i, b) for i, b in enumerate([False, True, True, False, True, True])] + [("b", 0, False)], "k string, pos int, f boolean")
    assert rows(win.longest_runs(df, ["k"], "pos", {"f": F.col("f")}).drop("rows")) == [("a", 2, 1), ("b", 0, None)]


def test_two_rank_denominators(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 9.0), (4, None)], "k int, x double").withColumn("d", F.lit(1))
    out = df.select("k", cs.rank_share_all("x", "d").alias("a"), cs.rank_share("x", "d").alias("b"), cs.rank_first("x", "k", "d").alias("c"), cs.passes_gate("x", 0.5, "d").alias("g"))
    assert rows(out) == [(1, 0.375, 0.5, 2, True), (2, 0.375, 0.5, 3, True), (3, 0.75, 1.0, 1, False), (4, None, None, 4, False)]


def test_star_join_first_source_wins(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b, c = spark.createDataFrame([(1, "b")], "k int, v string"), spark.createDataFrame([(1, "c", 9), (2, "c", 8)], "k int, v string, w int")
    assert rows(joins.star_join(a, [b, c], ["k"])) == [(1, "b", 9), (2, None, 8)]


def test_patch_join_drops_old_values(spark):
    base = spark.createDataFrame([("a", day(0), 1.0), ("a", day(1), 2.0), ("b", day(3), 3.0)], "e string, d date, v double")
    new = spark.createDataFrame([("a", day(1), 9.0), ("b", day(1), 8.0)], "e string, d date, v double")
    assert rows(joins.patch_join(base, new, ["e", "d"])) == [("a", day(0), None), ("a", day(1), 9.0), ("b", day(3), None)]
    assert rows(joins.patch_join(base, new, ["e", "d"], until="d", entity="e")) == [("a", day(0), None), ("a", day(1), 9.0)]


def test_interval_join_last_row_wins(spark):
    df = spark.createDataFrame([("a", day(i)) for i in range(5)] + [("b", day(0))], "e string, d date")
    m = spark.createDataFrame([("a", day(0), day(2), "x", 0), ("a", day(2), day(3), "y", 1)], "e string, s date, t date, label string, seq int")
    assert rows(joins.interval_join(df, m, "e", "d", "s", "t", "seq")) == [("a", day(0), "x"), ("a", day(1), "x"), ("a", day(2), "y"), ("a", day(3), "y"), ("a", day(4), None), ("b", day(0), None)]


def test_shift_align_is_not_asof(spark):
    cal = spark.createDataFrame([(day(i),) for i in (0, 2, 4, 5)], "d date")
    src = spark.createDataFrame([(day(1), 1.0), (day(2), 2.0), (day(3), 3.0), (day(5), 5.0)], "d date, v double")
    assert rows(joins.shift_align(cal, src, "d", ["v"])) == [(day(2), 2.0), (day(4), 2.0), (day(5), 5.0)]  # day 3 is dropped, not carried
    assert rows(joins.shift_align(cal, src, "d", ["v"], 1)) == [(day(2), 1.0), (day(4), 1.0), (day(5), 3.0)]
    assert rows(joins.shift_align(cal, src, "d", ["v"], keep_early=True))[0] == (day(0), None)
    left = spark.createDataFrame([(1, day(4))], "k int, d date")
    right = src.withColumn("k", F.lit(1))
    assert rows(joins.asof_join(left, right, ["k"], "d", ["v"])) == [(1, day(4), 3.0)]


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, n string, v double")
    new = spark.createDataFrame([(2, 2.0 + 1e-12, 1), (2, 5.0, 2), (3, 3.0, 1)], "k int, v double, seq int")
    assert rows(setops.upsert(old, new.drop("seq").where("k = 3"), ["k"])) == [(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0)]
    assert rows(setops.keep_last(new, ["k"], "seq").select("k", "v")) == [(2, 5.0), (3, 3.0)]
    assert rows(setops.partial_upsert(old, new.where("seq = 2 OR k = 3"), ["k"], ["v"])) == [(1, "a", 1.0), (2, "b", 5.0), (3, None, 3.0)]
    assert rows(setops.change_counts(old.drop("n"), new.where("seq = 1").drop("seq"), ["k"])) == [(1, 0, 1)]
    assert rows(setops.change_counts(old.drop("n"), new.where("seq = 2").drop("seq"), ["k"])) == [(0, 1, 0)]


def test_validity_flags(spark):
    cal = spark.createDataFrame([(day(i), i) for i in range(40)], "d date, pos int")
    present = [("a", day(i)) for i in range(40) if i not in (20, 21)] + [("b", day(i)) for i in range(12)]
    out = validity.invalid_flags(spark.createDataFrame(present, "e string, d date"), cal, "e", "d", ipo=3, delist=2, grace=5, before=2, after=2)
    bad = {(r.e, (r.d - D0).days) for r in out.collect() if r.invalid}
    assert bad == {("a", i) for i in (0, 1, 2, 18, 19, 22, 23)} | {("b", i) for i in (0, 1, 2, 10, 11)}


def test_tree_scorers_agree(spark):
    rng = random.Random(3)
    trees = [("a", 0.5, ("b", -1.0, 0.1, 0.2), 0.3), ("b", 0.1, -0.4, ("a", 0.9, 0.5, ("b", 2.0, 0.6, 0.7)))]
    df = spark.createDataFrame([(i, rng.uniform(-1, 2), rng.uniform(-3, 3)) for i in range(200)] + [(200, None, 0.1), (201, 0.1, None), (202, 0.5, 0.1)], "k int, a double, b double")
    df = scoring.predict(df.withColumn("x", scoring.ensemble_column(trees)), scoring.FlatEnsemble(trees, ["a", "b"]), "y")
    assert all(abs(r.x - r.y) < 1e-12 for r in df.collect())


MODEL = """tree
feature_names=f0 f1

Tree=0
num_leaves=3
split_feature=0 1
threshold=0.5 1.5
left_child=1 -1
right_child=-3 -2
leaf_value=0.1 0.2 0.3


Tree=1
num_leaves=1
leaf_value=0.05


end of trees
"""


def test_text_model():
    trees, names = scoring.parse_text_model(MODEL)
    assert names == ["f0", "f1"] and trees == [("f0", 0.5, ("f1", 1.5, 0.1, 0.2, "nan", False), 0.3, "nan", False), 0.05]
    m = scoring.load_bundle(MODEL, '{"features": ["f1", "f0"], "best_iteration": 1}')
    assert m.predict(np.array([[2.0, 0.0]], np.float32))[0] == pytest.approx(1 / (1 + math.exp(-0.2)))
    with pytest.raises(ValueError, match="differ"):
        scoring.load_bundle(MODEL, '{"features": ["f0"]}')
    for word in ("num_cat=1", "decision_type=9 2"):
        with pytest.raises(ValueError, match="categor"):
            scoring.parse_text_model("feature_names=a b\nTree=0\n" + word + "\nsplit_feature=0 1\nthreshold=1 2\nleft_child=-1 -2\nright_child=1 -3\nleaf_value=1 2 3\n\n\n")


@pytest.mark.parametrize(("kind", "left", "want"), [("nan", True, [-1.0, -1.0, -1.0, 1.0]), ("nan", False, [1.0, -1.0, -1.0, 1.0]), ("zero", True, [-1.0, -1.0, -1.0, 1.0]), ("zero", False, [1.0, 1.0, -1.0, 1.0]), ("none", True, [-1.0, -1.0, -1.0, 1.0])])
def test_missing_values_of_splits(spark, kind, left, want):
    """Null, 0, a value below and one above the threshold, by both ways of scoring."""
    tree = ("x", 0.5, -1.0, 1.0, kind, left)
    df = spark.createDataFrame([(0, None), (1, 0.0), (2, -3.0), (3, 2.0)], "i int, x double")
    assert [r.v for r in df.select("i", scoring.tree_column(tree).alias("v")).orderBy("i").collect()] == want
    assert [r.v for r in scoring.predict(df, scoring.FlatEnsemble([tree], ["x"], sigmoid=False), "v").orderBy("i").collect()] == want


def test_feature_matrix(spark):
    df = spark.createDataFrame([("1.5", math.inf), ("x", 2.0)], "a string, b double")
    assert rows(scoring.feature_matrix(df, ["a", "b"])) == [(1.5, None), (None, 2.0)]
    with pytest.raises(ValueError, match="missing"):
        scoring.feature_matrix(df, ["c"])
    assert scoring.feature_matrix(df, ["c"], allow_missing=True).dtypes[-1] == ("c", "float")


def test_conditions(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert [r[0] for r in df.select(rules.conditions(df, [["x", ">=", 1], ["x", "<=", 2]])).collect()] == [True, False, False]
    with pytest.raises(ValueError, match="operator"):
        rules.conditions(df, [["x", "<", 1]])
    with pytest.raises(ValueError, match="missing"):
        rules.conditions(df, [["y", "<=", 1]])
    with pytest.raises(Exception, match="unknown value"):
        spark.range(1).select(rules.mapped(F.lit("z"), {"a": 1}, raise_unknown=True)).collect()


# ---- simulators ----------------------------------------------------------------------------------


def reference_exit(px, bench, t, horizon, gain, cut):
    """The specified rules, one signal at a time: (buy, sell, ret, ret_ew, days, reason, target)."""
    entry = px.get(t + 1)
    if entry is None or bench.get(t + 1) is None or entry[0] is None or entry[0] <= 0:
        return None
    buy, level, days = entry[0], 1.0, []
    for k in range(t + 1, t + horizon + 1):
        if k not in px or bench.get(k) is None or bench[k] <= -1:
            break
        level *= 1 + bench[k]
        days.append((k, *px[k], level - 1))
    if not days:
        return None

    def done(k, sell, b, reason, target):
        return buy, sell, sell / buy - 1, sell / buy - 1 - b, k - t, reason, target

    tol = 1e-12
    k, o, h, c, b = days[0]
    if c / buy - 1 - b <= cut + tol:
        if len(days) > 1:
            k, o, h, c, b = days[1]
            return done(k, o, b, "t1_stop_t2_open", 0)
        return buy, None, c / buy - 1, c / buy - 1 - b, 1, None, None
    if horizon == 1:
        hit = c / buy - 1 - b >= gain - tol
        return done(k, c, b, "expiry_gain" if hit else "expiry_close", int(hit))
    for k, o, h, c, b in days[1:]:
        if o / buy - 1 - b >= gain - tol:
            return done(k, o, b, "profit_open", 1)
        if h / buy - 1 - b >= gain - tol:
            return done(k, buy * (1 + b + gain), b, "profit_intraday", 1)
        if c / buy - 1 - b <= cut + tol:
            return done(k, buy * (1 + b + cut), b, "stop_close", 0)
        if k == t + horizon:
            hit = c / buy - 1 - b >= gain - tol
            return done(k, c, b, "expiry_gain" if hit else "expiry_close", int(hit))
    k, o, h, c, b = days[-1]
    return buy, None, c / buy - 1, c / buy - 1 - b, k - t, None, None


@pytest.mark.parametrize("horizon", [1, 2, 4])
def test_adjusted_simulator(spark, horizon):
    rng = random.Random(horizon)
    n, px = 40, {}
    for e in range(6):
        p = 100.0
        for i in range(n):
            if rng.random() < 0.04:
                continue
            o = p * (1 + rng.gauss(0, 0.03))
            c = o * (1 + rng.gauss(0, 0.03))
            px[e, i] = (o if rng.random() > 0.02 else None, max(o, c) * (1 + abs(rng.gauss(0, 0.01))), c)
            p = c
    bench = {i: rng.gauss(0, 0.01) if rng.random() > 0.03 else None for i in range(n)}
    prices = spark.createDataFrame([(e, day(i), *v) for (e, i), v in px.items()], "entity int, date date, open double, high double, close double")
    benchmark = spark.createDataFrame([(day(i), r) for i, r in bench.items()], "date date, r double")
    signals = spark.createDataFrame([(e, day(i)) for e in range(6) for i in range(n)], "entity int, date date")
    out = simulate.simulate_adjusted(signals, prices, benchmark, horizon, 0.05, -0.04, ["entity", "date"]).collect()
    assert len(out) == 6 * n
    reasons = set()
    for r in out:
        own = {i: v for (e, i), v in px.items() if e == r.entity and None not in v}
        want = reference_exit(own, bench, (r.date - D0).days, horizon, 0.05, -0.04)
        got = (r.buy, r.sell, r.ret, r.ret_ew, r.holding_days, r.exit_reason, r.target)
        assert got == (pytest.approx(want) if want else (None,) * 7)
        reasons.add(r.exit_reason)
    assert len(reasons) >= (3 if horizon == 1 else 5)
    open_rows = spark.createDataFrame(out, simulate.simulate_adjusted(signals, prices, benchmark, horizon, 0.05, -0.04, ["entity", "date"]).schema)
    again = simulate.refill(open_rows, prices, benchmark, horizon, 0.05, -0.04, ["entity", "date"])
    assert sorted((tuple(r) for r in again.collect()), key=repr) == sorted((tuple(r) for r in out), key=repr)


def test_simulators_differ_where_their_rules_do(spark):
    """Strict or inclusive stop, threshold or close as the exit price, open or forced end."""
    px = [(1, day(0), 10.0, 10.0, 10.0), (1, day(1), 100.0, 101.0, 100.0), (1, day(2), 100.0, 101.0, 95.0)]
    prices = spark.createDataFrame(px, "entity int, date date, open double, high double, close double")
    s = spark.createDataFrame([(1, day(0)), (1, day(1)), (1, day(2))], "entity int, date date")
    a = {r.date: r for r in simulate.simulate_raw_strict(s, prices, 3, 0.08, 0.05).collect()}
    b = {r.date: r for r in simulate.simulate_raw_forced(s, prices, 3, 0.08, -0.05).collect()}
    assert a[day(0)].sell is None and b[day(0)].exit_reason == "stop_close" and b[day(0)].holding_days == 1
    assert b[day(1)].exit_reason == "forced_close" and b[day(1)].holding_days == 0 and b[day(2)].buy is None


def test_summary(spark):
    t = spark.createDataFrame([(day(0), 0.1, 1, "profit_open"), (day(0), -0.2, 0, "stop_close"), (day(1), 0.05, 0, "expiry_close"), (day(2), None, None, None)], "d date, r double, target int, why string").withColumn("g", F.lit("x"))
    r = ev.summary(t, ["g"], "d", "r", "target", "why").first()
    assert (r.trades, r.dates, r.precision, r.win_rate, r.profit_rate) == (4, 3, pytest.approx(1 / 3), 0.5, 0.25)
    assert r.profit_factor == pytest.approx(0.75) and r.max_drawdown == pytest.approx(0.0) and r.median_ret == pytest.approx(0.05)
    only_up = t.where("r > 0").groupBy("g").agg(ev.profit_factor("r").alias("a"), ev.profit_factor("r", True).alias("b")).first()
    assert only_up.a == math.inf == only_up.b
    assert t.where("r IS NULL").groupBy("g").agg(ev.profit_factor("r", True).alias("b")).first().b is None
    assert {x[0] for x in rows(ev.with_overall(t, "g").select("g"))} == {"ALL", "x"}
    assert ev.parse_suffix("h3m70d40") == {"horizon": 3, "take_profit_pct": 7.0, "stop_loss_pct": -4.0}
    with pytest.raises(ValueError, match="target name"):
        ev.parse_suffix("h5")


def test_targets_join_key(spark):
    s = spark.createDataFrame([(1, "20240101", "a")], "sample_id int, trade_date string, ts_code string")
    t = spark.createDataFrame([(1, "x", "y", 7)], "sample_id int, trade_date string, ts_code string, v int")
    assert ev.join_targets(s, t).first().v == 7
    assert ev.join_targets(s.drop("sample_id"), t).first().v is None


@pytest.mark.parametrize(("text", "minutes"), [("09:30:00", 0.0), ("93512", 5.0), ("0935", 5.0), ("130000", 210.0), ("945", 15.0), ("93000.0", 0.0), (None, None), ("x", None)])
def test_minutes_ignore_lunch(spark, text, minutes):
    assert spark.range(1).select(features.minutes_since_open(F.lit(text).cast("string"))).first()[0] == minutes


def test_limit_features_without_source_are_null(spark):
    df = spark.createDataFrame([("300001", day(0), "U", 0.0, "9:31:00", 1.0, None, 100.0, 2.0, 0.1)], "entity string, date date, limit string, open_times double, first_time string, fd_amount double, float_mv double, total_mv double, turnover_rate_f double, limit_rate double")
    w = win.over("entity", "date")
    r = features.limit_events(df, w, F.lit(True)).first()
    assert (r.is_20cm, r.limit_up_day_cnt_1, r.sealed_board_day_cnt_1, r.board_success_ratio_1, r.first_time_min, r.days_since_last_limit_down_60) == (1, 1, 1, 1.0, 1.0, 60)
    r = features.limit_events(df, w, F.lit(False)).first()
    assert r.is_20cm is None and r.limit_up_day_cnt_1 is None


def test_auction_bar_counts_only_for_the_morning_share(spark):
    bars = [("e", "d", "09:30", 1.0, 1.0, 1.0, 1.0, 50.0, 50.0)] + [("e", "d", f"10:{i:02d}", 1.0, 1.0 + i / 100, 2.0, 0.5, 1.0, 1.0) for i in range(3)] + [("e", "d", "14:00", 1.0, math.nan, 1.0, 1.0, 1.0, 1.0), ("e", "d", "14:01", 1.0, 1.0, 1.0, 1.0, 47.0, 47.0)]
    df = spark.createDataFrame(bars, "entity string, day string, hm string, open double, close double, high double, low double, vol double, amount double")
    p = intraday.prepare(df, ["entity", "day"], ["hm"], 4)
    r = intraday.day_features(p, ["entity", "day"], "totals", "blocks").first()
    assert r.minute_bar_count == 4 and r.morning_total_amount_ratio == pytest.approx(0.53) and r.morning_amount_ratio == pytest.approx(3 / 50)
    assert intraday.prepare(df, ["entity", "day"], ["hm"], 5).count() == 0
