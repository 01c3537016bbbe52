"""Queries for the window, cross-section and index operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions.nulls import log_nonzero
from panelforge.operators import crosssec as cs
from panelforge.operators import indices, validity
from panelforge.operators import windows as win

from .fixtures import BARS, CAL, DP, EW, IND, UD, calendar, daily_panel, ew_index, industry, intraday_bars, user_days
from .registry import load, query

R = 6
def W():
    return win.over("entity", "date")


def r6(c, name):
    return F.round(c, R).alias(name)


_RET = """rets AS (SELECT entity, date, cap, open / pre_close - 1 AS open_ret, high / pre_close - 1 AS high_ret, low / pre_close - 1 AS low_ret, close / pre_close - 1 AS close_ret
  FROM dp WHERE pre_close > 0)"""
_EWI = """ewi AS (SELECT date, avg(open_ret) AS ew_open_ret, avg(high_ret) AS ew_high_ret, avg(low_ret) AS ew_low_ret, avg(close_ret) AS ew_close_ret, median(close_ret) AS ret_median,
  stddev_samp(close_ret) AS ret_std, avg((close_ret > 0)::INT) AS up_ratio, avg((close_ret < 0)::INT) AS down_ratio, avg((close_ret > 0.02)::INT) AS gt_2pct_ratio,
  avg((close_ret > 0.03)::INT) AS gt_3pct_ratio, avg((close_ret > 0.05)::INT) AS gt_5pct_ratio, avg((close_ret < -0.02)::INT) AS lt_minus_2pct_ratio,
  count(*) FILTER (close_ret >= 0.095) AS limit_up_count, count(*) FILTER (close_ret <= -0.095) AS limit_down_count, count(*) AS valid_count FROM rets GROUP BY date)"""
_EW_COLS = "ew_open_ret ew_high_ret ew_low_ret ew_close_ret ret_median ret_std up_ratio down_ratio gt_2pct_ratio gt_3pct_ratio gt_5pct_ratio lt_minus_2pct_ratio".split()


@query("SELECT date, entity, round(open_ret, 6) AS open_ret, round(high_ret, 6) AS high_ret, round(low_ret, 6) AS low_ret, round(close_ret, 6) AS close_ret FROM rets", DP, _RET)
def return_defs(spark, d):
    out = indices.returns(daily_panel(spark, d), ["entity", "date"])
    return out.select("date", "entity", *[r6(f"{x}_ret", f"{x}_ret") for x in ("open", "high", "low", "close")])


@query(f"SELECT date, {', '.join(f'round({c}, 6) AS {c}' for c in _EW_COLS)}, limit_up_count, limit_down_count, valid_count, round(valid_count / (SELECT count(DISTINCT entity) FROM dp), 6) AS coverage_ratio FROM ewi", DP, _RET, _EWI)
def breadth(spark, d):
    panel = daily_panel(spark, d)
    index = indices.equal_weight(indices.returns(panel, ["entity", "date"]), "date")
    size = panel.agg(F.count_distinct("entity").alias("_u"))
    index = index.join(F.broadcast(size))
    return index.select("date", *[r6(c, c) for c in _EW_COLS], "limit_up_count", "limit_down_count", "valid_count", r6(F.col("valid_count") / F.col("_u"), "coverage_ratio"))


@query("SELECT date, round(ew_open_ret, 6) AS ew_open_ret, round(ew_close_ret, 6) AS ew_close_ret, round(ret_median, 6) AS ret_median, round(ret_std, 6) AS ret_std, valid_count FROM ewi", DP, _RET, _EWI)
def ew_index_returns(spark, d):
    out = indices.equal_weight(indices.returns(daily_panel(spark, d), ["entity", "date"]), "date")
    return out.select("date", *[r6(c, c) for c in ("ew_open_ret", "ew_close_ret", "ret_median", "ret_std")], "valid_count")


_LEV = """lev AS (SELECT date, exp(sum(ln(1 + ew_close_ret)) OVER (ORDER BY date)) AS ew_close, ew_open_ret, ew_high_ret, ew_low_ret FROM ewi),
lev2 AS (SELECT *, coalesce(lag(ew_close) OVER (ORDER BY date), 1.0) AS prev FROM lev)"""


@query(
    """SELECT date, round(ew_close, 6) AS ew_close, round(prev * (1 + ew_open_ret), 6) AS ew_open,
  round(greatest(prev * (1 + ew_high_ret), prev * (1 + ew_open_ret), ew_close), 6) AS ew_high, round(least(prev * (1 + ew_low_ret), prev * (1 + ew_open_ret), ew_close), 6) AS ew_low FROM lev2""",
    DP, _RET, _EWI, _LEV,
)
def ew_index_levels(spark, d):
    index = indices.equal_weight(indices.returns(daily_panel(spark, d), ["entity", "date"]), "date")
    out = indices.levels(index, "date", "ew")
    return out.select("date", *[r6(c, c) for c in ("ew_close", "ew_open", "ew_high", "ew_low")])


@query(
    """SELECT date, round(sum(w * open_ret), 6) AS mcap_open_ret, round(sum(w * high_ret), 6) AS mcap_high_ret, round(sum(w * low_ret), 6) AS mcap_low_ret,
  round(sum(w * close_ret), 6) AS mcap_close_ret, round(max(w), 6) AS max_weight, round(sum(w) FILTER (k <= 10), 6) AS top_weight, count(*) AS cap_count
FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY w DESC, entity) AS k FROM (SELECT *, cap / sum(cap) OVER (PARTITION BY date) AS w FROM rets WHERE cap > 0)) GROUP BY date""",
    DP, _RET,
)
def cap_index_top10(spark, d):
    out = indices.cap_weight(indices.returns(daily_panel(spark, d), ["entity", "date", "cap"]), "date", "cap", "entity")
    return out.select("date", *[r6(f"mcap_{x}_ret", f"mcap_{x}_ret") for x in ("open", "high", "low", "close")], r6("max_weight", "max_weight"), r6("top_weight", "top_weight"), "cap_count")


def _z(x, n, w="we", end=""):
    f = f"(PARTITION BY entity ORDER BY date ROWS BETWEEN {n - 1 if not end else n} PRECEDING AND {end or 'CURRENT ROW'})"
    return f"CASE WHEN count({x}) OVER {f} >= {n} THEN ({x} - avg({x}) OVER {f}) / (stddev_pop({x}) OVER {f} + 1e-9) END"


def _roll(agg, x, n, need=None, end="CURRENT ROW", lo=None):
    f = f"(PARTITION BY entity ORDER BY date ROWS BETWEEN {n - 1 if lo is None else lo} PRECEDING AND {end})"
    return f"CASE WHEN count({x}) OVER {f} >= {n if need is None else need} THEN {agg}({x}) OVER {f} END"


@query(f"SELECT entity, date, round({_z('close', 20)}, 6) AS close_z20, round({_z('ret', 5)}, 6) AS ret_z5 FROM dp", DP)
def rolling_zscore(spark, d):
    return daily_panel(spark, d).select("entity", "date", r6(win.zscore("close", W(), 20), "close_z20"), r6(win.zscore("ret", W(), 5), "ret_z5"))


@query(f"SELECT entity, date, round({_roll('avg', 'ret', 5)}, 6) AS mean5, round({_roll('stddev_pop', 'ret', 20)}, 6) AS std20, round({_roll('sum', 'vol', 3, 1)}, 6) AS sum3, round({_roll('avg', 'ret', 5, 3)}, 6) AS mean5min3 FROM dp", DP)
def rolling_stats(spark, d):
    return daily_panel(spark, d).select("entity", "date", r6(win.mean("ret", W(), 5), "mean5"), r6(win.std("ret", W(), 20), "std20"), r6(win.total("vol", W(), 3, 1), "sum3"), r6(win.mean("ret", W(), 5, 3), "mean5min3"))


@query(
    f"""SELECT entity, date, round(tr5, 6) AS tr5, round({_z('tr5', 20)}, 6) AS tr5_z, round({_z('rs5', 20)}, 6) AS ret_std5_z FROM
  (SELECT entity, date, {_roll('avg', 'tr', 5)} AS tr5, {_roll('stddev_pop', 'ret', 5)} AS rs5 FROM (SELECT *, abs(high - low) / close AS tr FROM dp))""",
    DP,
)
def nested_rolling_z(spark, d):
    p = daily_panel(spark, d).withColumn("tr", F.abs(F.col("high") - F.col("low")) / F.col("close"))
    p = p.select("entity", "date", win.mean("tr", W(), 5).alias("tr5"), win.std("ret", W(), 5).alias("rs5"))
    return p.select("entity", "date", r6("tr5", "tr5"), r6(win.zscore("tr5", W(), 20), "tr5_z"), r6(win.zscore("rs5", W(), 20), "ret_std5_z"))


@query(
    f"""SELECT entity, date, round({_z('lv', 20, end='1 PRECEDING')}, 6) AS base_z, round(lv - {_roll('avg', 'lv', 10, end='1 PRECEDING', lo=10)}, 6) AS surprise10,
  round(trend, 6) AS trend_5_20, round(trend - lag(trend) OVER (PARTITION BY entity ORDER BY date), 6) AS accel FROM
  (SELECT *, {_roll('avg', 'lv', 5, end='1 PRECEDING', lo=5)} - {_roll('avg', 'lv', 20, end='1 PRECEDING', lo=20)} AS trend FROM (SELECT *, ln(1 + greatest(vol, 0)) AS lv FROM dp))""",
    DP,
)
def lagged_baseline(spark, d):
    p = daily_panel(spark, d).select("entity", "date", F.log1p(F.greatest("vol", F.lit(0.0))).alias("lv"))
    p = p.withColumn("trend", win.trend_gap("lv", W(), 5, 20))
    return p.select("entity", "date", r6(win.baseline_z("lv", W(), 20), "base_z"), r6(win.surprise("lv", W(), 10), "surprise10"), r6("trend", "trend_5_20"), r6(win.diff("trend", W()), "accel"))


@query("SELECT entity, date, " + ", ".join(f"round(ln(close) - lag(ln(close), {k}) OVER (PARTITION BY entity ORDER BY date), 6) AS mom_{k}" for k in (2, 3, 5, 10, 20)) + " FROM dp", DP)
def log_momentum(spark, d):
    return daily_panel(spark, d).select("entity", "date", *[r6(win.log_momentum("close", W(), k), f"mom_{k}") for k in (2, 3, 5, 10, 20)])


_BETA = """CASE WHEN count(CASE WHEN ret IS NOT NULL AND r IS NOT NULL THEN 1 END) OVER f >= 20 THEN covar_samp(ret, r) OVER f END
  / (CASE WHEN count(r) OVER f >= 20 THEN var_samp(r) OVER f END + 1e-9)"""


@query(f"SELECT entity, date, round({_BETA}, 5) AS beta20 FROM dp LEFT JOIN ew USING (date) WINDOW f AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)", DP, EW)
def rolling_beta(spark, d):
    p = daily_panel(spark, d).join(F.broadcast(ew_index(spark, d)), "date", "left")  # one row a date
    return p.select("entity", "date", F.round(win.beta("ret", "r", W(), 20), 5).alias("beta20"))


@query(
    """SELECT a.entity, a.date, round(CASE WHEN rn > 12 AND a.vol IS NOT NULL AND n > 0 THEN le / n END, 6) AS prank12 FROM
  (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY date) AS rn FROM dp) a JOIN LATERAL
  (SELECT count(b.vol) AS n, count(*) FILTER (b.vol <= a.vol) AS le FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY date) AS rn FROM dp) b WHERE b.entity = a.entity AND b.rn BETWEEN a.rn - 12 AND a.rn - 1) ON true""",
    DP,
)
def past_prank(spark, d):
    return daily_panel(spark, d).select("entity", "date", r6(win.past_percentile("vol", W(), 12), "prank12"))


def _avg_rank(x, by):
    return f"(rank() OVER (PARTITION BY {by} ORDER BY {x} ASC NULLS LAST) + (count(*) OVER (PARTITION BY {by}, {x}) - 1) / 2.0)"


@query(f"SELECT entity, date, round(CASE WHEN ret IS NOT NULL THEN {_avg_rank('ret', 'date')} / count(*) OVER (PARTITION BY date) END, 6) AS rank_all FROM dp", DP)
def cs_rank_all(spark, d):
    return daily_panel(spark, d).select("entity", "date", r6(cs.rank_share_all("ret", "date"), "rank_all"))


@query(f"SELECT entity, date, round(CASE WHEN ret IS NOT NULL THEN {_avg_rank('ret', 'date')} / count(ret) OVER (PARTITION BY date) END, 6) AS rank_nonnull FROM dp", DP)
def cs_rank_nonnull(spark, d):
    return daily_panel(spark, d).select("entity", "date", r6(cs.rank_share("ret", "date"), "rank_nonnull"))


@query(f"SELECT entity, date, coalesce(CASE WHEN ret IS NOT NULL THEN {_avg_rank('ret', 'date')} / count(ret) OVER (PARTITION BY date) END <= 0.75791696, false) AS passes FROM dp", DP)
def gate_percentile(spark, d):
    return daily_panel(spark, d).select("entity", "date", cs.passes_gate("ret", 0.75791696, "date").alias("passes"))


@query("SELECT entity, date, row_number() OVER (PARTITION BY date ORDER BY ret DESC NULLS LAST, entity)::BIGINT AS rank_desc, row_number() OVER (PARTITION BY date ORDER BY ret ASC NULLS LAST, entity)::BIGINT AS rank_asc FROM dp", DP)
def rank_first(spark, d):
    return daily_panel(spark, d).select("entity", "date", cs.rank_first("ret", "entity", "date").cast("long").alias("rank_desc"), cs.rank_first("ret", "entity", "date", descending=False).cast("long").alias("rank_asc"))


@query(f"SELECT entity, date, round(rk, 6) AS rk, round(rk - {_roll('avg', 'rk', 5, 3)}, 6) AS accel5 FROM (SELECT entity, date, CASE WHEN ret IS NOT NULL THEN {_avg_rank('ret', 'date')} / count(ret) OVER (PARTITION BY date) END AS rk FROM dp)", DP)
def rank_accel(spark, d):
    p = daily_panel(spark, d).select("entity", "date", cs.rank_share("ret", "date").alias("rk"))
    return p.select("entity", "date", r6("rk", "rk"), r6(F.col("rk") - win.mean("rk", W(), 5, 3), "accel5"))


@query("SELECT entity, date, round(ret - avg(ret) OVER (PARTITION BY date), 6) AS ex_date, round(ret - avg(ret) OVER (PARTITION BY date, grp), 6) AS ex_group FROM dp LEFT JOIN ind USING (entity)", DP, IND)
def group_excess(spark, d):
    p = daily_panel(spark, d).join(industry(spark, d), "entity", "left")
    return p.select("entity", "date", r6(cs.excess("ret", "date"), "ex_date"), r6(cs.excess("ret", "date", "grp"), "ex_group"))


@query("SELECT entity, date, round(CASE WHEN abs(avg(vol) OVER (PARTITION BY date)) > 1e-9 THEN vol / avg(vol) OVER (PARTITION BY date) END, 6) AS vol_rel, round(CASE WHEN abs(avg(amount) OVER (PARTITION BY date, grp)) > 1e-9 THEN amount / avg(amount) OVER (PARTITION BY date, grp) END, 6) AS amount_rel FROM dp LEFT JOIN ind USING (entity)", DP, IND)
def group_relative(spark, d):
    p = daily_panel(spark, d).join(industry(spark, d), "entity", "left")
    return p.select("entity", "date", r6(cs.relative("vol", "date"), "vol_rel"), r6(cs.relative("amount", "date", "grp"), "amount_rel"))


@query(
    """SELECT entity, date, least(coalesce(rn - max(CASE WHEN n_error > 0 THEN rn END) OVER (PARTITION BY entity ORDER BY date), 60), 60)::BIGINT AS since_error
  FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY date) AS rn FROM ud)""",
    UD,
)
def days_since_event(spark, d):
    out = win.add_days_since(user_days(spark, d), "since_error", F.col("n_error") > 0, W())
    return out.select("entity", "date", F.col("since_error").cast("long").alias("since_error"))


@query("SELECT entity, date, " + ", ".join(f"sum((n_error > 0)::INT) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)::BIGINT AS err_{n}" for n in (1, 2, 3, 5, 10)) + " FROM ud", UD)
def event_day_counts(spark, d):
    return user_days(spark, d).select("entity", "date", *[win.event_days(F.col("n_error") > 0, W(), n).cast("long").alias(f"err_{n}") for n in (1, 2, 3, 5, 10)])


@query("SELECT entity, date, " + ", ".join(f"round(CASE WHEN sum((n_error > 0)::INT) OVER f{n} > 0 THEN sum((n_error > 0 AND n_purchase > 0)::INT) OVER f{n} / sum((n_error > 0)::INT) OVER f{n} ELSE 0 END, 6) AS ratio_{n}" for n in (1, 3, 10)) + " FROM ud WINDOW " + ", ".join(f"f{n} AS (PARTITION BY entity ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (1, 3, 10)), UD)
def success_ratio(spark, d):
    up, sealed = F.col("n_error") > 0, (F.col("n_error") > 0) & (F.col("n_purchase") > 0)
    ratio = lambda n: F.when(win.event_days(up, W(), n) > 0, win.event_days(sealed, W(), n) / win.event_days(up, W(), n)).otherwise(0.0)
    return user_days(spark, d).select("entity", "date", *[r6(ratio(n), f"ratio_{n}") for n in (1, 3, 10)])


@query(
    "WITH " + UD + """, c AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS p FROM (SELECT DISTINCT date FROM ud)),
  x AS (SELECT ud.entity, ud.date, p, (SELECT max(p) FROM c) AS e, row_number() OVER w AS rn, count(*) OVER (PARTITION BY entity) AS n, max(p) OVER (PARTITION BY entity) AS l,
    coalesce((lead(p) OVER w - p > 1)::INT, 0) AS pre FROM ud LEFT JOIN c USING (date) WINDOW w AS (PARTITION BY entity ORDER BY ud.date)),
  y AS (SELECT *, coalesce(lag(pre) OVER (PARTITION BY entity ORDER BY date), 0) AS post FROM x)
SELECT entity, date, (rn <= 2 OR (e - l > 3 AND n - rn < 2) OR max(pre) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) > 0
  OR max(post) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) > 0)::INT AS invalid FROM y""",
)
def validity_flags(spark, d):
    from panelforge.operators.joins import calendar_positions

    u = user_days(spark, d).select("entity", "date")
    return validity.invalid_flags(u, calendar_positions(u, "date"), "entity", "date", ipo=2, delist=2, grace=3, before=2, after=2)


@query("SELECT entity, date, " + ", ".join(f"round(lag({c}, {k}) OVER (PARTITION BY entity ORDER BY date), 6) AS {c}_lag{k}" for c in ("ret", "vol") for k in win.LADDERS["fast"]) + " FROM dp", DP)
def lag_ladder(spark, d):
    p = daily_panel(spark, d).select("entity", "date", "ret", "vol")
    out = p.select("entity", "date", *win.lag_ladder({"ret": win.LADDERS["fast"], "vol": win.LADDERS["fast"]}, W()))
    return out.select("entity", "date", *[r6(c, c) for c in out.columns[2:]])


@query(
    f"SELECT entity, date, round(CASE WHEN ret IS NOT NULL THEN lag(rk, 1) OVER (PARTITION BY entity ORDER BY date) END, 6) AS rk_lag1, round(lag(rk, 5) OVER (PARTITION BY entity ORDER BY date), 6) AS rk_lag5 FROM (SELECT *, CASE WHEN ret IS NOT NULL THEN {_avg_rank('ret', 'date')} / count(*) OVER (PARTITION BY date) END AS rk FROM dp)",
    DP,
)
def cs_rank_lags(spark, d):
    p = daily_panel(spark, d).select("entity", "date", "ret", cs.rank_share_all("ret", "date").alias("rk"))
    return p.select("entity", "date", r6(F.when(F.col("ret").isNotNull(), F.lag("rk", 1).over(W())), "rk_lag1"), r6(F.lag("rk", 5).over(W()), "rk_lag5"))


@query(
    """SELECT entity, date, round(exp(sum(ln(1 + coalesce(ret, 0))) OVER w), 6) AS level, round(max(close) OVER w, 9) AS peak, round(min(close) OVER w, 9) AS trough FROM dp WINDOW w AS (PARTITION BY entity ORDER BY date)""",
    DP,
)
def running_extremes(spark, d):
    p = daily_panel(spark, d).withColumn("g", 1 + F.coalesce("ret", F.lit(0.0)))
    return p.select("entity", "date", r6(win.running_product("g", W()), "level"), F.round(win.running(F.max, "close", W()), 9).alias("peak"), F.round(win.running(F.min, "close", W()), 9).alias("trough"))


@query(
    """SELECT entity, date, round(m5 - b * rm5, 5) AS alpha5 FROM (SELECT entity, date, ln(close) - lag(ln(close), 5) OVER (PARTITION BY entity ORDER BY date) AS m5,
  """ + _BETA + """ AS b, sum(ln(1 + r)) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS rm5
  FROM dp LEFT JOIN ew USING (date) WINDOW f AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))""",
    DP, EW,
)
def industry_alpha(spark, d):
    p = daily_panel(spark, d).join(F.broadcast(ew_index(spark, d)), "date", "left").withColumn("lr", F.log(1 + F.col("r")))  # one row a date
    alpha = win.log_momentum("close", W(), 5) - win.beta("ret", "r", W(), 20) * F.sum("lr").over(W().rowsBetween(-4, 0))
    return p.select("entity", "date", F.round(alpha, 5).alias("alpha5"))


@query(
    """SELECT entity, date, CASE WHEN c6 - c0 = 0 THEN round(l6 / l0 - 1, 6) END AS bench5 FROM (SELECT entity, date, lead(lvl, 5) OVER w AS l6, lvl AS l0, lead(bad, 5) OVER w AS c6, bad AS c0 FROM
  (SELECT entity, date, exp(sum(CASE WHEN r > -1 THEN ln(1 + r) ELSE 0 END) OVER w) AS lvl, sum(CASE WHEN r IS NULL OR r <= -1 THEN 1 ELSE 0 END) OVER w AS bad
   FROM dp LEFT JOIN ew USING (date) WINDOW w AS (PARTITION BY entity ORDER BY date)) WINDOW w AS (PARTITION BY entity ORDER BY date))""",
    DP, EW,
)
def compounded_benchmark(spark, d):
    p = daily_panel(spark, d).select("entity", "date").join(F.broadcast(ew_index(spark, d)), "date", "left")  # one row a date
    p = win.compounded_between(p, W(), "r")
    return p.select("entity", "date", F.when(F.lead("_bad", 5).over(W()) - F.col("_bad") == 0, F.round(F.lead("_level", 5).over(W()) / F.col("_level") - 1, R)).alias("bench5"))


@query(
    """SELECT entity, day, coalesce(n_run, 0)::BIGINT AS run_length, s::BIGINT AS run_start FROM (SELECT DISTINCT entity, day FROM bars) LEFT JOIN
  (SELECT entity, day, max(k) AS n_run, arg_max(s, k * 100000 - s) AS s FROM (SELECT entity, day, i, count(*) AS k, min(pos) AS s FROM
    (SELECT *, pos - row_number() OVER (PARTITION BY entity, day ORDER BY pos) AS i FROM bars WHERE close > open) GROUP BY entity, day, i) GROUP BY entity, day) USING (entity, day)""",
    BARS,
)
def longest_run(spark, d):
    out = win.longest_runs(intraday_bars(spark, d), ["entity", "day"], "pos", {"run": F.col("close") > F.col("open")})
    return out.select("entity", "day", "run_length", F.col("run_start").cast("long").alias("run_start"))


@query("SELECT entity, date, round(vol, 6) AS vol, round(close, 9) AS close FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY vol DESC, close DESC, entity) AS k FROM dp) WHERE k <= 3", DP)
def topk_per_date(spark, d):
    out = cs.top_k(daily_panel(spark, d), 3, ["date"], F.desc("vol"), F.desc("close"), "entity")
    return out.select("entity", "date", r6("vol", "vol"), F.round("close", 9).alias("close"))


@query("SELECT entity, date, round(amount, 4) AS amount FROM dp ORDER BY dp.amount DESC, entity, date LIMIT 30", DP)
def global_topn(spark, d):
    return daily_panel(spark, d).orderBy(F.desc("amount"), "entity", "date").limit(30).select("entity", "date", F.round("amount", 4).alias("amount"))


@query("SELECT date, row_number() OVER (ORDER BY date) - 1 AS pos, lag(date, 3) OVER (ORDER BY date) AS earlier FROM cal", CAL)
def trading_calendar(spark, d):
    from panelforge.operators.joins import calendar_positions, nth_before

    cal = calendar_positions(calendar(spark, d), "date")
    return cal.join(nth_before(cal, "date", 3), "date").select("date", F.col("pos").cast("long").alias("pos"), "earlier")


@query("SELECT entity, date, round(first(amount) OVER (PARTITION BY date ORDER BY entity), 4) AS regime FROM dp", DP)
def day_regime(spark, d):
    return daily_panel(spark, d).select("entity", "date", F.round(cs.first_of_date("amount", "date", "entity"), 4).alias("regime"))


@query("SELECT entity, date, " + ", ".join(f"round(lead({c}, {k}) OVER (PARTITION BY entity ORDER BY date), 9) AS t{k}_{c}" for k in range(6) for c in ("open", "close", "high")) + " FROM dp", DP)
def position_lookup(spark, d):
    return daily_panel(spark, d).select("entity", "date", *[F.round(F.lead(c, k).over(W()), 9).alias(f"t{k}_{c}") for k in range(6) for c in ("open", "close", "high")])
