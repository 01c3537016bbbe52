"""Queries for the daily feature blocks, over a panel made up from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import features as fe
from panelforge.operators import indices
from panelforge.operators import windows as win

from .fixtures import DP, IND, daily_panel, industry
from .q_windows import _EWI, _RET
from .registry import query

LONG = 20
_EPS = "1e-9"


def stock_panel(spark, d):
    p = daily_panel(spark, d)
    e = F.col("entity")
    half = (F.col("open") + F.col("close")) / 2
    return p.withColumns({
        "adj_factor": 1 + (e % 3) * 0.1, "pct_chg": F.col("ret") * 100, "turnover_rate_f": F.col("vol") / 50,
        "buy_elg_amount_rate": F.col("cap") / F.col("amount") * 10, "buy_lg_amount_rate": F.when(F.col("vol") > 30, F.col("vol") / 20), "buy_md_amount_rate": F.col("vol") / 40, "buy_sm_amount_rate": -F.col("vol") / 30,
        **{f"{x}_auction_o": y for x, y in (("open", F.col("open")), ("close", half), ("high", F.greatest("open", half)), ("low", F.least("open", half)), ("vwap", half), ("amount", F.col("amount") / 10), ("vol", F.col("vol") / 10))},
        **{f"{x}_auction_c": y for x, y in (("open", half), ("close", F.col("close")), ("high", F.greatest("close", half)), ("low", F.least("close", half)), ("vwap", half), ("amount", F.col("amount") / 20), ("vol", F.col("vol") / 20))},
        "total_mv": F.col("cap"), "circ_mv": F.col("cap") * 0.6, "winner_rate": F.col("vol") % 100, "cost_5pct": F.col("low") * 0.9, "cost_15pct": F.col("low"), "cost_50pct": half, "cost_85pct": F.col("high"), "cost_95pct": F.col("high") * 1.1, "weight_avg": half,
        **{k: F.col("amount") * (i + 1) / 100 for i, k in enumerate(fe.MARGIN)}, "float_share": F.col("cap") / 10,
        "limit": F.when(F.col("ret") > 0.3, "U").when(F.col("ret") < -0.2, "D").when(F.col("vol") > 300, "Z"), "open_times": F.floor(F.col("vol")) % 2, "first_time": F.when(F.col("ret") > 0.3, F.when(e % 2 == 0, "93512").otherwise("10:15:00")),
        "fd_amount": F.col("amount") / 7, "float_mv": F.when(e % 4 != 0, F.col("cap")), "limit_rate": F.lit(0.1), "realized_vol_5m": F.abs("ret"), "volume_ratio": F.col("vol") / 10,
    })


SP = f"""sp AS (SELECT *, 1 + (entity % 3) * 0.1::DOUBLE AS adj, ret AS ret_1, vol / 50 AS tr, cap / amount * 10 AS elg, CASE WHEN vol > 30 THEN vol / 20 END AS lg, (open + close) / 2 AS half,
  CASE WHEN ret > 0.3 THEN 'U' WHEN ret < -0.2 THEN 'D' WHEN vol > 300 THEN 'Z' END AS lim, floor(vol) % 2 AS ot, amount / (CASE WHEN vol <> 0 THEN vol END + {_EPS}) * (1 + (entity % 3) * 0.1::DOUBLE) AS vw FROM dp)"""


def _fr(n, end="CURRENT ROW", lo=None):
    return f"(PARTITION BY entity ORDER BY date ROWS BETWEEN {n - 1 if lo is None else lo} PRECEDING AND {end})"


def _agg(f, x, n, **k):
    return f"CASE WHEN count({x}) OVER {_fr(n, **k)} >= {n} THEN {f}({x}) OVER {_fr(n, **k)} END"


def _z(x, n):
    return f"(({x}) - {_agg('avg', x, n)}) / ({_agg('stddev_pop', x, n)} + {_EPS})"


def _lag(x, k=1):
    return f"lag({x}, {k}) OVER (PARTITION BY entity ORDER BY date)"


def _sd(a, b):
    return f"({a}) / (CASE WHEN ({b}) <> 0 THEN ({b}) END + {_EPS})"


def _out(df, names, digits=6):
    return df.select("entity", "date", *[F.round(n, digits).alias(n) for n in names])


_PRICE = {
    "ret_5": f"ln(close * adj) - {_lag('ln(close * adj)', 5)}", "vwap_log_ret_3": f"ln(vw) - {_lag('ln(vw)', 3)}", "oc_ret": _sd("close * adj - open * adj", "open * adj"), "close_to_high": _sd("high * adj - close * adj", "close * adj"),
    "close_to_low": _sd("close * adj - low * adj", "close * adj"), "vwap_close_ratio": _sd("close * adj - vw", "vw"), "vwap_low_ratio": f"least({_sd('low * adj - vw', 'vw')}, 0)", "true_range_pct": "abs(high * adj - low * adj) / (close * adj)", "vwap_z": _z("vw", LONG),
}


@query("SELECT entity, date, " + ", ".join(f"round({e}, 6) AS {k}" for k, e in _PRICE.items()) + " FROM sp", DP, SP)
def fea_price(spark, d):
    return _out(fe.add_blocks(stock_panel(spark, d), "entity", "date", "adjusted", "price", long=LONG), list(_PRICE))


_TREND = "tr0 AS (SELECT *, abs(high * adj - low * adj) / (close * adj) AS trp, ln(vol) AS lv FROM sp), tr1 AS (SELECT *, " + ", ".join([f"{_agg('avg', 'trp', k)} AS trm{k}" for k in (5, 20)] + [f"{_agg('stddev_pop', 'ret_1', k)} AS rs{k}" for k in (5, 20)] + [f"{_agg('stddev_pop', 'lv', 5)} AS vr5"]) + " FROM tr0)"
_RS = {"true_range_mean_5": "trm5", "true_range_mean_5_z": _z("trm5", LONG), "ret_std_5_z": _z("rs5", LONG), "ret_std_20_z": _z("rs20", LONG), "vol_rv_5_z": _z("vr5", LONG), "vol_z": _z("vol", LONG), "vwap_imbalance": _sd("(close * adj - vw) / (close * adj)", "trm20")}


@query("SELECT entity, date, " + ", ".join(f"round({e}, 5) AS {k}" for k, e in _RS.items()) + " FROM tr1", DP, SP, _TREND)
def fea_range_scores(spark, d):
    return _out(fe.add_blocks(stock_panel(spark, d), "entity", "date", "adjusted", "price", "trend", "range_scores", long=LONG), list(_RS), 5)


_TU = "tu AS (SELECT *, ln(1 + greatest(tr, 0)) AS tl FROM tr1), tv AS (SELECT *, " + f"{_agg('avg', 'tl', 5, end='1 PRECEDING', lo=5)} - {_agg('avg', 'tl', 20, end='1 PRECEDING', lo=20)} AS trend, {_z('rs5', LONG)} - {_z('rs20', LONG)} AS comp, tl - {_agg('avg', 'tl', 10, end='1 PRECEDING', lo=10)} AS surprise, (tl - {_agg('avg', 'tl', 20, end='1 PRECEDING', lo=20)}) / ({_agg('stddev_pop', 'tl', 20, end='1 PRECEDING', lo=20)} + {_EPS}) AS tz FROM tu)"
_TS = {"turnover_f_log": "tl", "turnover_z_20": "tz", "turnover_surprise_10": "surprise", "turnover_trend_5_20": "trend", "turnover_accel_5_20": f"trend - {_lag('trend')}", "vol_comp_z": "comp", "turnover_in_compression": "-surprise * comp", "pressure_build": "-trend * comp", "exhaustion_risk": "tz * CASE WHEN comp IS NOT NULL THEN greatest(comp, 0) END"}


@query("SELECT entity, date, " + ", ".join(f"round({e}, 5) AS {k}" for k, e in _TS.items()) + " FROM tv", DP, SP, _TREND, _TU)
def fea_turnover(spark, d):
    return _out(fe.add_blocks(stock_panel(spark, d), "entity", "date", "adjusted", "price", "trend", "range_scores", "turnover", "turnover_states", long=LONG), list(_TS), 5)


_FL = "fl AS (SELECT *, elg * 0.01 AS me, lg * 0.01 AS ml, elg * 0.01 + lg * 0.01 AS mi, (elg * 0.01 + lg * 0.01) * ret_1 AS ma FROM sp)"
_FLS = {"mf_inst_rate": "mi", "mf_inst_rate_z": _z("mi", 20), "mf_elg_rate_z": _z("me", 20), "mf_price_align_z_20": _z("ma", 20), "mf_available": "(mi IS NOT NULL)::INT"}


@query("SELECT entity, date, " + ", ".join(f"round({e}, 5) AS {k}" for k, e in _FLS.items()) + " FROM fl", DP, SP, _FL)
def fea_flow(spark, d):
    return _out(fe.add_blocks(stock_panel(spark, d), "entity", "date", "adjusted", "flow", long=LONG), list(_FLS), 5)


_AUC = {
    "auc_o_ret": _sd("half * adj - open * adj", "open * adj"), "auc_o_range": _sd("greatest(open, half) * adj - least(open, half) * adj", "open * adj"), "auc_o_vwap_ratio": _sd("half * adj - vw", "vw"), "auc_o_amt_ratio": _sd("amount / 10", "amount"),
    "auc_c_ret": _sd("close * adj - half * adj", "half * adj"), "auc_c_vol_ratio": _sd("vol / 20", "vol"), "auc_c_vs_close": _sd("close * adj - close * adj", "close * adj"), "auction_to_continuous_return": f"{_sd('close * adj - half * adj', 'half * adj')} - {_sd('half * adj - open * adj', 'open * adj')}",
}


@query("SELECT entity, date, " + ", ".join(f"round({e}, 6) AS {k}" for k, e in _AUC.items()) + " FROM sp", DP, SP)
def fea_auction(spark, d):
    return _out(fe.add_blocks(stock_panel(spark, d), "entity", "date", "adjusted", "auction", long=LONG), list(_AUC))


_CH = {"total_mv_z": _z("cap", LONG), "cost_50pct_z": _z("half", LONG), "chip_density": _sd("high * 1.1 - low * 0.9", "half"), "chip_pressure": _sd("half * adj - close * adj", "close * adj"), "crowdedness": f"((vol % 100) / 100 - 0.5) * {_sd('high * 1.1 - low * 0.9', 'half')}"}


@query("SELECT entity, date, " + ", ".join(f"round({e}, 5) AS {k}" for k, e in _CH.items()) + " FROM sp", DP, SP)
def fea_chips(spark, d):
    return _out(fe.add_blocks(stock_panel(spark, d), "entity", "date", "adjusted", "size_and_chips", long=LONG, size=LONG), list(_CH), 5)


_MA = {"rzye_z": _z("(amount * 1 / 100)", LONG), "margin_pressure": _sd("amount * 3 / 100", "cap / 10"), "net_margin_flow": _sd("amount * 3 / 100 - amount * 5 / 100", "cap / 10")}


@query("SELECT entity, date, " + ", ".join(f"round({e}, 5) AS {k}" for k, e in _MA.items()) + " FROM sp", DP, SP)
def fea_margin(spark, d):
    return _out(fe.add_blocks(stock_panel(spark, d), "entity", "date", "margin", long=LONG), list(_MA), 5)


def _cnt(cond, n):
    return f"sum(coalesce({cond}, false)::INT) OVER {_fr(n)}"


def _since(cond):
    return f"least(coalesce(rn - max(CASE WHEN {cond} THEN rn END) OVER (PARTITION BY entity ORDER BY date), 60), 60)"


_LI = {
    "limit_up_day_cnt_3": _cnt("lim = 'U'", 3), "broken_board_day_cnt_10": _cnt("lim = 'Z'", 10), "sealed_board_day_cnt_5": _cnt("lim = 'U' AND ot = 0", 5),
    "board_success_ratio_5": f"CASE WHEN {_cnt('lim = ' + chr(39) + 'U' + chr(39), 5)} > 0 THEN {_cnt('lim = ' + chr(39) + 'U' + chr(39) + ' AND ot = 0', 5)} / {_cnt('lim = ' + chr(39) + 'U' + chr(39), 5)} ELSE 0 END",
    "days_since_last_limit_event_60": _since("lim IS NOT NULL"), "days_since_last_limit_down_60": _since("lim = 'D'"), "first_time_min": "CASE WHEN ret > 0.3 THEN CASE WHEN entity % 2 = 0 THEN 5 ELSE 45 END END",
    "fd_ratio_log": f"ln(1 + {_sd('amount / 7', 'CASE WHEN entity % 4 <> 0 THEN cap ELSE cap END')} * 1000)", "failure_pressure": "tr * ln(1 + ot)", "is_20cm": "(entity::VARCHAR SIMILAR TO '(300|301|688|689).*')::INT",
}


@query("SELECT entity, date, " + ", ".join(f"round(CASE WHEN entity % 5 <> 0 THEN {e} END, 6) AS {k}" for k, e in _LI.items()) + " FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY date) AS rn FROM sp)", DP, SP)
def fea_limit_events(spark, d):
    out = fe.limit_events(stock_panel(spark, d), win.over("entity", "date"), F.col("entity") % 5 != 0)
    return _out(out, list(_LI))


_IX = """lv AS (SELECT *, exp(sum(ln(1 + ew_close_ret)) OVER (ORDER BY date)) AS ew_close FROM ewi), ix AS (SELECT *, coalesce(lag(ew_close) OVER (ORDER BY date), 1.0) * (1 + ew_open_ret) AS ew_open, valid_count / (SELECT count(DISTINCT entity) FROM dp) AS coverage_ratio,
  CASE WHEN count(ew_close_ret) OVER w20 >= 20 THEN stddev_pop(ew_close_ret) OVER w20 END AS ew_ret_std_20, """ + ", ".join(f"ln(ew_close) - lag(ln(ew_close), {k}) OVER (ORDER BY date) AS ew_mom_{k}" for k in fe.MOMENTA) + " FROM lv WINDOW w20 AS (ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"


def index_panel(spark, d):
    panel = daily_panel(spark, d)
    index = indices.equal_weight(indices.returns(panel, ["entity", "date"]), "date")
    index = index.join(F.broadcast(panel.agg(F.count_distinct("entity").alias("_u")))).withColumn("coverage_ratio", F.col("valid_count") / F.col("_u")).drop("_u")
    return fe.index_features(indices.levels(index, "date", "ew"), "date", ("ew",))


_IXC = ["ew_ret", "ew_oc_ret", "ew_ret_std_20", *[f"ew_mom_{k}" for k in fe.MOMENTA]]


@query(f"SELECT date, round(ew_close_ret, 6) AS ew_ret, round({_sd('ew_close', 'ew_open')} - 1, 6) AS ew_oc_ret, round(ew_ret_std_20, 6) AS ew_ret_std_20, " + ", ".join(f"round(ew_mom_{k}, 6) AS ew_mom_{k}" for k in fe.MOMENTA) + " FROM ix", DP, _RET, _EWI, _IX)
def fea_index(spark, d):
    return index_panel(spark, d).select("date", *[F.round(n, 6).alias(n) for n in _IXC])


@query(
    f"""SELECT date, round(up_ratio - down_ratio, 6) AS mkt_up_down_ratio_spread, round(gt_2pct_ratio - lt_minus_2pct_ratio, 6) AS mkt_gt2_ltminus2_spread, round({_sd("(limit_up_count - limit_down_count)::DOUBLE", "coverage_ratio")}, 6) AS mkt_limit_up_down_spread,
  round((up_ratio - down_ratio) * ew_close_ret, 6) AS mkt_breadth_return_alignment FROM ix""",
    DP, _RET, _EWI, _IX,
)
def fea_breadth(spark, d):
    b = fe.breadth()
    return index_panel(spark, d).select("date", *[F.round(x, 6).alias(k) for k, x in b.items()])


@query(
    f"""SELECT entity, date, round(sp.ret_1 - ew_close_ret, 6) AS ret_1_rel_ew, round(ln(close * adj) - {_lag('ln(close * adj)', 5)} - ew_mom_5, 6) AS ret_5_rel_ew, round({_sd('close * adj - open * adj', 'open * adj')} - ({_sd('ew_close', 'ew_open')} - 1), 6) AS oc_ret_rel_ew,
  round(sp.ret_1 * (1 - least(greatest(gt_5pct_ratio, 0), 1)), 6) AS ret_1_in_weak_mkt, round(sp.ret_1 * least(greatest(vol / 10, 0), 20), 6) AS vol_expand_ret, round(ln(1 + abs(sp.ret_1)) - ln(1 + ew_ret_std_20), 6) AS vol_over_ew_vol FROM sp LEFT JOIN ix USING (date)""",
    DP, SP, _RET, _EWI, _IX,
)
def fea_relative(spark, d):
    p = fe.add_blocks(stock_panel(spark, d), "entity", "date", "adjusted", "price", "trend", "range_scores", long=LONG)
    own = set(p.columns)
    index = index_panel(spark, d)
    p = p.join(F.broadcast(index.select("date", *[x for x in index.columns if x not in own])), "date", "left")  # one row a date
    p = p.withColumns(fe.relative_returns("ew") | fe.conditional(win.over("entity", "date"), LONG))
    return _out(p, ["ret_1_rel_ew", "ret_5_rel_ew", "oc_ret_rel_ew", "ret_1_in_weak_mkt", "vol_expand_ret", "vol_over_ew_vol"])


_MK = "mk AS (SELECT date, sum(amount) / 1e6 AS nr, sum(vol) / 100 AS north, sum(cap) / 1e6 AS south FROM dp GROUP BY date)"


def _dz(x, n):
    w = f"OVER (ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {w} >= {n} THEN ({x} - avg({x}) {w}) / (stddev_pop({x}) {w} + {_EPS}) END"


def _dm(x, n):
    w = f"OVER (ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {w} >= {n} THEN avg({x}) {w} END"


@query(
    f"""SELECT date, round({_dz('nr * 0.01', 20)}, 5) AS mkt_mf_inst_z_20, round({_dm('nr * 0.01', 5)}, 6) AS mkt_mf_inst_ma_5, round({_dm('north', 3)}, 6) AS hsgt_north_money_ma_3, round(n3 - lag(n3, 3) OVER (ORDER BY date), 6) AS hsgt_north_money_accel_3,
  round({_dz('south', 20)}, 5) AS hsgt_south_money_z_20, round(north / 100, 6) AS spx_ret FROM (SELECT *, {_dm('north', 3)} AS n3 FROM mk)""",
    DP, _MK,
)
def fea_market(spark, d):
    m = daily_panel(spark, d).groupBy("date").agg((F.sum("amount") / 1e6).alias("net_amount_rate"), (F.sum("vol") / 100).alias("north_money"), (F.sum("cap") / 1e6).alias("south_money"))
    m = m.withColumns({"pct_change_sh": F.lit(1.0), "pct_change_sz": F.lit(2.0), "buy_sm_amount_rate": F.lit(1.0), "buy_elg_amount_rate": F.lit(1.0), "buy_lg_amount_rate": F.lit(1.0), "hgt": F.lit(2.0), "sgt": F.lit(1.0), "spx_pct_chg": F.col("north_money")})
    out = fe.market_features(m, "date")
    return out.select("date", F.round("mkt_mf_inst_z_20", 5).alias("mkt_mf_inst_z_20"), F.round("mkt_mf_inst_ma_5", 6).alias("mkt_mf_inst_ma_5"), F.round("hsgt_north_money_ma_3", 6).alias("hsgt_north_money_ma_3"), F.round("hsgt_north_money_accel_3", 6).alias("hsgt_north_money_accel_3"), F.round("hsgt_south_money_z_20", 5).alias("hsgt_south_money_z_20"), F.round("spx_ret", 6).alias("spx_ret"))


_GI = """gi0 AS (SELECT grp, date, avg(open) AS open, max(high) AS high, min(low) AS low, avg(close) AS close, sum(vol) AS vol, sum(amount) AS amount, sum(cap) AS float_mv FROM dp JOIN ind USING (entity) GROUP BY grp, date),
gi1 AS (SELECT *, close / lag(close) OVER (PARTITION BY grp ORDER BY date) - 1 AS ret_1 FROM gi0),
gi2 AS (SELECT gi1.*, ew_close_ret AS ew_ret, ew_mom_5, ln(gi1.close) - lag(ln(gi1.close), 5) OVER (PARTITION BY grp ORDER BY gi1.date) AS mom_5 FROM gi1 LEFT JOIN ix USING (date)),
gi AS (SELECT *, CASE WHEN ret_1 IS NOT NULL THEN (rank() OVER (PARTITION BY date ORDER BY ret_1 NULLS LAST) + (count(*) OVER (PARTITION BY date, ret_1) - 1) / 2.0) / count(ret_1) OVER (PARTITION BY date) END AS rk FROM gi2)"""


@query(
    """SELECT grp, date, round(mom_5, 6) AS mom_5, round(mom_5 - ew_mom_5, 6) AS mom5_rel_ew, round((high - low) / (close + 1e-9), 6) AS range_pct, round(amount / (float_mv + 1e-9), 6) AS turnover_proxy, round(rk, 6) AS ret_1_rank,
  round(rk - CASE WHEN count(rk) OVER w >= 3 THEN avg(rk) OVER w END, 6) AS ret_1_rank_accel5 FROM gi WINDOW w AS (PARTITION BY grp ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    DP, IND, _RET, _EWI, _IX, _GI,
)
def fea_industry(spark, d):
    g = daily_panel(spark, d).join(industry(spark, d), "entity").groupBy("grp", "date").agg(F.avg("open").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.avg("close").alias("close"), F.sum("vol").alias("vol"), F.sum("amount").alias("amount"), F.sum("cap").alias("float_mv"))
    g = g.withColumn("ret_1", F.col("close") / F.lag("close").over(win.over("grp", "date")) - 1)
    g = g.join(F.broadcast(index_panel(spark, d).select("date", "ew_ret", *[f"ew_mom_{k}" for k in fe.MOMENTA])), "date", "left")  # one row a date
    out = fe.industry_features(g, "grp", "date")
    return out.select("grp", "date", *[F.round(k, 6).alias(k) for k in ("mom_5", "mom5_rel_ew", "range_pct", "turnover_proxy", "ret_1_rank", "ret_1_rank_accel5")])
