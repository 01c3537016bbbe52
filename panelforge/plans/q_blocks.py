"""Queries over whole blocks: features against several indices and the industry, the cross-section block, funnels, ladders."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import crosssec as cs
from panelforge.operators import evaluate as ev
from panelforge.operators import features as fe
from panelforge.operators import indices, simulate
from panelforge.operators import windows as win

from .fixtures import DP, EW, IND, SC, daily_panel, industry
from .q_features import _EPS, _FL, LONG, SP, _lag, _sd, _z, stock_panel
from .q_signals import DU, EN, SG, layered, prices, signals
from .registry import query

INDICES = ("ew", "mcap")


def r6(c, name=None):
    return F.round(c, 6).alias(name or c)


# ---- two indices and the industry ----------------------------------------------------------------


def two_indices(spark, d):
    """date, {p}_ret, {p}_oc_ret, {p}_ret_std_20, {p}_mom_k of the mean and of the cap-weighted price."""
    p = daily_panel(spark, d)
    i = p.groupBy("date").agg(F.avg("open").alias("ew_open"), F.avg("close").alias("ew_close"), (F.sum(F.col("open") * F.col("cap")) / F.sum("cap")).alias("mcap_open"), (F.sum(F.col("close") * F.col("cap")) / F.sum("cap")).alias("mcap_close"), (F.avg("vol") / 1000).alias("mkt_mf_inst_rate"))
    w = win.over([F.lit(1)], "date")  # one row a date
    i = i.withColumns({f"{x}_close_ret": F.col(f"{x}_close") / F.lag(f"{x}_close").over(w) - 1 for x in INDICES})
    return fe.index_features(i, "date", INDICES)


def _dlag(x, k=1):
    return f"lag({x}, {k}) OVER (ORDER BY date)"


_TI = (
    "ti0 AS (SELECT date, avg(open) AS ew_open, avg(close) AS ew_close, sum(open * cap) / sum(cap) AS mcap_open, sum(close * cap) / sum(cap) AS mcap_close, avg(vol) / 1000 AS mkt FROM dp GROUP BY date), ti1 AS (SELECT *, "
    + ", ".join(f"{p}_close / {_dlag(f'{p}_close')} - 1 AS {p}_ret" for p in INDICES)
    + " FROM ti0), ti AS (SELECT *, "
    + ", ".join(f"{_sd(f'{p}_close', f'{p}_open')} - 1 AS {p}_oc_ret, CASE WHEN count({p}_ret) OVER i20 >= 20 THEN stddev_pop({p}_ret) OVER i20 END AS {p}_ret_std_20" for p in INDICES)
    + ", "
    + ", ".join(f"ln({p}_close) - {_dlag(f'ln({p}_close)', k)} AS {p}_mom_{k}" for p in INDICES for k in fe.MOMENTA)
    + " FROM ti1 WINDOW i20 AS (ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"
)


def groups(spark, d):
    g = daily_panel(spark, d).join(industry(spark, d), "entity").groupBy("grp", "date").agg(F.avg("open").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.avg("close").alias("close"), F.sum("vol").alias("vol"), F.sum("amount").alias("amount"), F.sum("cap").alias("float_mv"))
    g = g.withColumn("ret_1", F.col("close") / F.lag("close").over(win.over("grp", "date")) - 1)
    i = two_indices(spark, d).select("date", *[f"{p}_ret" for p in INDICES], *[f"{p}_mom_{k}" for p in INDICES for k in fe.MOMENTA])
    return fe.industry_features(g.join(F.broadcast(i), "date", "left"), "grp", "date", INDICES)  # one row a date


def _gl(x, k=1):
    return f"lag({x}, {k}) OVER (PARTITION BY grp ORDER BY date)"


def _beta(r, m, by):
    w = f"(PARTITION BY {by} ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    both = f"CASE WHEN {r} IS NOT NULL AND {m} IS NOT NULL THEN 1 END"
    return f"CASE WHEN count({both}) OVER {w} >= 20 THEN covar_samp({r}, {m}) OVER {w} END / (CASE WHEN count({m}) OVER {w} >= 20 THEN var_samp({m}) OVER {w} END + {_EPS})"


_GR = (
    "gr0 AS (SELECT grp, date, avg(open) AS open, avg(close) AS close FROM dp JOIN ind USING (entity) GROUP BY grp, date), gr1 AS (SELECT *, close / "
    + _gl("close")
    + " - 1 AS ret_1, "
    + ", ".join(f"ln(close) - {_gl('ln(close)', k)} AS mom_{k}" for k in fe.MOMENTA)
    + f", {_sd('close', 'open')} - 1 AS oc_ret FROM gr0), gr2 AS (SELECT gr1.*, "
    + ", ".join(f"{p}_ret, {p}_mom_5, {p}_mom_20" for p in INDICES)
    + " FROM gr1 LEFT JOIN ti USING (date)), gr3 AS (SELECT *, "
    + ", ".join(f"{_beta('ret_1', f'{p}_ret', 'grp')} AS beta_{p}" for p in INDICES)
    + ", CASE WHEN count(ret_1) OVER g20 >= 20 THEN stddev_pop(ret_1) OVER g20 END AS std_20 FROM gr2 WINDOW g20 AS (PARTITION BY grp ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"
)
_GRC = {f"beta_{p}_20": f"beta_{p}" for p in INDICES} | {f"ret_rel_{p}": f"ret_1 - {p}_ret" for p in INDICES} | {f"mom{k}_rel_{p}": f"mom_{k} - {p}_mom_{k}" for p in INDICES for k in (5, 20)} | {f"alpha_{p}_5": f"mom_5 - beta_{p} * {p}_mom_5" for p in INDICES}
_GRC |= {f"mom_{k}": f"mom_{k}" for k in fe.MOMENTA} | {"oc_ret": "oc_ret", "ret_std_20": "std_20"}


@query("SELECT grp, date, " + ", ".join(f"round({e}, 5) AS {k}" for k, e in _GRC.items()) + " FROM gr3", DP, IND, _TI, _GR)
def industry_against_indices(spark, d):
    return groups(spark, d).select("grp", "date", *[F.round(k, 5).alias(k) for k in _GRC])


_OWN = ("1", "2", "3", "5", "10", "20")
_ST = "st AS (SELECT sp.entity, sp.date, sp.ret_1, abs(sp.ret_1) AS rv, " + ", ".join(f"ln(sp.close * adj) - {_lag('ln(sp.close * adj)', k).replace('ORDER BY date', 'ORDER BY sp.date').replace('PARTITION BY entity', 'PARTITION BY sp.entity')} AS ret_{k}" for k in fe.MOMENTA) + f", {_sd('sp.close * adj - sp.open * adj', 'sp.open * adj')} AS oc_ret, elg * 0.01 + lg * 0.01 AS mi, ti.*, gr3.ret_1 AS ind_ret, gr3.oc_ret AS ind_oc_ret, gr3.std_20 AS ind_ret_std_20, " + ", ".join(f"gr3.mom_{k} AS ind_mom_{k}" for k in fe.MOMENTA) + " FROM sp LEFT JOIN ti ON ti.date = sp.date LEFT JOIN ind ON ind.entity = sp.entity LEFT JOIN gr3 ON gr3.grp = ind.grp AND gr3.date = sp.date)"
_STC = {f"ret_{k}_rel_{p}": f"ret_{k} - {p}_{'ret' if k == '1' else 'mom_' + k}" for p in (*INDICES, "ind") for k in _OWN} | {f"oc_ret_rel_{p}": f"oc_ret - {p}_oc_ret" for p in (*INDICES, "ind")}
_STC |= {f"beta_to_{p}_20d": _beta("ret_1", f"{p}_ret", "entity") for p in (*INDICES, "ind")} | {f"vol_over_{p}_vol": f"ln(1 + rv) - ln(1 + {p}_ret_std_20)" for p in (*INDICES, "ind")} | {"mf_inst_rate_rel_mkt_z20": _z("mi - mkt", 20)}


@query("SELECT entity, date, " + ", ".join(f"round({e}, 5) AS {k}" for k, e in _STC.items()) + " FROM (SELECT * EXCLUDE (date_1) FROM st)", DP, IND, SP, _TI, _GR, _ST)
def stock_against_indices(spark, d):
    """Relative returns, betas and volatility spreads against two indices and the industry, whose features are joined by (industry, date)."""
    p = fe.add_blocks(stock_panel(spark, d), "entity", "date", "adjusted", "price", "flow", long=LONG).join(industry(spark, d), "entity", "left")
    i = two_indices(spark, d)
    p = p.join(F.broadcast(i.select("date", *[x for x in i.columns if x not in p.columns])), "date", "left")  # one row a date
    g = groups(spark, d).select("grp", "date", F.col("ret_1").alias("ind_ret"), F.col("oc_ret").alias("ind_oc_ret"), F.col("ret_std_20").alias("ind_ret_std_20"), *[F.col(f"mom_{k}").alias(f"ind_mom_{k}") for k in fe.MOMENTA])
    p = p.join(g, ["grp", "date"], "left")
    w = win.over("entity", "date")
    new = fe.against(w, *INDICES, "ind") | fe.flow_against_market(w)
    for x in (*INDICES, "ind"):
        new |= fe.relative_returns(x)
    return p.select("entity", "date", *[F.round(new[k], 5).alias(k) for k in _STC])


# ---- the cross-section block ---------------------------------------------------------------------

_CB = (
    "cb0 AS (SELECT fl.entity, fl.date, grp, ret_1, "
    + ", ".join(f"ln(close * adj) - {_lag('ln(close * adj)', k).replace('BY entity', 'BY fl.entity').replace('BY date', 'BY fl.date')} AS ret_{k}" for k in (2, 3, 5, 10))
    + f", vol, {_sd('close * adj - open * adj', 'open * adj')} AS oc_ret, amount, ln(1 + greatest(tr, 0)) AS turnover_f_log, mi AS mf_inst_rate, {_sd('close * adj - vw', 'vw')} AS vwap_close_ratio, {_sd('high * adj - close * adj', 'close * adj')} AS close_to_high, vol % 100 AS winner_rate, cap * 0.6 AS circ_mv FROM fl LEFT JOIN ind ON ind.entity = fl.entity)"
)


def _rk(x):
    return f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY date ORDER BY {x} NULLS LAST) + (count(*) OVER (PARTITION BY date, {x}) - 1) / 2.0) / count(*) OVER (PARTITION BY date) END"


_CBC = {n: _rk(x) for x, n in cs.RANKS if x != "mf_price_align_z_20"}
_CBC |= {n: f"CASE WHEN abs(avg({x}) OVER (PARTITION BY date)) > 1e-9 THEN {x} / avg({x}) OVER (PARTITION BY date) END" for x, n in cs.RELATIVE}
_CBC |= {n: f"{x} - avg({x}) OVER (PARTITION BY date{', grp' if g else ''})" for x, n, g in cs.EXCESS}


@query("SELECT entity, date, " + ", ".join(f"round({e}, 5) AS {k}" for k, e in _CBC.items()) + " FROM cb0", DP, IND, SP, _FL, _CB)
def cross_section_block(spark, d):
    """All ranks, relative levels and excesses of the block (one rank is of a z-score, see ``fea_flow``, and has no twin here)."""
    p = fe.add_blocks(stock_panel(spark, d), "entity", "date", "adjusted", "price", "trend", "range_scores", "turnover", "flow", long=LONG)
    out = cs.block(p.join(industry(spark, d), "entity", "left"), "date", "grp")
    return out.select("entity", "date", *[F.round(k, 5).alias(k) for k in _CBC])


_LAGGED = {"ret_1_cs_rank": "fast", "winner_rate_cs_rank": "med", "mf_inst_rate_cs_rank": "shock", "ret_2_prank_1500": "trend"}


@query("SELECT entity, date, " + ", ".join(f"round(lag({c}, {k}) OVER (PARTITION BY entity ORDER BY date), 5) AS {c}_lag{k}" for c, ladder in _LAGGED.items() for k in win.LADDERS[ladder]) + " FROM (SELECT entity, date, " + ", ".join(f"{_CBC[c]} AS {c}" for c in _LAGGED) + " FROM cb0)", DP, IND, SP, _FL, _CB)
def cross_section_lags(spark, d):
    p = fe.add_blocks(stock_panel(spark, d), "entity", "date", "adjusted", "price", "flow", long=LONG)
    out = cs.block(p.join(industry(spark, d), "entity", "left"), "date", "grp").select("entity", "date", *_LAGGED)
    out = out.select("entity", "date", *win.lag_ladder({c: win.LADDERS[x] for c, x in _LAGGED.items()}, win.over("entity", "date")))
    return out.select("entity", "date", *[F.round(c, 5).alias(c) for c in out.columns[2:]])


# ---- totals, benchmark, funnel, ladder, minute features ------------------------------------------


@query("SELECT date, count(*) AS valid_count, round(sum(vol), 4) AS total_vol, round(sum(amount), 4) AS total_amount, round(sum(cap), 1) AS total_cap FROM dp WHERE pre_close > 0 GROUP BY date", DP)
def index_totals(spark, d):
    r = indices.returns(daily_panel(spark, d), ["entity", "date", "vol", "amount", "cap"])
    return indices.equal_weight(r, "date", totals=("vol", "amount", "cap")).select("date", "valid_count", F.round("total_vol", 4).alias("total_vol"), F.round("total_amount", 4).alias("total_amount"), F.round("total_cap", 1).alias("total_cap"))


@query("SELECT 'return' AS source, date, round(r, 6) AS r FROM ew UNION ALL SELECT 'close', date, round(c / lag(c) OVER (ORDER BY date) - 1, 6) FROM (SELECT date, avg(close) AS c FROM dp GROUP BY date)", DP, EW)
def benchmark_detection(spark, d):
    """The return column found by name; derived from close where there is none."""
    b = daily_panel(spark, d).groupBy("date").agg(F.avg("ret").alias("daily_return"), F.avg("close").alias("close"))
    return ev.union_all(*[indices.benchmark_returns(x, "date").select(F.lit(k).alias("source"), "date", r6("r")) for k, x in (("return", b), ("close", b.drop("daily_return")))])


@query("SELECT date, count(*) AS rows, count(*) FILTER (layer <> 'none') AS signals, count(*) FILTER (strict) AS layer1, count(*) FILTER (strong) AS strong, count(*) FILTER (m1 OR m3) AS layer2, round(arg_min(good_day, entity), 6) AS good_day, round(arg_min(index_oc, entity), 6) AS index_oc FROM du GROUP BY date", DP, EW, SC, EN, DU)
def date_funnel(spark, d):
    out = ev.funnel(layered(spark, d), "date", {"signals": F.col("layer") != "none", "layer1": F.col("strict"), "strong": F.col("strong"), "layer2": F.col("m1") | F.col("m3")}, ("good_day", "index_oc"), "entity")
    return out.select("date", "rows", "signals", "layer1", "strong", "layer2", r6("good_day"), r6("index_oc"))


_T = [f"T{k}_{c}" for k in range(6) for c in ("open", "close", "high")]


@query("SELECT entity, date, " + ", ".join(f"round({t}, 9) AS {t}" for t in _T) + " FROM sg LEFT JOIN (SELECT entity, date, " + ", ".join(f"lead({t.split('_')[1]}, {t[1]}) OVER (PARTITION BY entity ORDER BY date) AS {t}" for t in _T) + " FROM dp) USING (entity, date)", DP, SC, EN, SG)
def audit_price_ladder(spark, d):
    return simulate.price_ladder(signals(spark, d), prices(spark, d)).select("entity", "date", *[F.round(t, 9).alias(t) for t in _T])


@query("SELECT c_custkey, c_nationkey, n_name, round(c_acctbal, 2) AS c_acctbal, CAST(NULL AS DOUBLE) AS absent FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey < 3")
def optional_join(spark, d):
    """A left join of further features; an empty source adds its columns as nulls."""
    from panelforge.sources import readers

    from .registry import load

    c, n = load(spark, d, "customer", "nation")
    out = c.select("c_custkey", "c_nationkey", F.round("c_acctbal", 2).alias("c_acctbal")).join(n.where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey", "left")
    more = readers.scan_or_empty(spark, f"{d}/no_such_table.parquet", "c_custkey long, absent double")
    return out.join(more, "c_custkey", "left").select("c_custkey", "c_nationkey", "n_name", "c_acctbal", "absent")
