"""Queries for scoring, rules, simulation, evaluation, orders and the feature registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import crosssec as cs
from panelforge.operators import evaluate as ev
from panelforge.operators import orders as od
from panelforge.operators import rules, simulate
from panelforge.operators import scoring as sco

from .fixtures import DP, EW, SC, TREES, daily_panel, ew_index
from .registry import query

PREDS = [f"pred_{i}" for i in range(5)]


def r6(c, name=None):
    return F.round(c, 6).alias(name or c)


def scores(spark, d):
    p = daily_panel(spark, d).where("ret IS NOT NULL").select("entity", "date", "ret", "vol", "amount", "close")
    return p.withColumns({f"pred_{i}": sco.tree_column(t) for i, t in enumerate(TREES)})


_SUM = "(" + " + ".join(PREDS) + ") / 5"
EN = f"""en0 AS (SELECT *, {_SUM} AS avg_pred, {", ".join(f"row_number() OVER (PARTITION BY date ORDER BY {p} DESC, entity) AS rank_{p}" for p in PREDS)} FROM sc),
en1 AS (SELECT *, sqrt(({" + ".join(f"pow({p} - avg_pred, 2)" for p in PREDS)}) / 5) AS pred_std, ({" + ".join(f"rank_{p}" for p in PREDS)}) / 5 AS avg_rank_raw FROM en0),
en AS (SELECT *, pred_std / greatest(abs(avg_pred), 1e-9) AS pred_cv, row_number() OVER (PARTITION BY date ORDER BY avg_pred DESC, entity) AS avg_pred_rank,
  row_number() OVER (PARTITION BY date ORDER BY avg_rank_raw, entity) AS avg_rank FROM en1)"""


def ensemble(spark, d):
    return sco.ensemble_stats(scores(spark, d), PREDS, "date", "entity")


@query("SELECT entity, date, " + ", ".join(PREDS) + " FROM sc", DP, SC)
def tree_scores(spark, d):
    return scores(spark, d).select("entity", "date", *PREDS)


@query("SELECT entity, date, round(1 / (1 + exp(-(" + " + ".join(PREDS) + "))), 6) AS prob FROM sc", DP, SC)
def tree_scores_batched(spark, d):
    p = sco.feature_matrix(daily_panel(spark, d).where("ret IS NOT NULL").select("entity", "date", "ret", "vol", "amount"), ["ret", "vol", "amount"])
    return sco.predict(p, sco.FlatEnsemble(TREES, ["ret", "vol", "amount"]), "prob").select("entity", "date", r6("prob"))


@query("SELECT entity, date, round(avg_pred, 6) AS avg_pred, round(pred_std, 6) AS pred_std, round(pred_cv, 6) AS pred_cv, least(" + ", ".join(PREDS) + ") AS pred_min, greatest(" + ", ".join(PREDS) + ") AS pred_max, round(avg_rank_raw, 6) AS avg_rank_raw, avg_pred_rank::BIGINT AS avg_pred_rank, avg_rank::BIGINT AS avg_rank FROM en", DP, SC, EN)
def ensemble_scores(spark, d):
    e = ensemble(spark, d)
    return e.select("entity", "date", r6("avg_pred"), r6("pred_std"), r6("pred_cv"), "pred_min", "pred_max", r6("avg_rank_raw"), F.col("avg_pred_rank").cast("long").alias("avg_pred_rank"), F.col("avg_rank").cast("long").alias("avg_rank"))


@query(
    "SELECT entity, date, max(tgt) AS target, round(avg(pred), 6) AS pred FROM (" + " UNION ALL ".join(f"SELECT entity, date, (ret > 0.01)::INT AS tgt, {p} AS pred FROM sc" for p in PREDS) + ") GROUP BY entity, date",
    DP, SC,
)
def seed_mean(spark, d):
    s = scores(spark, d).withColumn("tgt", (F.col("ret") > 0.01).cast("int"))
    long = s.select("entity", "date", "tgt", F.explode(F.array(*PREDS)).alias("pred"))
    return long.groupBy("entity", "date").agg(F.max("tgt").alias("target"), r6(F.avg("pred"), "pred"))


VO = f"""vo0 AS (SELECT *, {" + ".join(f"(rank_{p} <= 3)::INT" for p in PREDS)} AS votes FROM en),
vo AS (SELECT *, votes >= 3 AND row_number() OVER (PARTITION BY date ORDER BY (votes < 3)::INT, avg_rank_raw, avg_pred_rank, entity) <= 3 AS vote_loose,
  votes >= 4 AND row_number() OVER (PARTITION BY date ORDER BY (votes < 4)::INT, votes DESC, avg_rank_raw, entity) <= 3 AS vote_strict, avg_pred_rank <= 1 AS top1 FROM vo0)"""


def voted(spark, d):
    return rules.votes(ensemble(spark, d), [f"rank_{p}" for p in PREDS], "date", "entity")


@query("SELECT entity, date, votes::INT AS votes, top1, vote_loose, vote_strict FROM vo", DP, SC, EN, VO)
def vote_select(spark, d):
    return voted(spark, d).select("entity", "date", "votes", "top1", "vote_loose", "vote_strict")


CONFIG = {
    "m_vote": {"base": "vote_strict", "conditions": [["vol", ">=", 120], ["ret", "<=", 0.2]]},
    "m_top": {"base": "top1", "conditions": [["amount", ">=", 100000]]},
    "m_either": {"operator": "or", "members": ["m_vote", "m_top"]},
}
GROUPS = [[["ret", ">=", 0.05]], [["vol", ">=", 200], ["amount", "<=", 400000]]]
LA = """sm AS (SELECT *, vote_strict AND vol >= 120 AND ret <= 0.2 AS m_vote, top1 AND amount >= 100000 AS m_top FROM vo),
sm2 AS (SELECT *, m_vote OR m_top AS m_either, m_vote::INT + m_top::INT + (m_vote OR m_top)::INT AS k,
  CASE WHEN ret IS NOT NULL THEN (rank() OVER (PARTITION BY date ORDER BY vol) + (count(*) OVER (PARTITION BY date, vol) - 1) / 2.0) / count(*) OVER (PARTITION BY date) END AS low FROM sm),
pl AS (SELECT *, CASE WHEN k = 3 THEN 'P1A' WHEN avg_pred_rank <= 1 AND low <= 0.3 THEN 'P1B' WHEN k >= 1 THEN 'P2' WHEN vote_loose AND (ret >= 0.05 OR (vol >= 200 AND amount <= 400000)) THEN 'P3' ELSE '' END AS priority_name FROM sm2),
pw AS (SELECT *, CASE priority_name WHEN 'P1A' THEN 1 WHEN 'P1B' THEN 1 WHEN 'P2' THEN 2 WHEN 'P3' THEN 3 ELSE 0 END AS priority,
  concat_ws('|', CASE WHEN avg_pred_rank <= 1 THEN 'avg_top1' END, CASE WHEN avg_pred_rank <= 5 THEN 'avg_top5' END, CASE WHEN votes >= 2 THEN 'vote2_top3' END) AS reason FROM pl)"""


def laddered(spark, d):
    v = rules.signal_models(voted(spark, d), CONFIG)
    v = v.withColumn("low", cs.rank_share_all("vol", "date"))
    return rules.priority_ladder(v, ["m_vote", "m_top", "m_either"], "low", 0.3, "vote_loose", GROUPS)


@query("SELECT entity, date, m_vote, m_top, m_either, priority::INT AS priority, priority_name FROM pw", DP, SC, EN, VO, LA)
def priority_ladder(spark, d):
    return laddered(spark, d).select("entity", "date", "m_vote", "m_top", "m_either", "priority", "priority_name")


@query(
    """SELECT entity, date, reason AS watch_reason, priority = 0 AND reason <> '' AS watch, CASE WHEN priority > 0 THEN 'TRADE' WHEN reason <> '' THEN 'WATCHLIST' ELSE '' END AS signal_type,
  CASE WHEN priority > 0 THEN priority_name WHEN reason <> '' THEN 'WATCHLIST_' || reason ELSE '' END AS signal_tag FROM pw""",
    DP, SC, EN, VO, LA,
)
def watchlist_tags(spark, d):
    return rules.watchlist(laddered(spark, d)).select("entity", "date", "watch_reason", "watch", "signal_type", "signal_tag")


@query("SELECT priority_name, count(*) AS n, round(avg(ret), 6) AS avg_ret FROM pw GROUP BY priority_name", DP, SC, EN, VO, LA)
def priority_summary(spark, d):
    return laddered(spark, d).groupBy("priority_name").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("ret"), "avg_ret"))


@query("SELECT date, count(*) FILTER (vote_loose) AS n_loose, count(*) FILTER (vote_strict) AS n_strict, count(*) FILTER (m_either) AS n_either, round(arg_min(low, entity), 6) AS first_low FROM pw GROUP BY date", DP, SC, EN, VO, LA)
def diagnostic_summary(spark, d):
    p = laddered(spark, d)
    return p.groupBy("date").agg(F.count_if("vote_loose").alias("n_loose"), F.count_if("vote_strict").alias("n_strict"), F.count_if("m_either").alias("n_either"), r6(F.min_by("low", "entity"), "first_low"))


THRESHOLDS = {"swing_max": 6.0, "index_oc_max": 0.02, "rank_top": 7, "strict_cv": 0.12, "tight_cv": 0.08, "good_day": 0.45, "seed_cv": 0.1, "m1_rank": 2, "m1_good_day": 0.4, "m1_cv": 0.15, "m_swing": 9.0, "m3_rank": 5}
LAYERS = {"overlap_core": 1, "strong_only": 2, "strict_only": 3, "layer2_m1_m3_overlap": 4, "layer2_m1_only": 5, "layer2_m3_only": 5}
DU = """du0 AS (SELECT en.*, abs(ret) * 100 AS swing, ew.r AS index_oc, first(pred_0) OVER (PARTITION BY en.date ORDER BY entity) AS good_day,
  sqrt((pow(pred_0 - (pred_0 + pred_1) / 2, 2) + pow(pred_1 - (pred_0 + pred_1) / 2, 2)) / 2) / greatest(abs((pred_0 + pred_1) / 2), 1e-9) AS seed_cv FROM en LEFT JOIN ew USING (date)),
du1 AS (SELECT *, coalesce(swing <= 6 AND index_oc <= 0.02, false) AS hc FROM du0),
du2 AS (SELECT *, avg_rank <= 7 AND hc AND pred_cv <= 0.12 AS strict, avg_rank <= 7 AND hc AND pred_cv <= 0.08 AS strict_tight, avg_rank <= 7 AND hc AND good_day >= 0.45 AND seed_cv <= 0.1 AS strong,
  avg_rank <= 2 AND good_day >= 0.4 AND pred_cv <= 0.15 AND swing <= 9 AS m1, avg_rank <= 5 AND good_day >= 0.45 AND seed_cv <= 0.1 AND swing <= 9 AS m3 FROM du1),
du AS (SELECT *, CASE WHEN strict AND NOT strong THEN 'strict_only' WHEN strong AND NOT strict THEN 'strong_only' WHEN strict AND strong THEN 'overlap_core' WHEN m3 AND NOT m1 THEN 'layer2_m3_only'
  WHEN m1 AND NOT m3 THEN 'layer2_m1_only' WHEN m1 AND m3 THEN 'layer2_m1_m3_overlap' ELSE 'none' END AS layer FROM du2)"""


def layered(spark, d):
    e = ensemble(spark, d).join(F.broadcast(ew_index(spark, d)), "date", "left")  # one row a date
    e = e.withColumns({"swing": F.abs("ret") * 100, "index_oc": F.col("r"), "good_day": cs.first_of_date("pred_0", "date", "entity"), "family_cv": F.col("pred_cv")})
    e = e.withColumn("seed_cv", sco.row_std(PREDS[:2]) / F.greatest(F.abs(sco.row_mean(PREDS[:2])), F.lit(1e-9)))
    return rules.dual_layers(e, THRESHOLDS, LAYERS)


@query("SELECT entity, date, strict, strict_tight, strong, m1, m3, layer, CASE layer WHEN 'overlap_core' THEN 1 WHEN 'strong_only' THEN 2 WHEN 'strict_only' THEN 3 WHEN 'layer2_m1_m3_overlap' THEN 4 WHEN 'layer2_m1_only' THEN 5 WHEN 'layer2_m3_only' THEN 5 ELSE 99 END AS layer_priority FROM du", DP, EW, SC, EN, DU)
def dual_layers(spark, d):
    return layered(spark, d).select("entity", "date", "strict", "strict_tight", "strong", "m1", "m3", "layer", "layer_priority")


@query(" UNION ALL ".join(f"SELECT '{k}' AS choice, entity, date FROM du WHERE {c}" for k, c in (("all", "layer <> 'none'"), ("layer1", "strict OR strong"), ("layer2", "m1 OR m3"), ("strict", "strict"), ("strong", "strong"))), DP, EW, SC, EN, DU)
def layer_filters(spark, d):
    base = layered(spark, d)
    choices = F.explode(F.array_compact(F.array(*[F.when(rules.in_layer(k), k) for k in ("all", "layer1", "layer2", "strict", "strong")])))
    return base.select(choices.alias("choice"), "entity", "date")


FC = """fc0 AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY pred_0 DESC, entity) <= 1 AS sa, row_number() OVER (PARTITION BY date ORDER BY pred_1 DESC, entity) <= 3 AS sb,
  row_number() OVER (PARTITION BY date ORDER BY pred_2 DESC, entity) <= 5 AS sc_, coalesce((rank() OVER (PARTITION BY date ORDER BY vol) + (count(*) OVER (PARTITION BY date, vol) - 1) / 2.0) / count(vol) OVER (PARTITION BY date) <= 0.75791696, false) AS gate_pass FROM sc),
fc AS (SELECT *, sa::INT + sb::INT + sc_::INT AS family_count, sb AND gate_pass AS production FROM fc0)"""


def families(spark, d):
    s = scores(spark, d).select("entity", "date", "vol", "ret", F.col("pred_0").alias("fa_pred"), F.col("pred_1").alias("fb_pred"), F.col("pred_2").alias("fc_pred"))
    return rules.family_consensus(s, {"fa": 1, "fb": 3, "fc": 5}, "date", "entity", "vol", 0.75791696, "fb")


@query(
    """SELECT entity, date, family_count::INT AS family_count, round((pred_0 + pred_1 + pred_2) / 3, 6) AS ensemble_pred, gate_pass, production, concat_ws('|', CASE WHEN sa THEN 'fa' END, CASE WHEN sb THEN 'fb' END, CASE WHEN sc_ THEN 'fc' END) AS family_tags,
  concat_ws('|', CASE WHEN production THEN 'PRODUCTION' END, CASE family_count WHEN 3 THEN 'CONSENSUS_3' WHEN 2 THEN 'CONSENSUS_2' WHEN 1 THEN 'FAMILY_ONLY' END) AS signal_tag FROM fc WHERE production OR family_count >= 1""",
    DP, SC, FC,
)
def family_consensus(spark, d):
    return families(spark, d).where("output").select("entity", "date", "family_count", r6("ensemble_pred"), "gate_pass", "production", "family_tags", "signal_tag")


_PICKS = """pk AS (SELECT 'fa' AS family, entity, date, (nxt > 0.01)::INT AS target FROM nx WHERE sa UNION ALL SELECT 'fb', entity, date, (nxt > 0.01)::INT FROM nx WHERE sb UNION ALL SELECT 'fc', entity, date, (nxt > 0.01)::INT FROM nx WHERE sc_)"""
_NX = "nx AS (SELECT *, lead(ret) OVER (PARTITION BY entity ORDER BY date) AS nxt FROM fc)"


@query(
    """SELECT s.lf AS left, s.rf AS right, l.n AS left_any_days, r.n AS right_any_days, s.a AS shared_any_days, CASE WHEN l.n > 0 THEN round(s.a / l.n, 6) ELSE 0 END AS over_left, CASE WHEN r.n > 0 THEN round(s.a / r.n, 6) ELSE 0 END AS over_right,
  s.b AS shared_all_days, coalesce(e.n, 0) AS same_entity FROM (SELECT x.family AS lf, y.family AS rf, count(*) FILTER (x.any_fp AND y.any_fp) AS a, count(*) FILTER (x.all_fp AND y.all_fp) AS b FROM dy x JOIN dy y ON x.date = y.date AND x.family < y.family GROUP BY 1, 2) s
  JOIN an l ON l.family = s.lf JOIN an r ON r.family = s.rf LEFT JOIN (SELECT x.family AS lf, y.family AS rf, count(*) AS n FROM (SELECT DISTINCT family, entity, date FROM pk WHERE target = 0) x JOIN (SELECT DISTINCT family, entity, date FROM pk WHERE target = 0) y
    ON x.date = y.date AND x.entity = y.entity AND x.family < y.family GROUP BY 1, 2) e ON e.lf = s.lf AND e.rf = s.rf""",
    DP, SC, FC, _NX, _PICKS, "dy AS (SELECT family, date, bool_or(target = 0) AS any_fp, bool_and(target = 0) AS all_fp FROM pk GROUP BY 1, 2)", "an AS (SELECT family, count(*) FILTER (any_fp) AS n FROM dy GROUP BY 1)",
)
def failure_overlap(spark, d):
    from panelforge.operators.windows import over

    f = families(spark, d).withColumn("target", (F.lead("ret").over(over("entity", "date")) > 0.01).cast("int"))
    chosen = F.array_compact(F.array(*[F.when(F.col(f"{k}_selected"), k) for k in ("fa", "fb", "fc")]))
    picks = f.select(F.explode(chosen).alias("family"), "entity", "date", "target")
    out = ev.failure_overlap(picks, "family", "date", "entity", "target")
    return out.select(*[r6(c) if c.startswith("over") else F.col(c) for c in out.columns])


# ---- simulation ----------------------------------------------------------------------------------

HORIZON, GAIN, CUT = 3, 0.08, -0.05
SG = "sg AS (SELECT entity, date, ret AS sig_ret FROM en WHERE avg_pred_rank <= 3)"


def signals(spark, d):
    return ensemble(spark, d).where("avg_pred_rank <= 3").select("entity", "date")


def prices(spark, d):
    return daily_panel(spark, d).select("entity", "date", "open", "high", "close")


SIM = f"""cl AS (SELECT date, r, row_number() OVER (ORDER BY date) - 1 AS pos FROM ew),
px AS (SELECT entity, pos, open, high, close FROM dp JOIN cl USING (date)),
s0 AS (SELECT sg.entity, sg.date, k, p.open, p.high, p.close, b.r FROM sg JOIN cl t USING (date) CROSS JOIN (SELECT unnest(generate_series(1, {HORIZON})) AS k) LEFT JOIN px p ON p.entity = sg.entity AND p.pos = t.pos + k LEFT JOIN cl b ON b.pos = t.pos + k),
s1 AS (SELECT *, bool_and(open IS NOT NULL AND high IS NOT NULL AND close IS NOT NULL AND r IS NOT NULL AND r > -1) OVER (PARTITION BY entity, date ORDER BY k) AS ok, exp(sum(ln(1 + r)) OVER (PARTITION BY entity, date ORDER BY k)) - 1 AS b,
  max(open) FILTER (k = 1 AND open > 0) OVER (PARTITION BY entity, date) AS buy FROM s0),
s2 AS (SELECT *, max((k = 1 AND close / buy - 1 - b <= {CUT} + 1e-12)::INT) OVER (PARTITION BY entity, date) AS st FROM s1 WHERE ok AND buy IS NOT NULL),
s3 AS (SELECT *, CASE WHEN st = 1 THEN CASE WHEN k = 2 THEN 't1_stop_t2_open' END WHEN k = 1 THEN NULL WHEN open / buy - 1 - b >= {GAIN} - 1e-12 THEN 'profit_open' WHEN high / buy - 1 - b >= {GAIN} - 1e-12 THEN 'profit_intraday'
  WHEN close / buy - 1 - b <= {CUT} + 1e-12 THEN 'stop_close' WHEN k = {HORIZON} THEN CASE WHEN close / buy - 1 - b >= {GAIN} - 1e-12 THEN 'expiry_gain' ELSE 'expiry_close' END END AS code FROM s2),
s4 AS (SELECT entity, date, any_value(buy) AS buy, min(k) FILTER (code IS NOT NULL) AS hk, max(k) AS lk FROM s3 GROUP BY entity, date),
s5 AS (SELECT s4.entity, s4.date, s4.buy, h.code, coalesce(hk, lk) AS hd, coalesce(h.b, l.b) AS b,
  CASE h.code WHEN 't1_stop_t2_open' THEN h.open WHEN 'profit_open' THEN h.open WHEN 'profit_intraday' THEN h.buy * (1 + h.b + {GAIN}) WHEN 'stop_close' THEN h.buy * (1 + h.b + ({CUT})) ELSE coalesce(h.close, l.close) END AS price
  FROM s4 LEFT JOIN s3 h ON h.entity = s4.entity AND h.date = s4.date AND h.k = hk JOIN s3 l ON l.entity = s4.entity AND l.date = s4.date AND l.k = lk),
au AS (SELECT sg.entity, sg.date, buy, CASE WHEN code IS NOT NULL THEN price END AS sell, price / buy - 1 AS ret, price / buy - 1 - b AS ret_ew, b AS bench, hd AS holding_days, code AS exit_reason,
  CASE WHEN code IS NOT NULL THEN (code IN ('profit_open', 'profit_intraday', 'expiry_gain'))::INT END AS target FROM sg LEFT JOIN s5 ON s5.entity = sg.entity AND s5.date = sg.date)"""
_AU = "SELECT entity, date, round(buy, 9) AS buy, round(sell, 9) AS sell, round(ret, 6) AS ret, round(ret_ew, 6) AS ret_ew, round(bench, 6) AS bench, holding_days::INT AS holding_days, exit_reason, target FROM au"


def audited(spark, d):
    return simulate.simulate_adjusted(signals(spark, d), prices(spark, d), ew_index(spark, d), HORIZON, GAIN, CUT, ["entity", "date"])


def _audit_cols(a):
    return a.select("entity", "date", F.round("buy", 9).alias("buy"), F.round("sell", 9).alias("sell"), r6("ret"), r6("ret_ew"), r6("bench"), F.col("holding_days").cast("int").alias("holding_days"), "exit_reason", "target")


@query(_AU, DP, EW, SC, EN, SG, SIM)
def sim_adjusted(spark, d):
    return _audit_cols(audited(spark, d))


@query(_AU, DP, EW, SC, EN, SG, SIM)
def sim_refill(spark, d):
    """Half of the audit is already resolved and stays; the rest is simulated again, which gives the same table."""
    first = audited(spark, d)
    stale = first.withColumns({c: F.when(F.col("entity") % 2 == 0, F.col(c)) for c in ("buy", "sell", "ret", "ret_ew", "bench", "holding_days", "exit_reason", "target")})
    return _audit_cols(simulate.refill(stale, prices(spark, d), ew_index(spark, d), HORIZON, GAIN, CUT, ["entity", "date"]))


LD = "ld AS (SELECT entity, date, count(*) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ahead, " + ", ".join(f"lead({c}, {k}) OVER (PARTITION BY entity ORDER BY date) AS t{k}_{c}" for k in range(1, 5) for c in ("open", "high", "close")) + " FROM dp)"


def _raw_a():
    out = "CASE WHEN t1_open IS NULL OR t1_open <= 0 THEN NULL WHEN t1_close < t1_open * (1 - 0.05) AND t2_open IS NOT NULL THEN t2_open"
    for k in (2, 3):
        out += f" WHEN t{k}_open >= t1_open * (1 + 0.08) THEN t{k}_open WHEN t{k}_high >= t1_open * (1 + 0.08) THEN t1_open * (1 + 0.08) WHEN t{k}_close < t1_open * (1 - 0.05) THEN t{k}_close"
    return out + " ELSE t3_close END"


@query(f"SELECT entity, date, round(t1_open, 9) AS buy, round(sell, 9) AS sell, round(sell / t1_open - 1, 6) AS ret, CASE WHEN sell IS NOT NULL THEN (sell / t1_open - 1 >= 0.08)::INT END AS target FROM (SELECT *, {_raw_a()} AS sell FROM sg LEFT JOIN ld USING (entity, date))", DP, SC, EN, SG, LD)
def sim_raw_a(spark, d):
    out = simulate.simulate_raw_strict(signals(spark, d), prices(spark, d), 3, 0.08, 0.05)
    return out.select("entity", "date", F.round("buy", 9).alias("buy"), F.round("sell", 9).alias("sell"), r6("ret"), "target")


def _raw_b():
    x = lambda k, p, r: f"{{d: {k - 1}, p: {p}, r: '{r}'}}"
    out = f"CASE WHEN ahead < 1 OR t1_open <= 0 THEN NULL WHEN t1_close <= t1_open * (1 + -0.05) AND ahead >= 2 THEN {x(2, 't2_open', 't1_stop_t2_open')}"
    for k in (2, 3):
        out += f" WHEN ahead >= {k} AND t{k}_open >= t1_open * (1 + 0.08) THEN {x(k, f't{k}_open', 'tp_open')} WHEN ahead >= {k} AND t{k}_high >= t1_open * (1 + 0.08) THEN {x(k, 't1_open * (1 + 0.08)', 'tp_intraday')} WHEN ahead >= {k} AND t{k}_close <= t1_open * (1 + -0.05) THEN {x(k, f't{k}_close', 'stop_close')}"
    for k in (3, 2, 1):
        out += f" WHEN ahead >= {k} THEN {x(k, f't{k}_close', 'forced_close')}"
    return out + " END"


RB = f"rb AS (SELECT entity, date, t1_open AS buy, x.p AS sell, x.p / t1_open - 1 AS ret, x.d AS holding_days, x.r AS exit_reason, (x.r LIKE 'tp_%')::INT AS target FROM (SELECT *, {_raw_b()} AS x FROM sg LEFT JOIN ld USING (entity, date)))"


@query("SELECT entity, date, round(CASE WHEN sell > 0 THEN buy END, 9) AS buy, round(sell, 9) AS sell, round(ret, 6) AS ret, holding_days::INT AS holding_days, exit_reason, target FROM rb", DP, SC, EN, SG, LD, RB)
def sim_raw_b(spark, d):
    out = simulate.simulate_raw_forced(signals(spark, d), prices(spark, d), 3, 0.08, -0.05)
    return out.select("entity", "date", F.round("buy", 9).alias("buy"), F.round("sell", 9).alias("sell"), r6("ret"), "holding_days", "exit_reason", "target")


# ---- evaluation ----------------------------------------------------------------------------------

_PF = "CASE WHEN -coalesce(sum(ret) FILTER (ret < 0), 0) > 1e-9 THEN coalesce(sum(ret) FILTER (ret > 0), 0) / -sum(ret) FILTER (ret < 0) WHEN coalesce(sum(ret) FILTER (ret > 0), 0) > 0 THEN 'inf'::DOUBLE END"
TL = "tl0 AS (SELECT au.*, CASE WHEN au.entity % 3 = 0 THEN 'core' ELSE 'wide' END AS layer FROM au WHERE ret IS NOT NULL), tl AS (SELECT * FROM tl0 UNION ALL BY NAME SELECT * REPLACE ('ALL' AS layer) FROM tl0)"
_DD = """dd AS (SELECT layer, min(e / p - 1) AS max_drawdown, avg(r) AS avg_daily_ret FROM (SELECT *, max(e) OVER (PARTITION BY layer ORDER BY date) AS p FROM (SELECT layer, date, r, exp(sum(ln(1 + r)) OVER (PARTITION BY layer ORDER BY date)) AS e
  FROM (SELECT layer, date, avg(ret) AS r FROM tl GROUP BY layer, date))) GROUP BY layer)"""


def trades(spark, d):
    t = audited(spark, d).where("ret IS NOT NULL").withColumn("layer", F.when(F.col("entity") % 3 == 0, "core").otherwise("wide"))
    return ev.with_overall(t, "layer")


@query(
    f"""SELECT layer, trades, dates, round(precision, 6) AS precision, round(win_rate, 6) AS win_rate, round(tp_rate, 6) AS tp_rate, round(avg_ret, 6) AS avg_ret, round(median_ret, 6) AS median_ret, round(profit_factor, 6) AS profit_factor, round(profit_rate, 6) AS profit_rate,
  round(stop_rate, 6) AS stop_rate, round(expiry_rate, 6) AS expiry_rate, round(trades / greatest(dates, 1), 6) AS picks_per_day, round(max_drawdown, 6) AS max_drawdown, round(avg_daily_ret, 6) AS avg_daily_ret FROM
  (SELECT layer, count(*) AS trades, count(DISTINCT date) AS dates, avg(target) AS precision, avg((ret > 0)::INT) AS win_rate, avg((ret >= 0.08)::INT) AS tp_rate, avg(ret) AS avg_ret, median(ret) AS median_ret, {_PF} AS profit_factor,
   avg(coalesce(contains(exit_reason, 'profit'), false)::INT) AS profit_rate, avg(coalesce(contains(exit_reason, 'stop'), false)::INT) AS stop_rate, avg(coalesce(contains(exit_reason, 'expiry'), false)::INT) AS expiry_rate FROM tl GROUP BY layer) JOIN dd USING (layer)""",
    DP, EW, SC, EN, SG, SIM, TL, _DD,
)
def perf_overall_by_layer(spark, d):
    out = ev.summary(trades(spark, d), ["layer"], "date", "ret", "target", "exit_reason", strict=True)
    whole = {"layer", "trades", "dates"}
    return out.select(*[F.col(c) if c in whole else r6(c) for c in out.columns])


@query(
    f"""SELECT exit_reason, count(*) AS trades, count(DISTINCT date) AS dates, round(avg(target), 6) AS precision, round(avg((ret > 0)::INT), 6) AS win_rate, round(avg(ret), 6) AS avg_ret, round(median(ret), 6) AS median_ret, round(avg(holding_days), 6) AS avg_days
  FROM rb WHERE ret IS NOT NULL GROUP BY exit_reason""",
    DP, SC, EN, SG, LD, RB,
)
def perf_summary(spark, d):
    t = simulate.simulate_raw_forced(signals(spark, d), prices(spark, d), 3, 0.08, -0.05).where("ret IS NOT NULL")
    out = ev.summary(t, ["exit_reason"], "date", "ret", "target", also={"avg_days": F.avg("holding_days")})
    return out.select("exit_reason", "trades", "dates", *[r6(c) for c in ("precision", "win_rate", "avg_ret", "median_ret", "avg_days")])


@query("SELECT layer, round(max_drawdown, 6) AS max_drawdown FROM dd", DP, EW, SC, EN, SG, SIM, TL, _DD)
def max_drawdown(spark, d):
    return ev.daily_drawdown(trades(spark, d), ["layer"], "date", "ret").select("layer", r6("max_drawdown"))


@query(f"SELECT exit_reason, round({_PF}, 6) AS pf_strict, round(CASE WHEN -coalesce(sum(ret) FILTER (ret < 0), 0) > 1e-9 THEN coalesce(sum(ret) FILTER (ret > 0), 0) / -sum(ret) FILTER (ret < 0) ELSE 'inf'::DOUBLE END, 6) AS pf FROM rb WHERE ret IS NOT NULL GROUP BY exit_reason", DP, SC, EN, SG, LD, RB)
def profit_factor(spark, d):
    t = simulate.simulate_raw_forced(signals(spark, d), prices(spark, d), 3, 0.08, -0.05).where("ret IS NOT NULL")
    return t.groupBy("exit_reason").agg(r6(ev.profit_factor("ret", True), "pf_strict"), r6(ev.profit_factor("ret"), "pf"))


@query(
    """SELECT suffix, horizon, take_profit_pct, stop_loss_pct, count(*) AS trades, round(avg(target), 6) AS precision, round(avg(ret_raw), 6) AS avg_ret FROM (
  SELECT 'h3m80d50' AS suffix, 3.0::DOUBLE AS horizon, 8.0::DOUBLE AS take_profit_pct, -5.0::DOUBLE AS stop_loss_pct, target, ret AS ret_raw FROM rb UNION ALL
  SELECT 'h2m25d25', 2.0::DOUBLE, 2.5::DOUBLE, -2.5::DOUBLE, (ret > 0.025)::INT, ret * 2 FROM rb) GROUP BY ALL""",
    DP, SC, EN, SG, LD, RB,
)
def targets_long(spark, d):
    t = simulate.simulate_raw_forced(signals(spark, d), prices(spark, d), 3, 0.08, -0.05)
    wide = t.select("entity", "date", F.col("target").alias("target_h3m80d50"), F.col("ret").alias("ret_raw_h3m80d50"), (F.col("ret") > 0.025).cast("int").alias("target_h2m25d25"), (F.col("ret") * 2).alias("ret_raw_h2m25d25"))
    long = ev.targets_long(wide, ["entity", "date"])
    return long.groupBy("suffix", "horizon", "take_profit_pct", "stop_loss_pct").agg(F.count(F.lit(1)).alias("trades"), r6(F.avg("target"), "precision"), r6(F.avg("ret_raw"), "avg_ret"))


@query("SELECT round(quantile_cont(abs(ret), 0.99), 6) AS q99 FROM rb WHERE ret IS NOT NULL", DP, SC, EN, SG, LD, RB)
def quality_guard(spark, d):
    t = simulate.simulate_raw_forced(signals(spark, d), prices(spark, d), 3, 0.08, -0.05).where("ret IS NOT NULL")
    return t.agg(r6(ev.quality_guard("ret", most=5.0), "q99"))


OS = """os0 AS (SELECT au.entity, au.date, buy, bench, holding_days, 2 + au.entity % 2 AS day, lead_close AS first_close FROM au LEFT JOIN (SELECT entity, date, lead(close, 1) OVER (PARTITION BY entity ORDER BY date) AS lead_close FROM dp) USING (entity, date) WHERE buy > 0 AND bench IS NOT NULL)"""


def sheet(spark, d):
    from panelforge.operators.windows import over

    first = prices(spark, d).select("entity", "date", F.lead("close", 1).over(over("entity", "date")).alias("first_close"))
    p = audited(spark, d).join(first, ["entity", "date"], "left").withColumn("day", 2 + F.col("entity") % 2)
    return od.order_sheet(p, HORIZON, GAIN, CUT)


@query(
    f"""SELECT entity, date, round(buy * (1 + bench + {GAIN}), 6) AS gain_price, round(CASE WHEN day = 2 AND coalesce(first_close / buy - 1 - bench <= {CUT}, false) THEN -1 ELSE buy * (1 + bench + ({CUT})) END, 6) AS cut_price, ({HORIZON} - holding_days)::INT AS expire FROM os0""",
    DP, EW, SC, EN, SG, SIM, OS,
)
def order_sheet(spark, d):
    return sheet(spark, d).select("entity", "date", r6("gain_price"), r6("cut_price"), F.col("expire").cast("int").alias("expire"))


@query("SELECT model, horizon, gain, entity, date, priority FROM (SELECT 'm1' AS model, 5 AS horizon, 8.0::DOUBLE AS gain, entity, date, CASE WHEN strict THEN 1 ELSE 2 END AS priority FROM du WHERE layer <> 'none' UNION ALL SELECT 'm2', 2, 5.5::DOUBLE, entity, date, family_count::INT FROM fc WHERE production)", DP, EW, SC, EN, DU, FC)
def signal_union(spark, d):
    a = layered(spark, d).where("layer <> 'none'").select("entity", "date", F.when(F.col("strict"), 1).otherwise(2).alias("priority"))
    b = families(spark, d).where("production").select("entity", "date", F.col("family_count").alias("priority"))
    return rules.daily_union([(a, {"model": "m1", "horizon": 5, "gain": 8.0}), (b, {"model": "m2", "horizon": 2, "gain": 5.5})], ["model", "horizon", "gain", "entity", "date", "priority"])


@query("SELECT entity, date, CASE priority_name WHEN 'P1A' THEN 1 WHEN 'P1B' THEN 1 WHEN 'P2' THEN 2 WHEN 'P3' THEN 3 END::INT AS p FROM pw WHERE priority_name <> ''", DP, SC, EN, VO, LA)
def priority_mapping(spark, d):
    p = laddered(spark, d).where("priority_name <> ''")
    return p.select("entity", "date", rules.mapped(F.col("priority_name"), {"P1A": 1, "P1B": 1, "P2": 2, "P3": 3}, raise_unknown=True).alias("p"))
