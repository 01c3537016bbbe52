"""Daily features of the panel, as blocks of Columns.

A block takes the entity's window and gives ``{name: Column}`` over columns that earlier
blocks or the joined sources supply; ``add_blocks`` chains blocks as projections over
one partitioning, so windows nested in windows cost one more pass over sorted
rows and no further exchange.  Ask for the blocks you need: the full set is some
hundreds of columns before lags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from panelforge.functions.nulls import clip, is_true, log_nonzero, null_max, null_min, safe_div_eps

from . import windows as win
from .crosssec import rank_share

MOMENTA = (2, 3, 5, 10, 20)
FLOW_SIZES = ("elg", "lg", "md", "sm")
CHIPS = ("cost_5pct", "cost_15pct", "cost_50pct", "cost_85pct", "cost_95pct", "weight_avg")
MARGIN = ("rzye", "rqye", "rzmre", "rqyl", "rzche", "rqchl", "rqmcl", "rzrqye")

c = F.col


def adjusted(w: WindowSpec, long: int = 60, size: int = 120) -> dict[str, Column]:
    vwap = safe_div_eps("amount", "vol")
    return {f"{x}_adj": c(x) * c("adj_factor") for x in ("open", "high", "low", "close")} | {"vwap_adj": vwap * c("adj_factor"), "ret_1": c("pct_chg") / 100}


def price(w: WindowSpec, long: int = 60, size: int = 120) -> dict[str, Column]:
    o, h, lo, cl, vw = (c(f"{x}_adj") for x in ("open", "high", "low", "close", "vwap"))
    return {
        **{f"ret_{k}": win.log_momentum(cl, w, k) for k in MOMENTA},
        **{f"vwap_log_ret_{k}": win.log_momentum(vw, w, k) for k in MOMENTA},
        "oc_ret": safe_div_eps(cl - o, o),
        "close_to_high": safe_div_eps(h - cl, cl),
        "close_to_low": safe_div_eps(cl - lo, cl),
        "vwap_close_ratio": safe_div_eps(cl - vw, vw),
        "vwap_high_ratio": safe_div_eps(h - vw, vw),
        "vwap_low_ratio": null_min(safe_div_eps(lo - vw, vw), 0.0),
        "true_range_pct": F.abs(h - lo) / F.nullif(cl, F.lit(0.0)),
        "log_vol": log_nonzero("vol"),
        "log_amount": log_nonzero("amount"),
        "vwap_z": win.zscore(vw, w, long),
    }


def trend(w: WindowSpec, long: int = 60, size: int = 120) -> dict[str, Column]:
    return {
        "ret_3_minus_ret_10": c("ret_3") - c("ret_10"),
        "ret_5_minus_ret_20": c("ret_5") - c("ret_20"),
        "vwap_log_ret_3_minus_10": c("vwap_log_ret_3") - c("vwap_log_ret_10"),
        "ret_1_minus_ret_5_avg": c("ret_1") - c("ret_5") / 5,
        "vwap_close_z": win.zscore("vwap_close_ratio", w, 20),
        "true_range_pct_z": win.zscore("true_range_pct", w, 20),
        **{f"true_range_mean_{k}": win.mean("true_range_pct", w, k) for k in (5, 10, 20)},
        **{f"ret_std_{k}": win.std("ret_1", w, k) for k in (5, 10, 20)},
        **{f"{a}_rv_{k}": win.std(x, w, k) for a, x in (("vol", "log_vol"), ("amt", "log_amount")) for k in (5, 20)},
    }


def range_scores(w: WindowSpec, long: int = 60, size: int = 120) -> dict[str, Column]:
    return {
        **{f"true_range_mean_{k}_z": win.zscore(f"true_range_mean_{k}", w, long) for k in (5, 10, 20)},
        **{f"ret_std_{k}_z": win.zscore(f"ret_std_{k}", w, long) for k in (5, 10, 20)},
        **{f"{a}_rv_{k}_z": win.zscore(f"{a}_rv_{k}", w, long) for a in ("vol", "amt") for k in (5, 20)},
        "vol_z": win.zscore("vol", w, long),
        "amount_z": win.zscore("amount", w, long),
        "vwap_imbalance": safe_div_eps((c("close_adj") - c("vwap_adj")) / F.nullif(c("close_adj"), F.lit(0.0)), "true_range_mean_20"),
    }


def turnover(w: WindowSpec, long: int = 60, size: int = 120) -> dict[str, Column]:
    t = F.log1p(null_max("turnover_rate_f", 0.0))
    return {"turnover_f_log": t, "turnover_z_20": win.baseline_z(t, w, 20), "turnover_surprise_10": win.surprise(t, w, 10), "turnover_prank": win.past_percentile(t, w, long), "turnover_trend_5_20": win.trend_gap(t, w, 5, 20)}


def turnover_states(w: WindowSpec, long: int = 60, size: int = 120) -> dict[str, Column]:
    comp = c("ret_std_5_z") - c("ret_std_20_z")
    return {
        "turnover_accel_5_20": win.diff("turnover_trend_5_20", w),
        "vol_comp_z": comp,
        "turnover_in_compression": -c("turnover_surprise_10") * comp,
        "pressure_build": -c("turnover_trend_5_20") * comp,
        "exhaustion_risk": c("turnover_z_20") * null_max(comp, 0.0),
        "turnover_range_pressure": -c("turnover_trend_5_20") * (c("true_range_mean_5_z") - c("true_range_mean_20_z")),
    }


def flow(w: WindowSpec, long: int = 60, size: int = 120) -> dict[str, Column]:
    rates = {f"mf_{k}_rate": c(f"buy_{k}_amount_rate") * 0.01 for k in FLOW_SIZES}
    rates["mf_inst_rate"] = rates["mf_elg_rate"] + rates["mf_lg_rate"]
    return rates | {f"{k}_z": win.zscore(x, w, 20) for k, x in rates.items()} | {"mf_price_align_z_20": win.zscore(rates["mf_inst_rate"] * c("ret_1"), w, 20), "mf_available": rates["mf_inst_rate"].isNotNull().cast("int")}


def auction(w: WindowSpec, long: int = 60, size: int = 120) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for side, ref in (("o", "open_adj"), ("c", "close_adj")):
        o, cl, h, lo, vw = (c(f"{x}_auction_{side}") * c("adj_factor") for x in ("open", "close", "high", "low", "vwap"))
        out |= {
            f"auc_{side}_ret": safe_div_eps(cl - o, o),
            f"auc_{side}_range": safe_div_eps(h - lo, o),
            f"auc_{side}_vwap_ratio": safe_div_eps(vw - c("vwap_adj"), "vwap_adj"),
            f"auc_{side}_amt_ratio": safe_div_eps(f"amount_auction_{side}", "amount"),
            f"auc_{side}_vol_ratio": safe_div_eps(f"vol_auction_{side}", "vol"),
            f"auc_{side}_close_position": safe_div_eps(cl - lo, h - lo),
            f"auc_{side}_efficiency": safe_div_eps(F.abs(cl - o), h - lo),
            f"auc_{side}_signed_efficiency": safe_div_eps(cl - o, h - lo),
            f"auc_{side}_vs_{ref[:-4]}": safe_div_eps(cl - c(ref), ref),
        }
    ret_o, ret_c = out["auc_o_ret"], out["auc_c_ret"]
    return out | {"auction_reversal": -(ret_o * ret_c), "auction_direction_balance": out["auc_o_signed_efficiency"] + out["auc_c_signed_efficiency"], "auction_to_continuous_return": ret_c - ret_o}


def size_and_chips(w: WindowSpec, long: int = 60, size: int = 120) -> dict[str, Column]:
    density = safe_div_eps(c("cost_95pct") - c("cost_5pct"), "cost_50pct")
    return {
        **{f"{k}_z": win.zscore(k, w, size) for k in ("total_mv", "circ_mv", *CHIPS)},
        "chip_density": density,
        "chip_pressure": safe_div_eps(c("cost_50pct") * c("adj_factor") - c("close_adj"), "close_adj"),
        "crowdedness": (c("winner_rate") / 100 - 0.5) * density,
    }


def margin(w: WindowSpec, long: int = 60, size: int = 120) -> dict[str, Column]:
    return {f"{k}_z": win.zscore(k, w, long) for k in MARGIN} | {"margin_pressure": safe_div_eps("rzmre", "float_share"), "short_pressure": safe_div_eps("rqyl", "float_share"), "net_margin_flow": safe_div_eps(c("rzmre") - c("rzche"), "float_share")}


def minutes_since_open(time: Column) -> Column:
    """Minutes from 09:30 of ``H:MM``, HHMMSS or HHMM text; five digits or more hold seconds; no lunch break."""
    text = F.trim(time.cast("string"))
    digits = F.regexp_replace(F.regexp_replace(text, r"\.0+$", ""), r"\D", "")
    seconds = F.length(digits) >= 5
    h = F.coalesce(F.nullif(F.regexp_extract(text, r"(\d{1,2}):(\d{2})", 1), F.lit("")), F.when(seconds, F.regexp_extract(digits, r"^(\d+)\d{4}$", 1)).otherwise(F.regexp_extract(digits, r"^(\d+)\d{2}$", 1)))
    m = F.coalesce(F.nullif(F.regexp_extract(text, r"(\d{1,2}):(\d{2})", 2), F.lit("")), F.when(seconds, F.regexp_extract(digits, r"(\d{2})\d{2}$", 1)).otherwise(F.regexp_extract(digits, r"(\d{2})$", 1)))
    return (h.try_cast("double") - 9) * 60 + (m.try_cast("double") - 30)


def limit_events(df: DataFrame, w: WindowSpec, has_source: Column, code: str = "entity") -> DataFrame:
    """Event counts, success ratios, recency, first time, sealing strength and board flag; all null without a source.

    ``df`` has limit (U, D, Z or null), open_times, first_time, fd_amount, float_mv, total_mv, turnover_rate_f and limit_rate.
    """
    flags = {"limit_up": c("limit") == "U", "limit_down": c("limit") == "D", "broken_board": c("limit") == "Z", "sealed_board": (c("limit") == "U") & (c("open_times") == 0)}
    flags = {k: is_true(v) for k, v in flags.items()}
    out = df
    cap = 60
    for name, event in (("limit_event", flags["limit_up"] | flags["limit_down"] | flags["broken_board"]), ("limit_up", flags["limit_up"]), ("broken_board", flags["broken_board"]), ("limit_down", flags["limit_down"])):
        out = win.add_days_since(out, f"days_since_last_{name}_{cap}", event, w, cap)
    counts = {f"{k}_day_cnt_{n}": win.event_days(f, w, n) for k, f in flags.items() for n in (1, 2, 3, 5, 10)}
    out = out.withColumns(counts)
    fd = safe_div_eps("fd_amount", F.coalesce("float_mv", "total_mv"))
    twenty = F.coalesce(c(code).cast("string").rlike("^(300|301|688|689)"), F.lit(False)) | is_true(c("limit_rate").between(0.19, 1.0) | (c("limit_rate") >= 19))
    extra = {f"board_success_ratio_{n}": F.when(c(f"limit_up_day_cnt_{n}") > 0, c(f"sealed_board_day_cnt_{n}") / c(f"limit_up_day_cnt_{n}")).otherwise(0.0) for n in (1, 2, 3, 5, 10)}
    extra |= {"first_time_min": minutes_since_open(c("first_time")), "fd_ratio": fd, "fd_ratio_log": F.log1p(fd * 1000), "failure_pressure": c("turnover_rate_f") * F.log1p("open_times"), "is_20cm": twenty.cast("int")}
    out = out.withColumns(extra)
    made = [x for x in out.columns if x not in df.columns]
    return out.select(*df.columns, *[F.when(has_source, c(x)).alias(x) for x in made])


def index_features(df: DataFrame, date: str, prefixes: tuple[str, ...] = ("ew", "mcap")) -> DataFrame:
    """Momenta, open-close return and deviation of an index, and breadth aliases; one row a date."""
    from pyspark.sql import Window

    w = Window.orderBy(date)  # one row a date
    new = {}
    for p in prefixes:
        new |= {f"{p}_ret": c(f"{p}_close_ret"), f"{p}_oc_ret": safe_div_eps(f"{p}_close", f"{p}_open") - 1, f"{p}_ret_std_20": win.std(f"{p}_close_ret", w, 20)}
        new |= {f"{p}_mom_{k}": win.log_momentum(f"{p}_close", w, k) for k in MOMENTA}
    return df.withColumns(new)


def market_features(df: DataFrame, date: str) -> DataFrame:
    """Flow and northbound means, z-scores, acceleration; foreign returns and volumes; one row a date."""
    from pyspark.sql import Window

    w = Window.orderBy(date)  # one row a date
    out = df.withColumns({"mkt_ret_sh": c("pct_change_sh") / 100, "mkt_ret_sz": c("pct_change_sz") / 100, "mkt_mf_inst_rate": c("net_amount_rate") * 0.01, "mkt_mf_retail_rate": c("buy_sm_amount_rate") * 0.01, "mkt_flow_concentration": (F.abs("buy_elg_amount_rate") + F.abs("buy_lg_amount_rate")) * 0.01, "hsgt_hgt_minus_sgt": c("hgt") - c("sgt")})
    new = {"mkt_ret_spread": c("mkt_ret_sh") - c("mkt_ret_sz"), "mkt_mf_inst_z_20": win.zscore("mkt_mf_inst_rate", w, 20), "mkt_mf_available": c("mkt_mf_inst_rate").isNotNull().cast("int"), "hsgt_available": c("north_money").isNotNull().cast("int")}
    new |= {f"mkt_mf_inst_ma_{k}": win.mean("mkt_mf_inst_rate", w, k) for k in (3, 5, 10)}
    for side in ("north", "south"):
        new |= {f"hsgt_{side}_money_ma_{k}": win.mean(f"{side}_money", w, k) for k in (3, 5)} | {f"hsgt_{side}_money_z_20": win.zscore(f"{side}_money", w, 20)}
    for p in [x[: -len("_pct_chg")] for x in df.columns if x.endswith("_pct_chg")]:
        new[f"{p}_ret"] = c(f"{p}_pct_chg") / 100
        if f"{p}_vol" in df.columns:
            new[f"{p}_vol_z"] = win.zscore(log_nonzero(f"{p}_vol"), w, 60)
    out = out.withColumns(new)
    return out.withColumn("hsgt_north_money_accel_3", win.diff("hsgt_north_money_ma_3", w, 3))


def breadth(w: WindowSpec | None = None, long: int = 60, size: int = 120) -> dict[str, Column]:
    spread = c("up_ratio") - c("down_ratio")
    return {"mkt_up_down_ratio_spread": spread, "mkt_gt2_ltminus2_spread": c("gt_2pct_ratio") - c("lt_minus_2pct_ratio"), "mkt_limit_up_down_spread": safe_div_eps((c("limit_up_count") - c("limit_down_count")).cast("double"), "coverage_ratio"), "mkt_breadth_return_alignment": spread * c("ew_ret")}


def relative_returns(index: str, own: tuple[str, ...] = ("1", "2", "3", "5", "10", "20")) -> dict[str, Column]:
    """Own returns minus those of an index joined as ``{index}_ret``, ``{index}_mom_k``, ``{index}_oc_ret``."""
    out = {f"ret_{k}_rel_{index}": c(f"ret_{k}") - c(f"{index}_ret" if k == "1" else f"{index}_mom_{k}") for k in own}
    return out | {f"oc_ret_rel_{index}": c("oc_ret") - c(f"{index}_oc_ret")}


def against(w: WindowSpec, *indices: str) -> dict[str, Column]:
    """Beta to each index or industry joined as ``{index}_ret``, and volatility over its ``{index}_ret_std_20``."""
    out = {}
    for p in indices:
        out |= {f"beta_to_{p}_20d": win.beta("ret_1", f"{p}_ret", w, 20), f"vol_over_{p}_vol": F.log1p("realized_vol_5m") - F.log1p(f"{p}_ret_std_20")}
    return out


def flow_against_market(w: WindowSpec) -> dict[str, Column]:
    return {"mf_inst_rate_rel_mkt_z20": win.zscore(c("mf_inst_rate") - c("mkt_mf_inst_rate"), w, 20)}


def conditional(w: WindowSpec, long: int = 60, size: int = 120) -> dict[str, Column]:
    gt5 = clip("gt_5pct_ratio", 0.0, 1.0)
    return against(w, "ew") | {
        "ret_1_over_mkt_gt5_rate": safe_div_eps("ret_1", "gt_5pct_ratio"),
        "ret_1_in_weak_mkt": c("ret_1") * (1 - gt5),
        "ret_vol_confirm": c("ret_1") * c("vol_z"),
        "vol_expand_ret": c("ret_1") * clip("volume_ratio", 0.0, 20.0),
    }


def industry_features(df: DataFrame, grp: str, date: str, indices: tuple[str, ...] = ("ew",)) -> DataFrame:
    """Momenta, deviations, z-scores, beta, alpha, ranks by date and rank rotation of groups.

    ``df``: grp, date, open, high, low, close, vol, amount, float_mv, ret_1 and for each of ``indices`` p its p_ret and p_mom_k.
    """
    w = win.over(grp, date)
    out = df.withColumns({
        **{f"mom_{k}": win.log_momentum("close", w, k) for k in MOMENTA},
        "oc_ret": safe_div_eps("close", "open") - 1,
        "range_pct": safe_div_eps(c("high") - c("low"), "close"),
        "turnover_proxy": safe_div_eps("amount", "float_mv"),
        "ret_std_5": win.std("ret_1", w, 5),
        "ret_std_20": win.std("ret_1", w, 20),
        "amount_z_20": win.zscore(log_nonzero("amount"), w, 20),
        "vol_z_20": win.zscore(log_nonzero("vol"), w, 20),
        **{f"beta_{p}_20": win.beta("ret_1", f"{p}_ret", w, 20) for p in indices},
    })
    out = out.withColumns({
        "range_z_20": win.zscore("range_pct", w, 20),
        "turnover_z_20": win.zscore("turnover_proxy", w, 20),
        **{f"ret_rel_{p}": c("ret_1") - c(f"{p}_ret") for p in indices},
        **{f"mom{k}_rel_{p}": c(f"mom_{k}") - c(f"{p}_mom_{k}") for p in indices for k in (5, 20)},
        **{f"alpha_{p}_5": c("mom_5") - c(f"beta_{p}_20") * c(f"{p}_mom_5") for p in indices},
    })
    ranked = ("ret_1", "mom_2", "mom_3", "mom_5", "mom_10", "mom_20", *[f"{x}_rel_{p}" for p in indices for x in ("ret", "mom5", "mom20")])
    out = out.withColumns({f"{x}_rank": rank_share(x, date) for x in (*ranked, "amount_z_20", "turnover_z_20", "ret_std_20")})
    out = out.withColumns({f"{x}_rank_ma5": win.mean(f"{x}_rank", w, 5, 3) for x in ranked})
    return out.withColumns({f"{x}_rank_accel5": c(f"{x}_rank") - c(f"{x}_rank_ma5") for x in ranked})


BLOCKS = {f.__name__: f for f in (adjusted, price, trend, range_scores, turnover, turnover_states, flow, auction, size_and_chips, margin, breadth, conditional)}


def add_blocks(df: DataFrame, entity: str, date: str, *blocks: str, long: int = 60, size: int = 120) -> DataFrame:
    """Adds the named blocks, each of which may use the ones before."""
    w = win.over(entity, date)
    for b in blocks:
        df = df.withColumns(BLOCKS[b](w, long, size))
    return df
