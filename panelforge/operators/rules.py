"""Declarative rules: conditions, votes, priorities, gates and tags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.nulls import is_true, to_number

from .crosssec import passes_gate, rank_first, rank_share

PIPE = "|"


def conditions(df: DataFrame, rules: list) -> Column:
    """All of ``[column, "<=" or ">=", threshold]``; unknown columns and operators raise, missing counts as False."""
    out = F.lit(True)
    for name, op, threshold in rules:
        if name not in df.columns:
            raise ValueError(f"missing feature: {name}")
        if op not in ("<=", ">="):
            raise ValueError(f"unsupported operator: {op}")
        x = to_number(F.col(name))
        out = out & is_true(x <= float(threshold) if op == "<=" else x >= float(threshold))
    return out


def any_group(df: DataFrame, groups: list) -> Column:
    return reduce(lambda a, b: a | b, [conditions(df, g) for g in groups], F.lit(False))


def signal_models(df: DataFrame, specs: dict) -> DataFrame:
    """First the models with a base and conditions, then those that are the union of others."""
    base = {n: is_true(F.col(s["base"])) & conditions(df, s.get("conditions", [])) for n, s in specs.items() if "base" in s}
    out = df.withColumns(base)
    return out.withColumns({n: reduce(lambda a, b: a | b, [is_true(F.col(m)) for m in s["members"]]) for n, s in specs.items() if s.get("operator") == "or"})


def votes(df: DataFrame, ranks: list[str], date: str, tie: str, top: int = 3, strict: int = 4, loose: int = 3) -> DataFrame:
    """Counts seeds that rank a row in the top, and picks at most ``top`` rows a date with enough votes."""
    count = sum((is_true(F.col(r) <= top).cast("int") for r in ranks), F.lit(0))
    out = df.withColumn("votes", count).withColumn("top1", is_true(F.col("avg_pred_rank") <= 1))

    def pick(least: int, *order) -> Column:
        enough = F.col("votes") >= least
        return enough & (F.row_number().over(Window.partitionBy(date).orderBy(F.when(enough, 0).otherwise(1), *order)) <= top)

    return out.withColumns({"vote_loose": pick(loose, "avg_rank_raw", "avg_pred_rank", tie), "vote_strict": pick(strict, F.desc("votes"), "avg_rank_raw", tie)})


def first_match(pairs: list[tuple[Column, object]], default) -> Column:
    out = F
    for c, v in pairs:
        out = out.when(is_true(c), F.lit(v))
    return out.otherwise(F.lit(default))


def priority_ladder(df: DataFrame, kept: list[str], low_turnover: str, low: float, expansion: str, groups: list) -> DataFrame:
    """Mutually exclusive priorities: all kept models; top-1 with low turnover; any kept model; expansion under any condition group."""
    n = sum((is_true(F.col(k)).cast("int") for k in kept), F.lit(0))
    out = df.withColumn("model_count", n)
    p1a = F.col("model_count") == len(kept)
    p1b = is_true((F.col("avg_pred_rank") <= 1) & (F.col(low_turnover) <= low))
    p2 = F.col("model_count") >= 1
    p3 = is_true(F.col(expansion)) & any_group(df, groups)
    names = [(p1a, "P1A"), (p1b, "P1B"), (p2, "P2"), (p3, "P3")]
    return out.withColumns({"priority": first_match([(c, v) for (c, _), v in zip(names, (1, 1, 2, 3), strict=True)], 0), "priority_name": first_match(names, "")})


def joined_tags(pairs: list[tuple[Column, object]]) -> Column:
    """Tags of the conditions that hold, joined by a pipe."""
    return F.concat_ws(PIPE, *[F.when(is_true(c), F.lit(t) if isinstance(t, str) else t) for c, t in pairs])


def watchlist(df: DataFrame, top: int = 5, least_votes: int = 2) -> DataFrame:
    """Reasons to watch rows without a priority; signal type and tag."""
    reason = joined_tags([(F.col("avg_pred_rank") <= 1, "avg_top1"), (F.col("avg_pred_rank") <= top, f"avg_top{top}"), (F.col("votes") >= least_votes, f"vote{least_votes}_top3")])
    out = df.withColumn("watch_reason", reason)
    watch = (F.col("priority") == 0) & (F.col("watch_reason") != "")
    trade = F.col("priority") > 0
    return out.withColumns({"watch": watch, "signal_type": F.when(trade, "TRADE").when(watch, "WATCHLIST").otherwise(""), "signal_tag": F.when(trade, F.col("priority_name")).when(watch, F.concat(F.lit("WATCHLIST_"), F.col("watch_reason"))).otherwise("")})


def dual_layers(df: DataFrame, t: dict[str, float], priority: dict[str, int]) -> DataFrame:
    """Two-layer gates on rank, day regime and score agreement; layer-1 labels override layer-2 ones."""
    out = df.withColumn("high_confidence", is_true((F.col("swing") <= t["swing_max"]) & (F.col("index_oc") <= t["index_oc_max"])))
    ok = (F.col("avg_rank") <= t["rank_top"]) & F.col("high_confidence")
    flags = {
        "strict": ok & (F.col("family_cv") <= t["strict_cv"]),
        "strict_tight": ok & (F.col("family_cv") <= t["tight_cv"]),
        "strong": ok & (F.col("good_day") >= t["good_day"]) & (F.col("seed_cv") <= t["seed_cv"]),
        "m1": (F.col("avg_rank") <= t["m1_rank"]) & (F.col("good_day") >= t["m1_good_day"]) & (F.col("family_cv") <= t["m1_cv"]) & (F.col("swing") <= t["m_swing"]),
        "m3": (F.col("avg_rank") <= t["m3_rank"]) & (F.col("good_day") >= t["good_day"]) & (F.col("seed_cv") <= t["seed_cv"]) & (F.col("swing") <= t["m_swing"]),
    }
    out = out.withColumns({k: is_true(c) for k, c in flags.items()})
    c = F.col
    layer = first_match(
        [(c("strict") & ~c("strong"), "strict_only"), (c("strong") & ~c("strict"), "strong_only"), (c("strict") & c("strong"), "overlap_core"),
         (c("m3") & ~c("m1"), "layer2_m3_only"), (c("m1") & ~c("m3"), "layer2_m1_only"), (c("m1") & c("m3"), "layer2_m1_m3_overlap")],
        "none",
    )
    return out.withColumn("layer", layer).withColumn("layer_priority", mapped(F.col("layer"), priority, 99))


def mapped(c: Column, mapping: dict[str, int], default: int | None = None, raise_unknown: bool = False) -> Column:
    """A literal mapping; an unknown value gives the default or raises when the plan runs."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    found = F.try_element_at(m, c)
    if raise_unknown:
        return F.when(found.isNull() & c.isNotNull(), F.raise_error(F.concat(F.lit("unknown value "), c)).cast("int")).otherwise(found)
    return F.coalesce(found, F.lit(default)) if default is not None else found


def in_layer(layer: str) -> Column:
    """all, layer1 (strict or strong), layer2, strict, strong."""
    return {"all": F.col("layer") != "none", "layer1": F.col("strict") | F.col("strong"), "layer2": F.col("m1") | F.col("m3"), "strict": F.col("strict"), "strong": F.col("strong")}[layer]


def layer_filter(df: DataFrame, layer: str) -> DataFrame:
    return df.where(in_layer(layer))


def family_consensus(df: DataFrame, families: dict[str, int], date: str, tie: str, gate: str, most: float, lead: str, tag: str = "PRODUCTION") -> DataFrame:
    """Per-family top-k picks, their number, consensus tags and the production gate of the lead family."""
    out = df.withColumns({f"{f}_rank": rank_first(f"{f}_pred", tie, date) for f in families})
    out = out.withColumns({f"{f}_selected": F.col(f"{f}_rank") <= k for f, k in families.items()})
    count = sum((F.col(f"{f}_selected").cast("int") for f in families), F.lit(0))
    out = out.withColumns({"family_count": count, "ensemble_pred": sum((F.col(f"{f}_pred") for f in families), F.lit(0.0)) / len(families), "gate_share": rank_share(gate, date), "gate_pass": passes_gate(gate, most, date)})
    out = out.withColumns({
        "consensus": first_match([(F.col("family_count") == 3, "CONSENSUS_3"), (F.col("family_count") == 2, "CONSENSUS_2"), (F.col("family_count") == 1, "FAMILY_ONLY")], ""),
        "family_tags": joined_tags([(F.col(f"{f}_selected"), f) for f in families]),
        "production": is_true((F.col(f"{lead}_rank") <= families[lead]) & F.col("gate_pass")),
    })
    return out.withColumns({"signal_tag": joined_tags([(F.col("production"), tag), (F.col("family_count") >= 1, F.col("consensus"))]), "output": F.col("production") | (F.col("family_count") >= 1)})


def daily_union(parts: list[tuple[DataFrame, dict]], columns: list[str]) -> DataFrame:
    """Signals of several models with their constants, one table."""
    frames = [df.withColumns({k: F.lit(v) for k, v in constants.items()}).select(*columns) for df, constants in parts]
    return reduce(lambda a, b: a.unionByName(b), frames)
