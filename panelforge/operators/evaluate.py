"""Summaries of simulated trades."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUFFIX = re.compile(r"^h(\d+)m(\d+)d(\d+)$")


def profit_factor(r: str, strict: bool = False) -> Column:
    """Gains / losses; without losses infinite (with ``strict`` only if there are gains, else missing)."""
    up, down = F.coalesce(F.sum(F.when(F.col(r) > 0, F.col(r))), F.lit(0.0)), -F.coalesce(F.sum(F.when(F.col(r) < 0, F.col(r))), F.lit(0.0))
    inf = F.lit(float("inf"))
    return F.when(down > 1e-9, up / F.nullif(down, F.lit(0.0))).when(up > 0, inf).otherwise(F.lit(None) if strict else inf)


def _fall(day: DataFrame, part: list[str], date: str, r: str) -> DataFrame:
    """Adds ``_fall``, each day's equity against its highest so far; equity starts after the first day."""
    w = Window.partitionBy(*part).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    eq = day.withColumn("_e", F.product(1 + F.coalesce(r, F.lit(0.0))).over(w))
    return eq.withColumn("_fall", F.col("_e") / F.max("_e").over(w) - 1)


def daily_drawdown(trades: DataFrame, groups: list[str], date: str, r: str) -> DataFrame:
    """Largest fall of the compounded daily mean return."""
    day = _fall(trades.groupBy(*groups, date).agg(F.avg(r).alias("_r")), groups, date, "_r")
    return day.groupBy(*groups).agg(F.min("_fall").alias("max_drawdown"), F.avg("_r").alias("avg_daily_ret"))


def summary(trades: DataFrame, groups: list[str], date: str, r: str, target: str, reason: str | None = None, take_profit: float = 0.08, strict: bool = False, also: dict[str, Column] | None = None) -> DataFrame:
    """One row a group: trades, dates, precision, win rate, mean and median return, profit factor, drawdown, exit shares.

    One aggregate gives the groups and their days, so the trades are evaluated once; ``also``: further aggregates.
    """
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("double"))
    aggs = {
        "trades": F.count(F.lit(1)), "precision": F.avg(target), "win_rate": share(F.col(r) > 0), "tp_rate": share(F.col(r) >= take_profit),
        "avg_ret": F.avg(r), "median_ret": F.median(r), "profit_factor": profit_factor(r, strict), **(also or {}),
    }
    if reason:
        aggs |= {f"{k}_rate": share(F.col(reason).contains(k)) for k in ("profit", "stop", "expiry")}
    keys = [F.col(c) for c in groups]
    both = trades.groupingSets([keys, [*keys, F.col(date)]], *keys, F.col(date)).agg((F.grouping(date) == 1).alias("_whole"), *[c.alias(k) for k, c in aggs.items()])
    both = _fall(both, [*groups, "_whole"], date, "avg_ret")
    whole, day = F.col("_whole"), ~F.col("_whole")
    out = both.groupBy(*groups).agg(
        F.first(F.when(whole, F.struct(*aggs)), ignorenulls=True).alias("_x"), F.count_if(day & F.col(date).isNotNull()).alias("dates"),
        F.min(F.when(day, F.col("_fall"))).alias("max_drawdown"), F.avg(F.when(day, F.col("avg_ret"))).alias("avg_daily_ret"),
    )
    per_day = F.col("_x.trades") / F.greatest("dates", F.lit(1))
    return out.select(*groups, "_x.trades", "dates", *[f"_x.{k}" for k in aggs if k != "trades"], per_day.alias("picks_per_day"), "max_drawdown", "avg_daily_ret")


def with_overall(trades: DataFrame, layer: str) -> DataFrame:
    """Each row under its layer and under ALL, so that one grouping gives both."""
    return trades.withColumn("_l", F.explode(F.array(F.lit("ALL"), F.col(layer)))).withColumn(layer, F.col("_l")).drop("_l")


def parse_suffix(suffix: str) -> dict[str, float]:
    """``h3m70d40``: three days, +7.0 %, -4.0 %."""
    m = SUFFIX.match(suffix)
    if not m:
        raise ValueError(f"not a target name: {suffix}")
    return {"horizon": int(m[1]), "take_profit_pct": int(m[2]) / 10, "stop_loss_pct": -int(m[3]) / 10}


def targets_long(df: DataFrame, keys: list[str], fields: tuple[str, ...] = ("target", "ret_raw", "ret_adj", "exit_type", "hold_days")) -> DataFrame:
    """Wide ``field_suffix`` columns to one row a suffix, with the suffix's parameters."""
    suffixes = sorted({m[2] for c in df.columns for f in fields if (m := re.match(rf"({f})_(h\d+m\d+d\d+)$", c))})
    parts = []
    for s in suffixes:
        spec = parse_suffix(s)
        parts.append(F.struct(F.lit(s).alias("suffix"), *[F.lit(v).cast("double").alias(k) for k, v in spec.items()], *[(F.col(f"{f}_{s}") if f"{f}_{s}" in df.columns else F.lit(None)).cast("string" if f == "exit_type" else "double").alias(f) for f in fields]))
    return df.select(*keys, F.explode(F.array(*parts)).alias("_x")).select(*keys, "_x.*")


def join_targets(signals: DataFrame, targets: DataFrame) -> DataFrame:
    """On sample_id where both have it, else on (trade_date, ts_code)."""
    key = ["sample_id"] if "sample_id" in signals.columns and "sample_id" in targets.columns else ["trade_date", "ts_code"]
    return signals.join(targets.drop(*[c for c in targets.columns if c in signals.columns and c not in key]), key, "left")


def failure_overlap(picks: DataFrame, family: str, date: str, entity: str, target: str) -> DataFrame:
    """For each pair of families: days with any and with only failures, shared ones, and failures in the same entity.

    The picks are evaluated once; lists hold the families of a day or of an entity's day, never rows.
    """
    bad = F.col(target) == 0
    flags = [F.bool_or("any").alias("any"), F.bool_and("all").alias("all")]

    def pairs(fams: Column, of) -> Column:
        return F.flatten(F.transform(fams, lambda x: F.transform(F.filter(fams, lambda y: x["family"] < y["family"]), lambda y: of(x, y))))

    def row(left, right, any_, all_, same: int) -> Column:
        return F.struct(left.alias("left"), right.alias("right"), any_.alias("any"), all_.alias("all"), F.lit(same).alias("same"))

    none, text = F.lit(None).cast("boolean"), F.lit(None).cast(picks.schema[family].dataType)
    own = picks.groupBy(date, entity, F.col(family).alias("family")).agg(F.bool_or(bad).alias("any"), F.bool_and(bad).alias("all"))
    fams = own.groupBy(date, entity).agg(F.collect_list(F.struct("family", "any", "all")).alias("f"))
    failed = F.filter("f", lambda x: x["any"])
    entries = F.concat(F.transform("f", lambda x: row(x["family"], text, x["any"], x["all"], 0)), pairs(failed, lambda x, y: row(x["family"], y["family"], none, none, 1)))
    day = fams.select(date, F.inline(entries)).groupBy(date, "left", "right").agg(*flags, F.sum("same").alias("same"))
    day = day.groupBy(date).agg(F.collect_list(F.when(F.col("right").isNull(), F.struct(F.col("left").alias("family"), "any", "all"))).alias("f"), F.collect_list(F.when(F.col("right").isNotNull(), F.struct("left", "right", "same"))).alias("s"))
    each = F.concat(
        F.transform("f", lambda x: F.struct(x["family"].alias("left"), text.alias("right"), F.coalesce(x["any"], F.lit(False)).cast("int").alias("a"), F.lit(0).alias("b"), F.lit(0).cast("long").alias("same"), F.lit(0).alias("met"))),
        pairs(F.col("f"), lambda x, y: F.struct(x["family"].alias("left"), y["family"].alias("right"), F.coalesce(x["any"] & y["any"], F.lit(False)).cast("int").alias("a"), F.coalesce(x["all"] & y["all"], F.lit(False)).cast("int").alias("b"), F.lit(0).cast("long").alias("same"), F.lit(1).alias("met"))),
        F.transform("s", lambda x: F.struct(x["left"].alias("left"), x["right"].alias("right"), F.lit(0).alias("a"), F.lit(0).alias("b"), x["same"].alias("same"), F.lit(0).alias("met"))),
    )
    total = day.select(F.inline(each)).groupBy("left", "right").agg(*[F.sum(c).alias(c) for c in ("a", "b", "same", "met")])
    days = F.map_from_entries(F.collect_list(F.when(F.col("right").isNull() & F.col("left").isNotNull(), F.struct("left", "a"))))
    both = F.collect_list(F.when(F.col("met") > 0, F.struct("left", "right", F.col("a").alias("shared_any_days"), F.col("b").alias("shared_all_days"), F.col("same").alias("same_entity"))))
    out = total.agg(days.alias("_d"), both.alias("_p")).select("_d", F.inline("_p"))  # a row a pair of families
    out = out.withColumns({f"{side}_any_days": F.element_at("_d", F.col(side)) for side in ("left", "right")})
    ratio = lambda c: F.when(F.col(c) > 0, F.col("shared_any_days") / F.col(c)).otherwise(0.0)
    return out.select("left", "right", "left_any_days", "right_any_days", "shared_any_days", ratio("left_any_days").alias("over_left"), ratio("right_any_days").alias("over_right"), "shared_all_days", "same_entity")


def funnel(df: DataFrame, date: str, stages: dict[str, Column], firsts: tuple[str, ...], *order) -> DataFrame:
    """Per date: rows, how many pass each stage (missing: not), and the first row's value of date-wide columns."""
    first = [F.min_by(F.struct(F.col(c)), F.struct(*order))[c].alias(c) for c in firsts]
    return df.groupBy(date).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in stages.items()], *first)


def quality_guard(r: str, share: float = 0.99, most: float = 0.5) -> Column:
    """Fails when the given share of absolute returns lies above ``most`` (percent taken for decimals)."""
    q = F.percentile(F.abs(F.col(r)), share)
    return F.when(q > most, F.raise_error(F.lit("returns look like percent")).cast("double")).otherwise(q)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
