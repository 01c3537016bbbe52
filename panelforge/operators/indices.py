"""Equal- and cap-weighted indices, breadth and levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.nulls import is_true


def returns(df: DataFrame, keep: list[str], pct: str | None = None) -> DataFrame:
    """open/high/low/close returns against pre_close; close prefers ``pct`` / 100.  Rows without all four go."""
    pre = F.when(F.col("pre_close") > 0, F.col("pre_close"))
    ret = {x: F.col(x) / pre - 1 for x in ("open", "high", "low", "close")}
    if pct:
        ret["close"] = F.coalesce(F.col(pct) / 100, ret["close"])
    out = df.select(*keep, *[c.alias(f"{x}_ret") for x, c in ret.items()])
    return out.dropna(subset=[f"{x}_ret" for x in ret])


def equal_weight(df: DataFrame, date: str, flag: str | None = None, limit: float = 0.095, totals: tuple[str, ...] = ()) -> DataFrame:
    """One row a date: mean return of each price, dispersion, breadth shares, limit counts and sums of ``totals``."""
    r = F.col("close_ret")

    def share(condition):
        return F.avg(is_true(condition).cast("double"))

    up = r >= limit if flag is None else (F.col(flag) == "U") | (r >= limit)
    down = r <= -limit if flag is None else (F.col(flag) == "D") | (r <= -limit)
    return df.groupBy(date).agg(
        *[F.avg(f"{x}_ret").alias(f"ew_{x}_ret") for x in ("open", "high", "low", "close")],
        F.median("close_ret").alias("ret_median"),
        F.stddev_samp("close_ret").alias("ret_std"),
        share(r > 0).alias("up_ratio"),
        share(r < 0).alias("down_ratio"),
        share(r > 0.02).alias("gt_2pct_ratio"),
        share(r > 0.03).alias("gt_3pct_ratio"),
        share(r > 0.05).alias("gt_5pct_ratio"),
        share(r < -0.02).alias("lt_minus_2pct_ratio"),
        F.count_if(is_true(up)).alias("limit_up_count"),
        F.count_if(is_true(down)).alias("limit_down_count"),
        F.count(F.lit(1)).alias("valid_count"),
        *[F.sum(x).alias(f"total_{x}") for x in totals],
    )


#: Names of a benchmark's daily return, in order of preference: fixed values.
RETURN_NAMES = ("csi1500_ew", "csi1500_ew_ret", "ret", "return", "daily_return", "pct_chg")


def benchmark_returns(df: DataFrame, date: str, column: str | None = None, close: str = "close", order: str | None = None) -> DataFrame:
    """date, r: the named return column, else the first of RETURN_NAMES, else close / previous close - 1.

    One row a date: of repeated dates the last in ``order`` counts.  Without any of these columns, or
    without the one asked for, it is an error.
    """
    if column is not None and column not in df.columns:
        raise ValueError(f"no return column {column!r}; there are {df.columns}")
    chosen = column or next((c for c in RETURN_NAMES if c in df.columns), None)
    if chosen is None and close not in df.columns:
        raise ValueError(f"no return column; there are {df.columns}")
    tie = F.col(order) if order else F.lit(0)
    if chosen:
        r = F.col(chosen).try_cast("double")
    else:
        p = F.col(close).try_cast("double")
        before = F.lag(p).over(Window.orderBy(date, tie))  # a benchmark has one row a date
        r = F.when(before != 0, p / before - 1)
    out = df.select(F.col(date).alias("date"), r.alias("r"), tie.alias("_o"))
    return out.groupBy("date").agg(F.max_by(F.struct("r"), "_o").alias("_r")).select("date", F.col("_r.r").alias("r"))


def cap_weight(df: DataFrame, date: str, cap: str, key: str, top: int = 10) -> DataFrame:
    """One row a date: cap-weighted mean of each return, largest weight and the sum of the ``top`` largest."""
    day = Window.partitionBy(date)
    w = df.where(F.col(cap) > 0).withColumn("_w", F.col(cap) / F.sum(cap).over(day))
    w = w.withColumn("_k", F.row_number().over(day.orderBy(F.desc("_w"), key)))
    return w.groupBy(date).agg(
        *[F.sum(F.col("_w") * F.col(f"{x}_ret")).alias(f"mcap_{x}_ret") for x in ("open", "high", "low", "close")],
        F.max("_w").alias("max_weight"),
        F.sum(F.when(F.col("_k") <= top, F.col("_w"))).alias("top_weight"),
        F.count(F.lit(1)).alias("cap_count"),
    )


def levels(index: DataFrame, date: str, prefix: str, base: float = 1.0) -> DataFrame:
    """Compounds ``{prefix}_close_ret`` into a level and its open/high/low, kept inside the envelope.

    One row a date: the window without partition runs over dates only, never over entities.
    """
    w = Window.orderBy(date)
    close = F.product(1 + F.coalesce(F.col(f"{prefix}_close_ret"), F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, 0)) * base
    out = index.withColumn(f"{prefix}_close", close).withColumn("_prev", F.coalesce(F.lag(f"{prefix}_close").over(w), F.lit(base)))
    o, h, lo = (F.col("_prev") * (1 + F.col(f"{prefix}_{x}_ret")) for x in ("open", "high", "low"))
    c = F.col(f"{prefix}_close")
    return out.withColumns({f"{prefix}_open": o, f"{prefix}_high": F.greatest(h, o, c), f"{prefix}_low": F.least(lo, o, c)}).drop("_prev")
