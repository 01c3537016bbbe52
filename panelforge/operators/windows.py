"""Time-series operators over one entity's rows in date order.

All take the window of the entity (see ``over``) and return Columns, so any
number of them in one ``select`` share a single exchange and sort.  Frames count
surviving rows, not calendar days; a rolling value needs ``need`` non-null
entries in its frame (by default all of it).
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from panelforge.functions.nulls import EPS, _c, log_nonzero


def over(entity, *order) -> WindowSpec:
    return Window.partitionBy(*([entity] if isinstance(entity, str) else entity)).orderBy(*order)


def rolling(agg, c, w: WindowSpec, n: int, need: int | None = None, end: int = 0) -> Column:
    """``agg`` over the ``n`` rows ending ``end`` rows from the current one."""
    f = w.rowsBetween(end - n + 1, end)
    return F.when(F.count(_c(c)).over(f) >= (n if need is None else need), agg(_c(c)).over(f))


def mean(c, w, n, need=None, end=0) -> Column:
    return rolling(F.avg, c, w, n, need, end)


def std(c, w, n, need=None, end=0) -> Column:
    return rolling(F.stddev_pop, c, w, n, need, end)


def total(c, w, n, need=None, end=0) -> Column:
    return rolling(F.sum, c, w, n, need, end)


def zscore(c, w, n: int) -> Column:
    """(x - mean) / (population std + eps) over the last n rows, today included."""
    return (_c(c) - mean(c, w, n)) / (std(c, w, n) + EPS)


def baseline_z(c, w, n: int) -> Column:
    """As ``zscore``, against the n rows that end yesterday."""
    return (_c(c) - mean(c, w, n, end=-1)) / (std(c, w, n, end=-1) + EPS)


def surprise(c, w, n: int) -> Column:
    return _c(c) - mean(c, w, n, end=-1)


def trend_gap(c, w, short: int, long: int) -> Column:
    """Difference of two means that end yesterday."""
    return mean(c, w, short, end=-1) - mean(c, w, long, end=-1)


def diff(c, w, k: int = 1) -> Column:
    return _c(c) - F.lag(_c(c), k).over(w)


def log_momentum(c, w, k: int) -> Column:
    return log_nonzero(c) - F.lag(log_nonzero(c), k).over(w)


def beta(r, m, w, n: int) -> Column:
    """Sample covariance / (sample variance of m + eps), each over n rows without a gap."""
    f = w.rowsBetween(1 - n, 0)
    both = F.when(_c(r).isNotNull() & _c(m).isNotNull(), 1)
    cov = F.when(F.count(both).over(f) >= n, F.covar_samp(_c(r), _c(m)).over(f))
    return cov / (rolling(F.var_samp, m, w, n) + EPS)


def past_percentile(c, w, n: int) -> Column:
    """Share of the n rows before (nulls ignored) that are <= today; needs n rows before, by position."""
    past = F.collect_list(_c(c)).over(w.rowsBetween(-n, -1))
    at_most = F.size(F.filter(past, lambda h: h <= _c(c)))
    return F.when((F.row_number().over(w) > n) & _c(c).isNotNull() & (F.size(past) > 0), at_most / F.size(past))


def lag_ladder(features: dict[str, tuple[int, ...]], w: WindowSpec) -> list[Column]:
    """``name_lag{k}`` for each feature and step; ask for few, plans get as wide as the ladder."""
    return [F.lag(F.col(c), k).over(w).alias(f"{c}_lag{k}") for c, ks in features.items() for k in ks]


#: Lag steps by kind of feature.
LADDERS = {
    "fast": (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 15, 20),
    "med": (1, 2, 3, 5, 10, 20),
    "slow": (1, 2, 3, 5),
    "shock": (1, 2, 3, 5, 10),
    "3d": (1, 2, 3),
    "trend": (1, 2, 3, 5),
}


def ffill(c, w) -> Column:
    return F.last(_c(c), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def event_days(event: Column, w, n: int) -> Column:
    """Days with the event among the last n rows (fewer at the start)."""
    return F.sum(F.when(event, 1).otherwise(0)).over(w.rowsBetween(1 - n, 0))


def running_product(c, w) -> Column:
    return F.product(_c(c)).over(w.rowsBetween(Window.unboundedPreceding, 0))


def running(agg, c, w) -> Column:
    return agg(_c(c)).over(w.rowsBetween(Window.unboundedPreceding, 0))


def add_days_since(df, name: str, event: Column, w, cap: int = 60):
    """Adds rows since the last event, at most ``cap``; never seen counts as ``cap``."""
    rows = df.withColumn("_rn", F.row_number().over(w))
    last = F.max(F.when(event, F.col("_rn"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(name, F.least(F.coalesce(F.col("_rn") - last, F.lit(cap)), F.lit(cap))).drop("_rn")


def longest_runs(df, keys: list[str], pos: str, flags: dict[str, Column]):
    """Per key and named flag: ``name_length`` and ``name_start``, the longest run of true flags and its first position; the first of equals; 0 and null if none.

    All flags share one exchange and sort; ``rows`` is the number of rows.
    """
    w = Window.partitionBy(*keys).orderBy("_p")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    d = df.select(*keys, F.col(pos).alias("_p"), *[F.coalesce(f, F.lit(False)).alias(f"_f_{k}") for k, f in flags.items()])
    d = d.withColumns({"_i": F.row_number().over(w), **{f"_b_{k}": F.lag(f"_f_{k}", 1, False).over(w) for k in flags}})
    begins = {k: F.when(F.col(f"_f_{k}") & ~F.col(f"_b_{k}"), F.struct("_p", "_i")) for k in flags}
    d = d.withColumns({f"_s_{k}": F.last(c, ignorenulls=True).over(run) for k, c in begins.items()})
    aggs = [F.count(F.lit(1)).alias("rows")]
    for k in flags:
        length = (F.col("_i") - F.col(f"_s_{k}._i") + 1).cast("long")
        longest = F.max_by(F.struct(length.alias("n"), F.col(f"_s_{k}._p").alias("at")), F.when(F.col(f"_f_{k}"), F.struct(length, -F.col("_i"))))
        aggs += [F.coalesce(longest["n"], F.lit(0).cast("long")).alias(f"{k}_length"), longest["at"].alias(f"{k}_start")]
    return d.groupBy(*keys).agg(*aggs)


def compounded_between(df, entity_w, r: str):
    """Adds ``_level`` (running product of 1 + r) and ``_bad`` (rows so far where r is missing or <= -1)."""
    bad = F.when(F.col(r).isNull() | (F.col(r) <= -1), 1).otherwise(0)
    f = entity_w.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_level", F.product(F.when(bad == 0, 1 + F.col(r)).otherwise(1.0)).over(f)).withColumn("_bad", F.sum(bad).over(f))
