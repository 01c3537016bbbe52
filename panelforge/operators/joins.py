"""Left joins of keyed sources, calendar alignment and interval joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes below which a table that the caller calls small is broadcast.
SMALL_BYTES = 32 << 20


def small(df: DataFrame, rows: int, row_bytes: int = 200) -> DataFrame:
    """A broadcast hint, only if ``rows`` (known to the caller) fit; else the join stays the optimizer's choice."""
    return F.broadcast(df) if rows * row_bytes <= SMALL_BYTES else df


def star_join(base: DataFrame, sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Left-joins each source on the keys; of a column that several have the first source wins."""

    def add(left: DataFrame, right: DataFrame) -> DataFrame:
        new = [c for c in right.columns if c not in left.columns]
        return left.join(right.select(*keys, *new), keys, "left") if new else left

    return reduce(add, sources, base)


def renamed_join(base: DataFrame, source: DataFrame, keys: list[str], suffix: str, columns: list[str] | None = None, only_clashes: bool = False) -> DataFrame:
    """Left join whose value columns (or only those that clash) get a suffix."""
    values = [c for c in source.columns if c not in keys and (columns is None or c in columns)]
    names = {c: f"{c}{suffix}" if not only_clashes or c in base.columns else c for c in values}
    return base.join(source.select(*keys, *[F.col(c).alias(n) for c, n in names.items()]), keys, "left")


def patch_join(base: DataFrame, source: DataFrame, keys: list[str], until: str | None = None, entity: str | None = None) -> DataFrame:
    """Replaces the columns that the source owns: old values go, also outside the source's dates.

    ``until`` names the date column to cut at the common end date: the least, over the
    source's entities, of their last dates.
    """
    owned = [c for c in source.columns if c not in keys]
    out = base.drop(*owned).join(source, keys, "left")
    if until:
        ends = source.groupBy(entity).agg(F.max(until).alias("_end")).agg(F.min("_end").alias("_end"))
        out = out.join(F.broadcast(ends)).where(F.col(until) <= F.col("_end")).drop("_end")  # one row
    return out.select(*base.columns, *[c for c in owned if c not in base.columns])


def interval_join(df: DataFrame, mapping: DataFrame, entity: str, date: str, start: str, end: str, seq: str) -> DataFrame:
    """The mapping row whose [start, end] holds the date; of several the last in ``seq`` order; none: nulls.

    Joined on the entity, with the interval as a condition; the pick is made on (entity, date) only.
    """
    values = [c for c in mapping.columns if c not in (entity, start, end, seq)]
    days = df.select(entity, date).distinct()
    m = mapping.select(F.col(entity).alias("_e"), *[c for c in mapping.columns if c != entity])
    hit = days.join(m, (F.col(entity) == F.col("_e")) & (F.col(date) >= F.col(start)) & (F.col(date) <= F.col(end)))
    best = hit.groupBy(entity, date).agg(F.max_by(F.struct(*values), seq).alias("_v")).select(entity, date, "_v.*")
    return df.join(best, [entity, date], "left")


def shift_align(calendar: DataFrame, series: DataFrame, date: str, columns: list[str], lag_rows: int = 0, start=None, keep_early: bool = False) -> DataFrame:
    """A foreign series on the local calendar: shifted by rows, joined on equal dates, filled forward.

    A value dated on a local holiday is dropped, not carried.  Dates before the series begins
    go, or stay as nulls with ``keep_early``.  Both inputs have one row a date.
    """
    w = Window.orderBy(date)
    shifted = series.select(date, *[F.lag(c, lag_rows).over(w).alias(c) if lag_rows else F.col(c) for c in columns])
    first = series.agg(F.min(date).alias("_first"))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    out = calendar.select(date).distinct().join(shifted, date, "left").select(date, *[F.last(c, ignorenulls=True).over(run).alias(c) for c in columns])
    out = out.join(F.broadcast(first))  # one row
    if keep_early:
        return out.select(date, *[F.when(F.col(date) >= F.col("_first"), F.col(c)).alias(c) for c in columns])
    begin = F.col("_first") if start is None else F.greatest(F.col("_first"), F.lit(start))
    return out.where(F.col(date) >= begin).drop("_first")


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, columns: list[str]) -> DataFrame:
    """Extension: the last right row at or before each left row, by one union, sort and forward fill."""
    l = left.select(*[F.col(c) for c in left.columns], F.lit(1).alias("_side"), *[F.lit(None).cast(right.schema[c].dataType).alias(f"_{c}") for c in columns])
    r = right.select(*[F.col(c) if c in by + [on] else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns], F.lit(0).alias("_side"), *[F.col(c).alias(f"_{c}") for c in columns])
    w = Window.partitionBy(*by).orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = l.unionByName(r).select(*left.columns, "_side", *[F.last(F.when(F.col("_side") == 0, F.struct(f"_{c}")), ignorenulls=True).over(w)[f"_{c}"].alias(c) for c in columns])
    return out.where("_side = 1").drop("_side")


def calendar_positions(dates: DataFrame, date: str) -> DataFrame:
    """date, pos (0, 1, 2, ... in date order); one row a date."""
    return dates.select(date).distinct().select(date, (F.row_number().over(Window.orderBy(date)) - 1).alias("pos"))


def nth_before(calendar: DataFrame, date: str, n: int) -> DataFrame:
    """Each date with the trading date ``n`` positions earlier."""
    return calendar.select(date, F.lag(date, n).over(Window.orderBy("pos")).alias("earlier"))
