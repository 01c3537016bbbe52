"""Dedup, unions and keyed updates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """One row of each key: the last in the given order, which should be unique."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(o) if isinstance(o, str) else o for o in order])
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def keep_first(df: DataFrame, keys: list[str], *order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """Union by name: absent columns are null, numbers widen."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], *order) -> DataFrame:
    """Rows of ``new`` replace those with the same key; in ``new`` the last in ``order`` counts."""
    latest = keep_last(new, keys, *order) if order else new
    return union_relaxed(old.join(latest.select(*keys), keys, "left_anti"), latest)


def differs(a: Column, b: Column, numeric: bool, rel: float = 1e-10, abs_: float = 1e-8) -> Column:
    """Null-safe inequality, with a tolerance for numbers."""
    if not numeric:
        return ~a.eqNullSafe(b)
    near = F.abs(a - b) <= F.greatest(F.greatest(F.abs(a), F.abs(b)) * rel, F.lit(abs_))
    return ~F.coalesce(near, a.isNull() & b.isNull())


def change_counts(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row: keys of ``new`` that are new, changed, or the same."""
    values = [c for c in new.columns if c not in keys and c in old.columns]
    numeric = {f.name for f in new.schema if f.dataType.typeName() in ("double", "float", "long", "integer", "short", "byte")}
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in values], F.lit(True).alias("_old"))
    j = new.join(o, keys, "left")
    changed = reduce(lambda x, y: x | y, [differs(F.col(c), F.col(f"_o_{c}"), c in numeric) for c in values], F.lit(False))
    return j.agg(F.count_if(F.col("_old").isNull()).alias("n_new"), F.count_if(F.col("_old").isNotNull() & changed).alias("n_changed"), F.count_if(F.col("_old").isNotNull() & ~changed).alias("n_same"))


def partial_upsert(old: DataFrame, src: DataFrame, keys: list[str], owned: list[str]) -> DataFrame:
    """Updates only the owned columns of known keys, and appends unknown keys."""
    s = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in owned], F.lit(True).alias("_src"))
    j = old.join(s, keys, "full")
    return j.select(*[F.when(F.col("_src"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in owned else F.col(c) for c in old.columns])


def replace_where(old: DataFrame, new: DataFrame, entity: str, date: str, start, end) -> DataFrame:
    """Deletes the window's rows of entities that ``new`` has, then appends ``new``."""
    inside = F.col(date).between(F.lit(start), F.lit(end))
    fresh = new.select(F.col(entity)).distinct().withColumn("_fresh", F.lit(True))
    kept = old.join(fresh, entity, "left").where(~inside | F.col("_fresh").isNull()).drop("_fresh")
    return union_relaxed(kept, new.where(inside))


def prune_absent(old: DataFrame, new: DataFrame, entity: str, date: str, start, end) -> DataFrame:
    """Drops the window's rows of entities that the new load no longer has."""
    seen = new.select(entity).distinct().withColumn("_seen", F.lit(True))
    inside = F.col(date).between(F.lit(start), F.lit(end))
    return old.join(seen, entity, "left").where(~inside | F.col("_seen").isNotNull()).drop("_seen")


def merge_overlap(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row: keys in both, only in old, only in new."""
    o, n = old.select(*keys).distinct().withColumn("_o", F.lit(1)), new.select(*keys).distinct().withColumn("_n", F.lit(1))
    j = o.join(n, keys, "full")
    return j.agg(F.count_if(F.col("_o").isNotNull() & F.col("_n").isNotNull()).alias("n_overlap"), F.count_if(F.col("_n").isNull()).alias("n_old_only"), F.count_if(F.col("_o").isNull()).alias("n_new_only"))


def covers_window(df: DataFrame, entity: str, date: str, start, end, least_rows: int) -> DataFrame:
    """Per entity: does it have ``least_rows`` rows in the window and one on its end date?"""
    inside = df.where(F.col(date).between(F.lit(start), F.lit(end)))
    return inside.groupBy(entity).agg(F.count(F.lit(1)).alias("n_rows"), F.max(date).alias("last_date")).withColumn("covered", (F.col("n_rows") >= least_rows) & (F.col("last_date") == F.lit(end)))
