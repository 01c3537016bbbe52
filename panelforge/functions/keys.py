"""Dates, entity codes, buckets and table contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_trade_date(c) -> Column:
    """``20260717``, ``20260717.0``, ``2026-07-17``, ``2026/07/17`` (and longer) to a date; else NULL."""
    digits = F.substring(F.regexp_replace(F.trim(_c(c).cast("string")), r"[-/]|\.0$", ""), 1, 8)
    return F.when(digits.rlike(r"^\d{8}$"), F.try_to_date(digits, "yyyyMMdd"))


def normalize_code(c, panel: bool = False) -> Column:
    """Bare six-digit codes get their exchange: 6 and 9 (with ``panel`` also 5) ``.SH``, others ``.SZ``; ``panel`` pads with zeros."""
    code = F.upper(F.trim(_c(c).cast("string")))
    if panel:
        code = F.when(code.rlike(r"^\d{1,6}$"), F.lpad(code, 6, "0")).otherwise(code)
    return F.when(code.rlike(r"^\d{6}$"), F.concat(code, F.when(code.rlike("^[569]" if panel else "^[69]"), ".SH").otherwise(".SZ"))).otherwise(code)


def bucket_id(c, span: int = 5) -> Column:
    """Bucket of an entity: its last two digits / span."""
    digits = F.regexp_extract(_c(c).cast("string"), r"(\d{2})\D*$", 1)
    return F.floor(digits.try_cast("int") / span).cast("int")


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def ensure_columns(df: DataFrame, **kinds: str) -> DataFrame:
    """Adds absent columns as typed NULLs."""
    return df.withColumns({n: F.lit(None).cast(k) for n, k in kinds.items() if n not in df.columns})


def existing(df: DataFrame, preferred: list[str], prefixes: tuple[str, ...] = ()) -> list[str]:
    """Preferred columns that exist, in that order, then those with one of the prefixes."""
    out = [c for c in preferred if c in df.columns]
    return out + [c for c in df.columns if c not in out and prefixes and c.startswith(prefixes)]


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Fails when the plan runs over a repeated key; no job of its own."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ok = counts.where(F.when(F.col("_n") > 1, F.raise_error(F.lit(f"duplicate key {keys}"))).otherwise(F.lit(True)).cast("boolean"))
    return df.join(ok.drop("_n"), list(keys), "left_semi")


def inclusive_range(df: DataFrame, date, start=None, end=None) -> DataFrame:
    """Rows from start to end, either of which may be missing; a plain comparison, so it reaches the scan."""
    if start is not None:
        df = df.where(_c(date) >= F.lit(start))
    if end is not None:
        df = df.where(_c(date) <= F.lit(end))
    return df


def usable(flag, missing_is_valid: bool) -> Column:
    """A validity flag (0 good); a missing one counts as good or bad by the caller's rule."""
    return F.coalesce(_c(flag), F.lit(0 if missing_is_valid else 1)) == 0


def min_history(df: DataFrame, entity: str, need: int = 80, *required: str) -> DataFrame:
    """Rows whose required columns are there, of entities with at least ``need`` such rows."""
    from pyspark.sql import Window

    rows = df.dropna(subset=list(required)) if required else df
    return rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(entity))).where(F.col("_n") >= need).drop("_n")


def denylist(df: DataFrame, denied: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not on the list; a missing key stays."""
    return df.join(denied.select(key).distinct(), key, "left_anti")


def stale_entries(df: DataFrame, denied: DataFrame, key: str) -> DataFrame:
    """Entries of a list that no row of the table has."""
    return denied.select(key).distinct().join(df.select(key).distinct(), key, "left_anti")


def compact_types(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Doubles to floats and whole numbers to the smallest type that holds their range (one aggregate)."""
    whole = [f.name for f in df.schema if f.dataType.typeName() in ("long", "integer", "short") and f.name not in keep]
    casts = {f.name: F.col(f.name).cast("float") for f in df.schema if f.dataType.typeName() == "double" and f.name not in keep}
    if whole:
        r = df.agg(*[F.min(c).alias(f"a{i}") for i, c in enumerate(whole)], *[F.max(c).alias(f"z{i}") for i, c in enumerate(whole)]).first()
        for i, c in enumerate(whole):
            low, high = r[f"a{i}"] or 0, r[f"z{i}"] or 0
            kind = next((k for k, b in (("byte", 7), ("short", 15), ("int", 31)) if -(1 << b) <= low and high < 1 << b), "long")
            casts[c] = F.col(c).cast(kind)
    return df.withColumns(casts)
