"""Scans: layouts, typed text, fallbacks and arbitration.

Paths go to Spark's readers only, so any store that Spark can read will do.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from panelforge.functions.keys import inclusive_range, normalize_code, parse_trade_date, require_columns
from panelforge.functions.nulls import to_number

NULL_LITERALS = ("", "NA", "N/A", "nan", "None")
ENCODINGS = ("utf-8-sig", "gb18030", "gbk", "utf-8")


class SourceAdapter(Protocol):
    """What a vendor feed has to offer; the engine itself does no network access."""

    def fetch(self, spark: SparkSession, entities: list[str] | None, start, end) -> DataFrame: ...


def scan(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet with projection; a missing column is an error."""
    df = spark.read.parquet(path)
    return require_columns(df, *columns).select(*columns) if columns else df


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A missing or empty source is an empty keyed frame, never an error; other faults of a source are errors."""
    return first_source(spark, [path], schema)


def latest(df: DataFrame, date: str, at=None) -> DataFrame:
    """Rows of the given or the last date; the date is compared as it is stored, so it prunes."""
    day = at if at is not None else df.agg(F.max(date)).first()[0]
    return df.where(F.col(date) == F.lit(day))


def scan_range(df: DataFrame, date: str, start=None, end=None) -> DataFrame:
    return inclusive_range(df, date, start, end)


def detect_encoding(spark: SparkSession, path: str, head: int = 1 << 16) -> str:
    """The first of ENCODINGS that decodes the head of the file (of the first, if a folder)."""
    raw = bytes(spark.read.format("binaryFile").load(path).select(F.substring("content", 1, head)).first()[0])
    for name in ENCODINGS:
        try:
            raw[: len(raw) - 4 if len(raw) == head else None].decode(name)
            return "utf-8" if name == "utf-8-sig" else name
        except UnicodeDecodeError:
            continue
    return "utf-8"


def read_csv_any(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """CSV with a header, all text; the encoding is probed and a byte-order mark dropped from the first name."""
    encoding = encoding or detect_encoding(spark, path)
    if not encoding.lower().startswith("utf"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # else Spark reads a few charsets only
    df = spark.read.option("header", True).option("encoding", encoding).csv(path)
    return df.withColumnsRenamed({c: c.replace("﻿", "").strip() for c in df.columns})


def typed_csv(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Keys stay text; the literals for missing become NULL, everything else a number where it parses."""
    columns = columns or [c for c in df.columns if c not in keys]

    def clean(c: str) -> Column:
        return F.when(~F.trim(F.col(c)).isin(*NULL_LITERALS), F.trim(F.col(c)))

    return df.select(*[clean(k).alias(k) for k in keys], *[(to_number(clean(c)) if c in df.columns else F.lit(None).cast("double")).alias(c) for c in columns])


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """CSV or parquet by suffix."""
    return read_csv_any(spark, path) if path.rstrip("/").lower().endswith((".csv", ".txt")) else spark.read.parquet(path)


def entity_files(spark: SparkSession, pattern: str, name: str = r"([0-9]{6}(?:\.[A-Z]{2})?)", code: str = "ts_code") -> DataFrame:
    """One-file-per-entity inputs, read at once, the entity taken from the file name."""
    df = spark.read.parquet(pattern) if pattern.endswith((".parquet", "*")) else read_csv_any(spark, pattern, "utf-8")
    return df.withColumn(code, normalize_code(F.regexp_extract(F.col("_metadata.file_name"), name, 1)))


def dated_files(df: DataFrame, start=None, end=None, pattern: str = r"(\d{8})") -> DataFrame:
    """Keeps the files whose name holds a date in the range; adds file_date."""
    out = df.withColumn("file_date", parse_trade_date(F.regexp_extract(F.col("_metadata.file_name"), pattern, 1)))
    return inclusive_range(out.where(F.col("file_date").isNotNull()), "file_date", start, end)


def day_partitions(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """A folder partitioned by trade_date; the range prunes folders."""
    return inclusive_range(spark.read.parquet(path), "trade_date", start, end)


def bucketed(spark: SparkSession, path: str, codes: list[str] | None = None) -> DataFrame:
    """A folder partitioned by bucket_id; the codes asked for prune buckets."""
    df = spark.read.parquet(path)
    if codes is None:
        return df
    ids = sorted({int(c[4:6]) // 5 for c in codes})
    return df.where(F.col("bucket_id").isin(ids) & F.col("ts_code").isin(codes))


def first_source(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    """The first layout that exists, in order of priority."""
    for p in paths:
        try:
            return spark.read.parquet(p)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return empty(spark, schema)


def universe(df: DataFrame, code: str, subset: list[str] | None = None, most: int | None = None) -> DataFrame:
    """Distinct trimmed codes in order; optionally a subset, or the first ``most``."""
    out = df.select(F.trim(F.col(code).cast("string")).alias("code")).where(F.col("code") != "").distinct()
    if subset is not None:
        out = out.where(F.col("code").isin(subset))
    out = out.orderBy("code")
    return out.limit(most) if most else out


def choose_source(candidates: DataFrame, entity: str, source: str, date: str, preferred: list[str]) -> DataFrame:
    """Per entity, all rows of one source: newest last date, then order of preference, then most rows."""
    stats = candidates.groupBy(entity, source).agg(F.max(date).alias("_last"), F.count(F.lit(1)).alias("_n"))
    place = F.coalesce(F.array_position(F.array(*[F.lit(p) for p in preferred]), F.col(source)).cast("int"), F.lit(0))
    place = F.when(place == 0, len(preferred) + 1).otherwise(place)
    w = Window.partitionBy(entity).orderBy(F.desc("_last"), place, F.desc("_n"), source)
    best = stats.withColumn("_k", F.row_number().over(w)).where("_k = 1").select(entity, source)
    return candidates.join(best, [entity, source], "left_semi")


def normalize_headers(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Synonyms to canonical names; the first alias that exists counts."""
    names = {}
    for canonical, options in aliases.items():
        if canonical not in df.columns:
            found = next((o for o in options if o in df.columns), None)
            if found:
                names[found] = canonical
    return df.withColumnsRenamed(names)


def backfill_price_columns(df: DataFrame, entity: str, date: str) -> DataFrame:
    """Fills pre_close, change, pct_chg and swing from prices where they are missing."""
    w = Window.partitionBy(entity).orderBy(date)
    out = df.withColumns({c: F.lit(None).cast("double") for c in ("pre_close", "change", "pct_chg", "swing") if c not in df.columns})
    out = out.withColumn("pre_close", F.coalesce("pre_close", F.lag("close").over(w)))
    out = out.withColumn("change", F.coalesce("change", F.col("close") - F.col("pre_close")))
    pre = F.when(F.col("pre_close") != 0, F.col("pre_close"))
    return out.withColumns({"pct_chg": F.coalesce("pct_chg", F.col("change") / pre * 100), "swing": F.coalesce("swing", (F.col("high") - F.col("low")) / pre * 100)})


def scale(df: DataFrame, factors: dict[str, float]) -> DataFrame:
    """Multiplies the columns that exist; text that is no number becomes NULL."""
    return df.withColumns({c: to_number(F.col(c)) * k for c, k in factors.items() if c in df.columns})
