"""Sinks and reports.

Folders are the unit of a write; Spark's commit protocol makes each one atomic.
"""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.functions.keys import bucket_id

def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all machines share; in local mode without one, a temporary folder."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        at = tempfile.mkdtemp(prefix="panelforge-")
        atexit.register(shutil.rmtree, at, True)
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


CODECS = ("zstd", "snappy", "lz4", "none")


def write_parquet(df: DataFrame, path: str, codec: str = "zstd", mode: str = "overwrite") -> None:
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}")
    df.write.mode(mode).option("compression", codec).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)


def write_by_date(df: DataFrame, path: str, date: str = "trade_date", codec: str = "zstd") -> None:
    """Folders by date; only the dates that occur are replaced.  One task writes a date's files, more if AQE splits it."""
    out = df.hint("rebalance", F.col(date))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec).partitionBy(date).parquet(path)


def write_buckets(df: DataFrame, path: str, code: str = "ts_code", order: tuple[str, ...] = ("ts_code", "trade_time"), span: int = 5, codec: str = "zstd") -> None:
    """Folders by bucket of the code, sorted inside."""
    out = df.withColumn("bucket_id", bucket_id(F.regexp_extract(F.col(code), r"^(\d+)", 1), span))
    out.repartition("bucket_id", code).sortWithinPartitions("bucket_id", *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec).partitionBy("bucket_id").parquet(path)


def row_index(df: DataFrame, date: str, key: str, name: str = "sample_id") -> DataFrame:
    """0, 1, 2, ... in (date, key) order: numbers inside each date, moved up by the dates before.

    Only the per-date counts go through a window without partition.
    """
    counts = df.groupBy(date).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(date, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(date).orderBy(key)) - 1
    return df.join(offsets, date).withColumn(name, within + F.col("_before")).drop("_before")


def write_signals(df: DataFrame, path: str, date: str, counters: dict) -> None:
    """Signals as CSV by date, the last date again under ``latest``, and one JSON context row a date."""
    df.write.mode("overwrite").parquet(f"{path}/signals")  # one evaluation; the rest reads it
    df = df.sparkSession.read.schema(df.schema).parquet(f"{path}/signals")
    df.withColumn("_d", F.date_format(date, "yyyyMMdd")).write.mode("overwrite").option("header", True).partitionBy("_d").csv(f"{path}/by_date")
    last = df.agg(F.max(date).alias("_last"))
    df.join(F.broadcast(last)).where(F.col(date) == F.col("_last")).drop("_last").write.mode("overwrite").option("header", True).csv(f"{path}/latest")  # one row
    context(df, date, counters).write.mode("overwrite").json(f"{path}/context")


def context(df: DataFrame, date: str, counters: dict) -> DataFrame:
    """Per date: rows, and how many meet each named condition (missing counts as not)."""
    return df.groupBy(date).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in counters.items()])


def coverage(df: DataFrame, entity: str, date: str, error: str | None = None) -> DataFrame:
    """Per entity: rows, first and last date, distinct dates, status and the first error text."""
    out = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n_rows"), F.min(date).alias("date_min"), F.max(date).alias("date_max"), F.count_distinct(date).alias("n_dates"), *([F.min(error).alias("error")] if error else []))
    return out.withColumn("status", F.when(F.col("error").isNotNull(), "error").otherwise("ok") if error else F.lit("ok"))


def feature_dictionary(df: DataFrame, keys: tuple[str, ...] = (), categorical: tuple[str, ...] = (), prefixes: tuple[str, ...] = ("target", "ret_raw_", "ret_adj_")) -> DataFrame:
    """Column, type and role: key, categorical, non_feature or numeric."""

    def role(f) -> str:
        if f.name in keys:
            return "key"
        if f.name.startswith(prefixes):
            return "non_feature"
        return "categorical" if f.name in categorical or f.dataType.typeName() in ("string", "boolean") else "numeric"

    return df.sparkSession.createDataFrame([(i, f.name, f.dataType.simpleString(), role(f)) for i, f in enumerate(df.schema)], "position int, column string, type string, role string")


def write_run_summary(df: DataFrame, path: str, **facts) -> None:
    """One JSON line of facts about a run."""
    df.sparkSession.createDataFrame([(json.dumps(facts, default=str, sort_keys=True),)], "value string").write.mode("overwrite").text(path)
