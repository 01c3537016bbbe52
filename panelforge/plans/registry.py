"""Queries and their SQL twins, registered by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, *ctes: str):
    """Registers a function under its name; ``ctes`` are shared WITH parts put before ``sql``."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = (f"WITH {', '.join(ctes)} " if ctes else "") + sql
        return f

    return add


def load(spark: SparkSession, sf_dir: str, *names: str):
    frames = [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return frames[0] if len(frames) == 1 else frames
