"""The session that the engine is meant to run in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "panelforge", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution; keyword arguments (dots as ``__``) override settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()
