"""A training-corpus pipeline of five of the text operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller writes
it as Parquet and hands it, read again, to the next one.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import decontam, jaccard, mixing, sharding, toxicity
from panelforge.llm._spark import remove, shared_dir, table

SHARDS = 24


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, trained on the labelled ones among them, doesn't reject; null and empty texts stay."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, Jaccard 0.8 or more; the smallest id stays (null counts as largest), of its equal rows one; texts without words all stay."""
    return jaccard.keep_one(docs, n=5, num=80, den=100)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with the benchmark; null and empty texts stay."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as the target weights of its source have it; a null source is the source ""."""
    return mixing.mix_sources(docs, [F.col(f"`{c}`") for c in docs.columns]).select("row.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; copies of one text share a shard, null texts too; slots of a shard follow id and text."""
    return sharding.shard_texts(docs, SHARDS)


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The trained first stage can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; a stage's input goes when its output is written."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    last = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        if last:
            remove(spark, f"{base}/{last}")
        last, docs = name, spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
