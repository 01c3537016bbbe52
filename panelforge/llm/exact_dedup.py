"""Exact dedup by a Golomb-coded fingerprint exchange.

1. One scan computes, for every row, the SHA-256 of its normalised text and a
   64-bit fingerprint; these narrow rows are kept in the shared folder.
2. Each partition sorts its distinct fingerprints and sends every owner (a range
   of the fingerprint space) its part as a Golomb-coded list plus a bitmap of
   those that repeat inside the partition.
3. An owner merges its lists and answers each partition with a bitmap of the
   fingerprints that occur more than once anywhere.
4. Partitions turn the bitmaps back into suspect fingerprints; only texts of
   suspects are shuffled, grouped by their bytes and so verified.

A group of copies reaches an owner as at most one entry per partition, and the
verification pre-aggregates by text before its shuffle, so a group that holds a
third of all rows does not gather in one task.

Normal form: A-Z lower-cased, nothing else; null counts as empty.  Of equal
texts the row with the largest id stays; a null id counts as the smallest; of
repeated rows (same id, same text) exactly one stays.  Ids are whole numbers (a text id
fails).  An empty table gives an empty result.  Other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import golomb
from ._spark import cut, discard, fitting, small_batches, table, trimmed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fingerprints for one owner, about, and of one sender: partitions are put together up to it, so that lists stay long.
OWNER_ROWS, SENDER_ROWS = 2_000_000, 4_000_000


def _lists(owners: int):
    @trimmed
    def run(batches):
        from pyspark import TaskContext

        parts = [np.asarray(b.column(0)).view(np.uint64) for b in batches]
        if not parts:
            return
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        bounds = np.searchsorted(values, (np.arange(owners + 1, dtype=np.float64) / owners * 2.0**64)[1:-1].astype(np.uint64))
        edges = [0, *bounds.tolist(), len(values)]
        rows = [(o, golomb.encode(values[a:z]), np.packbits(counts[a:z] > 1).tobytes()) for o, (a, z) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if z > a]
        pid = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([pid] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
            names=["pid", "owner", "list", "twice"],
        )

    return run


def _answers(pdf: pd.DataFrame) -> pd.DataFrame:
    lists = [golomb.decode(x) for x in pdf["list"]]
    twice = [np.unpackbits(np.frombuffer(t, np.uint8))[: len(v)].astype(bool) for t, v in zip(pdf["twice"], lists, strict=True)]
    values, inverse, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    again = counts > 1
    again[inverse[np.concatenate(twice)]] = True
    flags = np.split(again[inverse], np.cumsum([len(v) for v in lists])[:-1])
    out = pd.DataFrame({"pid": pdf["pid"].to_numpy(), "owner": pdf["owner"].to_numpy(), "bitmap": [np.packbits(f).tobytes() for f in flags]})
    return out[[bool(f.any()) for f in flags]]


@trimmed
def _flagged(batches):
    for b in batches:
        found = [v[np.unpackbits(np.frombuffer(m, np.uint8))[: len(v)].astype(bool)] for v, m in ((golomb.decode(x), m) for x, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["fp"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    # lower() also joins texts that differ in other letters' case: more suspects, never fewer
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.lower(text)).alias("fp"), text.alias("text"))
    norm = F.translate("text", UPPER, LOWER)
    marked = cut(rows.select(F.monotonically_increasing_id().alias("rid"), "id", "fp", F.sha2(norm, 256).alias("sha")), "digests")

    n_rows = marked.count()
    owners, senders = max(8, math.ceil(n_rows / OWNER_ROWS)), max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(n_rows / SENDER_ROWS))
    lists = cut(marked.select("fp").coalesce(senders).mapInArrow(_lists(owners), "pid int, owner int, list binary, twice binary"), "lists")
    bitmaps = lists.groupBy("owner").applyInPandas(_answers, "pid int, owner int, bitmap binary")
    suspects = cut(lists.join(bitmaps, ["pid", "owner"]).select("list", "bitmap").mapInArrow(_flagged, "fp long").distinct(), "suspects")
    n = suspects.count()

    same = (
        rows.select("fp", "text").join(fitting(suspects, n, 16), "fp", "left_semi").select("fp", norm.alias("norm"))
        .groupBy("fp", "norm").agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
        .select(F.sha2("norm", 256).alias("sha"), "group_size")
    )
    same = cut(same, "classes")
    discard(lists, suspects)
    keep = marked.join(fitting(same, n, 100), "sha").groupBy("sha").agg(F.max(F.struct("id", "rid")).alias("keep"), F.first("group_size").alias("group_size"))
    found = marked.join(fitting(keep, n, 120), "sha", "left")
    single = F.col("keep").isNull()
    return found.select(
        F.col("id").alias(id_col),
        F.when(single, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("rid") == F.col("keep.rid"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP3_SQL = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

QUERIES = {"op3_exact_dedup": op3_exact_dedup}
ORACLE = {"op3_exact_dedup": OP3_SQL}
