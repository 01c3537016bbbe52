"""Connected components on DataFrames by alternating large-star and small-star steps.

Links never leave the executors.  A step joins each node's smallest neighbour
back to its links (an aggregation and an equi-join, so a hub with very many
links is pre-aggregated and its join can be split), and every round is written to
the shared folder.  Stops when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import cut, discard


def _digest(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns u, v (any order, repeats allowed).  Returns node, root (smallest node reachable) for every node with a link to a smaller one."""
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _digest(now)
    while before[0]:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()  # large star
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        old, now = now, cut(small, "links")
        discard(old)
        after = _digest(now)
        if after == before:
            break
        before = after
    out = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out._part = now._part
    return out
