"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (here: equal texts) enter, largest first, the bin with the tightest
remaining capacity that still holds them; a balanced tree keyed by remaining
capacity finds it.  With a fixed capacity that keeps the number of shards
small; with a fixed number of shards the smallest capacity that best-fit
decreasing can meet is found by bisection, which makes sizes near equal.

Scale: the packing itself sees only a histogram of group sizes.  Sizes above
4095 are rounded up to 12 significant bits, so the histogram has at most
2048 * 53 classes whatever the input, and all groups of a class are
interchangeable: "q groups of class c go to bin b" is decided on the driver,
which q of them is decided by a distributed numbering.

Null text is a group of its own of size 0 (+ overhead); an empty table gives an
empty result; repeated rows are rows of their own with slots of their own; groups of one size class are told apart by
their key, bins of one remaining capacity by their number;
other columns of the input are ignored.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import BROADCAST_BYTES, cut, discard, numbered, table

ROW_OVERHEAD = 8
CLASS_BITS = 12


class CapacityTree:
    """A treap of (remaining capacity, bin): insert, delete, and the tightest bin that fits."""

    def __init__(self):
        self._root, self._rng = None, random.Random(7)

    def insert(self, key) -> None:
        low, high = self._cut(self._root, key)
        self._root = self._join(self._join(low, [key, self._rng.random(), None, None]), high)

    def delete(self, key) -> None:
        def go(node):
            if node[0] == key:
                return self._join(node[2], node[3])
            side = 2 if key < node[0] else 3
            node[side] = go(node[side])
            return node

        self._root = go(self._root)

    def tightest(self, size: int):
        node, best = self._root, None
        while node is not None:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best

    def _cut(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._cut(node[3], key)
            return node, high
        low, node[2] = self._cut(node[2], key)
        return low, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] < b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b


def best_fit(classes: list[tuple[int, int]], capacity: int, most_bins: int | None = None) -> list[tuple[int, int, int]] | None:
    """Runs (class, bin, count) of best-fit decreasing; None if over ``most_bins`` are needed.

    ``classes``: (size, count), sizes descending.  A group larger than the capacity gets a bin of its own.
    Equal sizes are placed together: after an insertion the same bin is still the tightest until it is full.
    """
    tree, used, runs = CapacityTree(), 0, []
    for size, count in classes:
        while count:
            found = tree.tightest(size)
            if found is None:
                if most_bins is not None and used >= most_bins:
                    return None
                found = (max(capacity, size), used)
                used += 1
            else:
                tree.delete(found)
            left, b = found
            q = min(count, left // size) if size else count
            runs.append((size, b, q))
            count -= q
            tree.insert((left - q * size, b))
    return runs


def pack(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Runs (class, shard, count) over exactly ``shards`` bins with the smallest capacity that works.

    Groups of at least a fair share of what is left get a shard of their own first.
    """
    classes, runs, first = [list(c) for c in sorted(classes, reverse=True)], [], 0
    total = sum(s * n for s, n in classes)
    while classes and first < shards - 1 and classes[0][0] * (shards - first) >= total > 0:
        size = classes[0][0]
        runs.append((size, first, 1))
        total, first = total - size, first + 1
        classes[0][1] -= 1
        if not classes[0][1]:
            classes.pop(0)
    if not classes:
        return runs
    bins = shards - first
    low = max(classes[0][0], -(-total // bins))
    high = -(-total // bins) + classes[0][0]
    while low < high:
        mid = (low + high) // 2
        if best_fit(classes, mid, bins) is None:
            low = mid + 1
        else:
            high = mid
    return runs + [(s, b + first, q) for s, b, q in best_fit(classes, high, bins)]


def size_class(size):
    """``size`` rounded up to CLASS_BITS significant bits."""
    shift = F.greatest(F.length(F.bin(size)) - CLASS_BITS, F.lit(0))
    unit = F.pow(F.lit(2.0), shift).cast("long")
    return (F.ceil(size / unit) * unit).cast("long")


def stretches(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, lo, hi, first bin, each): ranks from lo up to hi of a class fill bins from the first on, ``each`` in every one.

    Bins that are alike lie next to each other, so a class has few stretches however many bins it fills.
    """
    out: list[list[int]] = []
    at: dict[int, int] = {}
    for s, b, q in runs:
        lo = at.get(s, 0)
        at[s] = lo + q
        if out and out[-1][0] == s and out[-1][4] == q and b == out[-1][3] + (out[-1][2] - out[-1][1]) // q:
            out[-1][2] += q
        else:
            out.append([s, lo, lo + q, b, q])
    return [tuple(x) for x in out]


def pack_groups(groups: DataFrame, key: str, size: str, *, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """key, shard for a cut table of distinct ``key`` with ``size``; give ``shards`` or ``capacity``."""
    spark = groups.sparkSession
    groups = groups.select(F.col(key).alias("key"), size_class(F.col(size)).alias("cls"))
    classes = [(r["cls"], r["count"]) for r in groups.groupBy("cls").count().collect()]  # bounded: see size_class
    runs = pack(classes, shards) if shards else best_fit(sorted(classes, reverse=True), capacity)
    plan = spark.createDataFrame(rows := stretches(runs), "cls long, lo long, hi long, first int, each long")
    plan = F.broadcast(plan) if len(rows) * 32 <= BROADCAST_BYTES else plan
    ranked = numbered(groups, ["cls"], ["key"], ["key"], sum(n for _, n in classes), "rank")
    return ranked.join(plan, "cls").where("rank >= lo AND rank < hi").select(F.col("key").alias(key), F.expr("cast(first + (rank - lo) div each AS int)").alias("shard"))


def shard_texts(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, shard, slot: equal texts share a shard, shard bytes are near equal."""
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.unhex(F.md5(text)), F.lit(b"null")).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
    )
    rows = cut(rows, "sizes")
    groups = cut(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    placed = cut(rows.join(pack_groups(groups, "key", "bytes", shards=shards), "key"), "placed")
    discard(rows, groups)
    out = numbered(placed, ["shard"], ["id", "key"], ["id", "key"], placed.count(), "slot")
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", "slot")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_texts(table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op9_sharding": op9_sharding}
ORACLE: dict = {}
