"""A Bloom filter of 64-bit values, made on the workers and sent to all of them; its size has a bound."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _words as wd
from ._spark import trimmed

#: Bits of a filter, at most (32 MB).  A fuller filter lets more values through; it never loses one.
FILTER_BITS = 1 << 28


def _cells(values: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(wd.mix64(values ^ np.uint64(0x94D049BB133111EB + r)) & np.uint64(bits - 1)).astype(np.int64) for r in range(2)]


def bloom(values: DataFrame, n: int, each: int = 16, most: int = FILTER_BITS) -> Broadcast:
    """``values``: one long column, ``n`` rows; ``each`` bits a row, ``most`` in all.  The caller destroys the broadcast."""
    size = min(max(1 << math.ceil(math.log2(each * n + 1)), 1 << 10), most)

    @trimmed
    def filled(batches):
        for b in batches:
            cells = np.unique(np.concatenate(_cells(np.asarray(b.column(0)).view(np.uint64), size)))
            word, first = np.unique(cells >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (cells & 63).astype(np.uint64), first) if len(cells) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

    words = values.mapInArrow(filled, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # most / 64 rows
    out = np.zeros(max(size >> 6, 1), np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return values.sparkSession.sparkContext.broadcast(out.view(np.uint8))


def may_hold(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Flags of the values that the filter may hold."""
    ok = np.ones(len(values), bool)
    for c in _cells(values, len(bits) << 3):
        ok &= ((bits[c >> 3] >> (c & 7).astype(np.uint8)) & 1).astype(bool)
    return ok
