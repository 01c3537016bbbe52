"""Golomb coding (power-of-two divisor) of sorted distinct 64-bit values, vectorised.

A list is ``count, shift, first value`` and then the gaps: all quotients in
unary as one bit stream, all ``shift``-bit remainders as another, so that both
directions are array operations.  A list of n values spread over a range R
costs about ``log2(R / n) + 1.6`` bits a value.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<IBQI")


def encode(values: np.ndarray) -> bytes:
    """``values``: sorted, distinct, uint64."""
    n = len(values)
    if n == 0:
        return _HEAD.pack(0, 0, 0, 0)
    gaps = values[1:] - values[:-1] - np.uint64(1)
    mean = float(gaps.astype(np.float64).mean()) if n > 1 else 0.0
    shift = max(0, int(np.log2(mean * 0.69 + 1)))
    quotients = (gaps >> np.uint64(shift)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n - 1, dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    packed = np.packbits(unary).tobytes()
    rest = gaps & np.uint64((1 << shift) - 1)
    bits = ((rest[:, None] >> np.arange(shift - 1, -1, -1, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8) if shift else np.zeros((0, 0), np.uint8)
    return _HEAD.pack(n, shift, int(values[0]), len(packed)) + packed + np.packbits(bits.ravel()).tobytes()


def decode(blob: bytes) -> np.ndarray:
    n, shift, first, length = _HEAD.unpack_from(blob)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    raw = np.frombuffer(blob, dtype=np.uint8, offset=_HEAD.size)
    ends = np.flatnonzero(np.unpackbits(raw[:length]))[: n - 1]
    gaps = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)
    gaps <<= np.uint64(shift)
    if shift:
        bits = np.unpackbits(raw[length:])[: (n - 1) * shift].reshape(n - 1, shift)
        for k in range(shift):
            gaps |= bits[:, k].astype(np.uint64) << np.uint64(shift - 1 - k)
    out = np.empty(n, dtype=np.uint64)
    out[0] = first
    out[1:] = np.uint64(first) + np.cumsum(gaps + np.uint64(1))
    return out
