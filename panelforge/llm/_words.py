"""Byte-level tokenising and rolling hashes in numpy, shared by the text operators.

All functions work on the raw UTF-8 buffer of an Arrow string column, so a
batch costs a handful of vector operations and no per-word Python objects.
Every separator of the three word patterns used here is ASCII, and bytes of
multi-byte characters are all above 0x7F, so splitting bytes is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64

_ALL = np.ones(256, dtype=bool)
#: words [^\x20\x09-\x0D]+
NON_SPACE = _ALL.copy()
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x41:0x5B] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 32

#: Words of up to so many bytes are mixed bijectively; of more, through two chains; of more than LONG_WORD, through BLAKE2.
SHORT_WORD, LONG_WORD = 7, 64
_A, _B = U64(0xC2B2AE3D27D4EB4F), U64(0xD6E8FEB86659FD93)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64 if big else np.int32)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offs.astype(np.int64)


def chunks(offs: np.ndarray, most: int = 1 << 18):
    """Row ranges whose texts have about ``most`` bytes together, at least one row each."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def split(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray):
    """Start and end of each word, and where each row's words begin (rows + 1 entries)."""
    d, o = data[offs[0] : offs[-1]], offs - offs[0]
    n = len(d)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return d, empty, empty, np.zeros(len(o), np.int64)
    w = is_word[d]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = w[:-1]
    before[o[:-1][o[:-1] < n]] = False
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = w[1:]
    after[o[1:][o[1:] > 0] - 1] = False
    starts = np.flatnonzero(w & ~before)
    ends = np.flatnonzero(w & ~after) + 1
    return d, starts, ends, np.searchsorted(starts, o)


def word_hashes(d: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
    """A 64-bit hash of each word's bytes after the byte map ``fold``.

    Words of up to SHORT_WORD bytes fill a 64-bit number with their length, which a bijection mixes: no two
    collide.  The 8-byte blocks of longer ones go through two unlike chains of multiply-xorshift mixes, so that no
    block can undo another; the longest words get a cryptographic hash.
    """
    if not len(starts):
        return np.zeros(0, U64)
    f = np.zeros(len(d) + 8, np.uint8)
    f[: len(d)] = d if fold is SAME else fold[d]
    block = np.ndarray((len(d) + 1,), "<u8", f, strides=(1,))  # the 8 bytes from each byte on
    size = ends - starts
    short = np.minimum(size, SHORT_WORD)
    h = mix64((block[starts] & _LOW_BYTES[short]) | (short.astype(U64) << U64(56)))
    live, at = np.flatnonzero((size > SHORT_WORD) & (size <= LONG_WORD)), 0
    one = two = size[live].astype(U64) * _A
    while len(live):
        b = block[starts[live] + at] & _LOW_BYTES[np.minimum(size[live] - at, 8)]
        one, two = mix64(one * _B ^ b), mix64((two ^ (two >> U64(31))) + b * _A)
        at += 8
        done = size[live] <= at
        h[live[done]] = mix64(one[done] ^ (two[done] * _B))
        live, one, two = live[~done], one[~done], two[~done]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(f[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _A
    x ^= x >> U64(32)
    x += b
    x *= _B
    x ^= x >> U64(29)
    return x


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive entries of ``h``, by doubling (row borders are the caller's matter)."""
    if len(h) < k:
        return np.zeros(0, U64)
    have, x = 1, h
    while have * 2 <= k:
        x = _joined(x[:-have], x[have:])
        have *= 2
    if have < k:
        x = _joined(x[: len(h) - k + 1], x[k - have :])
    return mix64(x + U64(k))


def plain(d: np.ndarray, starts: np.ndarray, ends: np.ndarray, is_word: np.ndarray, fold: np.ndarray = SAME):
    """The words after ``fold`` as bytes, one blank between those of a row; start and end of each word in them."""
    w = is_word[d]
    keep = w.copy()
    keep[1:] |= w[:-1]
    out = (d if fold is SAME else fold[d])[keep]
    out[~w[keep]] = 32
    begin = (np.cumsum(keep) - keep)[starts] if len(starts) else starts
    return out, begin, begin + (ends - starts)


def word_ids(d: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of words: equal if and only if the words are; and how many there are."""
    if not len(starts):
        return np.zeros(0, np.int64), 0
    size = ends - starts
    offs = np.concatenate([[0], np.cumsum(size)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(d[ranges(starts, size)])])
    coded = words.dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), len(coded.dictionary)


def gram_ids(ids: np.ndarray, kinds: int, k: int) -> np.ndarray:
    """Numbers of each ``k`` consecutive entries of ``ids`` (below ``kinds``): equal if and only if the entries are."""
    out, many = ids, max(kinds, 1)
    for j in range(1, k):
        if len(out) < 2:
            return out[: max(len(ids) - k + 1, 0)]
        if many * max(kinds, 1) >= 1 << 62:
            out = np.unique(out, return_inverse=True)[1]
            many = int(out.max()) + 1
        out = out[:-1] * kinds + ids[j:]
        many *= max(kinds, 1)
    return out


def gram_rows(word_at: np.ndarray, k: int):
    """For each row, how many k-grams it has; and the positions of all k-grams that stay inside a row."""
    counts = np.maximum(np.diff(word_at) - (k - 1), 0)
    return counts, ranges(word_at[:-1], counts)


def ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (counts[0] of them), then those of the next row."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(first - at, counts)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive entries, by doubling."""
    if len(x) < w:
        return x[:0]
    have, m = 1, x
    while have * 2 <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[: len(x) - w + 1], m[w - have : w - have + len(x) - w + 1])
