"""N-gram Jaccard join by universe partitioning, and its connected components.

A text is the set of its distinct ``n``-word shingles.  Sets with Jaccard >= t
(``num / den``) have sizes within a factor t and differ in few shingles: at most H_k for sets
of size band k, so when hashing deals the universe into m = H_k + 1 segments, two
similar sets agree on a segment (pigeonhole).  Every set is indexed by its segments
under the segmentation of its own band and of the band below.

Cost-based allocation: a segment with under ``MIN_SEGMENT`` shingles would match far
too many sets, so it is not indexed, and for each one left out another segment is
upgraded to its one-deletion neighbourhood, which tolerates one difference.
The upgraded segments are the first of a fixed order that hold enough shingles, so
two sets always share enough of them for the pigeonhole to hold; a set with too
few such segments indexes all it has.

1. One pass gives each row its set's size and 128-bit digest; equal sets become one.
2. A second pass sends the signatures, packed by owner, to owners that keep the
   lists of sets sharing a signature, in parts of bounded length; equal lists are kept once.
3. In each list every set is verified against one hub and its neighbour by size.
4. Components of the verified links are found; only lists that still hold several
   components give further pairs, between components.  A pair inside one
   component can't change the result.  A long list is compared in cells of two blocks, a
   cell a task, and blocks of one component are never put together.  A parity sketch of each set bounds the
   difference of two from below and drops most of the rest unseen by the shuffle.
Verification is exact: it numbers the words of the two texts themselves and intersects their shingles.

``jaccard_components`` and ``keep_one`` end there.  ``jaccard_join`` gives every link: two linked
sets are in one component, so each component is dealt in hashed blocks of bounded size and all
its pairs of blocks are intersected exactly, a pair of blocks a task; no pair of sets becomes a row
unless the pairs themselves are asked for.

Hashes only find candidates and sizes of sets: a shingle has 64 bits, so two different ones among
the 1,000 of a text count as one with a probability below 1e-13.  Digests of sets are checked
for collisions.  Words: ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text of fewer words than
``n`` is one shingle; null, empty and blank texts have none and link with nothing.
Repeated rows are equal sets; a null id never names a component that has another
id; ids are whole numbers (a text id fails); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _words as wd
from ._spark import cut, discard, fitting, small_batches, table, trimmed
from .components import components

MIN_SEGMENT = 2
#: Signatures that a task packs at a time, and about how many an owner gets.
FLUSH, OWNER_ENTRIES = 1_000_000, 500_000
#: Sets and shingles of a block; a task of the full join compares two blocks of one component.
BLOCK_SETS, BLOCK_SHINGLES = 1_000, 200_000
#: Sets in a part of a list, and in a block of a list whose components are compared.
PART_SETS, LIST_BLOCK = 4096, 512
#: Sets that a task verifies against one hub, and bytes of text that it numbers at a time.
SHARE_SETS, VERIFY_BYTES = 512, 1 << 22
U64 = np.uint64
_MASK48 = U64((1 << 48) - 1)


def signatures_per_shingle(num: int, den: int) -> float:
    """About how many signatures a set has for each shingle, under both of its segmentations."""
    segments = 1.05 * (1 + den / num) * (den - num) / (den + num)
    size = 1 / segments
    short = math.exp(-size) * (1 + size)  # share of segments with fewer than two shingles
    return segments * (1 + num / den) * (1 + short * (size + 2))


@cache
def bands(num: int, den: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First size of each band, its segments, and the largest size indexed under it; for sizes up to ``most``."""
    low, segments, top = [], [], []
    size = 1
    while size <= most:
        high = size * den // num
        partner = high * den // num
        low.append(size)
        segments.append((high + partner) * (den - num) // (den + num) + 1)
        top.append(partner)
        size = high + 1
    return np.array(low), np.array(segments), np.array(top)


def shingle_sets(col: pa.Array, n: int):
    """For each row: index and its sorted distinct shingle hashes (rows without words give an empty array)."""
    data, offs = wd.text_buffer(col)
    for i, j in wd.chunks(offs):
        d, starts, ends, at = wd.split(data, offs[i : j + 1], wd.NON_SPACE)
        h = wd.word_hashes(d, starts, ends, wd.LOWER)
        g = wd.grams(h, n)
        for x, (a, z) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            if z - a >= n:
                s = np.sort(g[a : z - n + 1])
                yield i + x, s[np.concatenate([[True], s[1:] != s[:-1]])]
            else:
                yield i + x, wd.grams(h[a:z], z - a) if z > a else g[:0]


def _digest(s: np.ndarray, salt: int) -> tuple[int, int]:
    a = wd.mix64(s + U64(salt)).sum(dtype=U64)
    b = wd.mix64(s ^ U64(0xA24BAED4963EE407)).sum(dtype=U64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _mark(n: int, salt: int):
    @trimmed
    def run(batches):
        for b in batches:
            size, s1, s2 = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for i, s in shingle_sets(b.column(2), n):
                size[i] = len(s)
                s1[i], s2[i] = _digest(s, salt)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size), pa.array(s1), pa.array(s2)], names=["id", "tk", "n", "sid", "s2"])

    return run


def signatures(s: np.ndarray, band: int, m: int) -> np.ndarray:
    """Keys of one set under a band's segmentation into ``m`` segments."""
    where = ((wd.mix64(s ^ U64(0x9E6C63D0676A9A99 + band)) >> U64(32)) * U64(m) >> U64(32)).astype(np.int64)
    token = wd.mix64(s + U64(0x632BE59BD9B4E019))
    count = np.bincount(where, minlength=m)
    order = np.argsort(where, kind="stable")
    total = np.zeros(len(s) + 1, dtype=U64)
    np.cumsum(token[order], out=total[1:])
    edge = np.concatenate([[0], np.cumsum(count)])
    sums = total[edge[1:]] - total[edge[:-1]]
    place = (np.arange(m, dtype=U64) + U64(band << 32)) * U64(0x8CB92BA72F3D8DD7)
    indexed = count >= MIN_SEGMENT
    need = m - int(indexed.sum())
    keys = [(sums + place)[indexed]]
    if need:
        roomy = np.flatnonzero(count > MIN_SEGMENT)
        if len(roomy) < need:  # too few to upgrade: index everything
            keys = [sums + place]
        upgraded = roomy[:need]
        inside = np.zeros(m, bool)
        inside[upgraded] = True
        own = inside[where]
        keys.append(sums[where[own]] - token[own] + place[where[own]])
    return wd.mix64(np.concatenate(keys))


def _index(n: int, num: int, den: int, salt: int, most: int, owners: int):
    """Signatures packed by owner: 48 bits of each key, the set it belongs to, and the sets' ids and sizes."""
    low, segments, top = bands(num, den, most)

    def flush(keys, sids, sizes):
        key = np.concatenate(keys)
        which = np.repeat(np.arange(len(keys)), [len(k) for k in keys]).astype(np.uint32)
        owner = (key >> U64(48)) * U64(owners) >> U64(16)
        order = np.argsort(owner, kind="stable")
        key, which, owner = key[order] & _MASK48, which[order], owner[order]
        edge = np.searchsorted(owner, np.arange(owners + 1))
        raw = key.view(np.uint8).reshape(-1, 8)[:, :6]
        sids, sizes = np.array(sids, np.int64), np.array(sizes, np.int32)
        rows = []
        for o, (a, z) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
            if z > a:
                used, local = np.unique(which[a:z], return_inverse=True)
                rows.append((o, raw[a:z].tobytes(), local.astype("<u4" if len(used) > 65535 else "<u2").tobytes(), sids[used].tobytes(), sizes[used].tobytes()))
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=["owner", "keys", "which", "sids", "sizes"])

    @trimmed
    def run(batches):
        keys, sids, sizes, seen, held = [], [], [], set(), 0
        for b in batches:
            for _, s in shingle_sets(b.column(0), n):
                if not len(s):
                    continue
                sid = _digest(s, salt)[0]
                if sid in seen:
                    continue
                seen.add(sid)
                k = int(np.searchsorted(low, len(s), side="right")) - 1
                own = [signatures(s, x, int(segments[x])) for x in (k, k - 1) if x >= 0 and segments[x] > 1 and len(s) <= top[x]]
                if own:
                    keys.append(np.concatenate(own) if len(own) > 1 else own[0])
                    sids.append(sid)
                    sizes.append(len(s))
                    held += len(keys[-1])
            if held > FLUSH:
                yield flush(keys, sids, sizes)
                keys, sids, sizes, seen, held = [], [], [], set(), 0
        if keys:
            yield flush(keys, sids, sizes)

    return run


def _lists(part_sets: int):
    """At an owner: the distinct lists of two or more sets that share a signature, sorted by size, in parts."""

    @trimmed
    def run(batches):
        rows: dict[int, list] = {}
        for b in batches:
            for o, *parts in zip(*[c.to_pylist() for c in b.columns], strict=True):
                rows.setdefault(o, []).append(parts)
        while rows:
            _, parts = rows.popitem()
            keys, sids, sizes = [], [], []
            for raw, which, ids, n in parts:
                k = np.zeros((len(raw) // 6, 8), np.uint8)
                k[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
                w = np.frombuffer(which, "<u4" if len(ids) // 8 > 65535 else "<u2")
                keys.append(k.view("<u8").ravel())
                sids.append(np.frombuffer(ids, np.int64)[w])
                sizes.append(np.frombuffer(n, np.int32)[w])
            key, sid, size = np.concatenate(keys), np.concatenate(sids), np.concatenate(sizes)
            del parts, keys, sids, sizes
            order = np.argsort(key)
            s = key[order]
            same = np.concatenate([[False], s[1:] == s[:-1]])
            twice = same | np.concatenate([same[1:], [False]])
            order = order[twice]
            order = order[np.lexsort((sid[order], size[order], key[order]))]
            key, sid, size = key[order], sid[order], size[order]
            if not len(key):
                continue
            keep = np.concatenate([[True], (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])])
            key, sid, size = key[keep], sid[keep], size[keep]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            count = np.diff(np.append(first, len(key)))
            h1 = np.add.reduceat(wd.mix64(sid.view(U64)), first)
            h2 = np.add.reduceat(wd.mix64(sid.view(U64) ^ U64(0x1F83D9ABFB41BD6B)), first)
            many = np.flatnonzero(count > 1)
            if not len(many):
                continue
            pick = many[np.unique(np.stack([h1[many], h2[many]]), axis=1, return_index=True)[1]]
            out = []
            for a, n, x, y in zip(first[pick].tolist(), count[pick].tolist(), h1[pick].view(np.int64).tolist(), h2[pick].view(np.int64).tolist(), strict=True):
                hub = a + n // 2
                for part, f in enumerate(range(a, a + n, part_sets)):
                    z = min(f + part_sets, a + n)
                    prev = max(f - 1, a)  # the neighbour in the part before; itself in the first part
                    out.append((x, y, part, int(sid[hub]), int(size[hub]), int(sid[prev]), int(size[prev]), sid[f:z], size[f:z]))
            columns = list(zip(*out, strict=True))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["h1", "h2", "part", "hub", "hub_n", "prev", "prev_n", "sids", "sizes"])

    return run


_LIST = "h1 long, h2 long, part int, hub long, hub_n int, prev long, prev_n int, sids array<long>, sizes array<int>"


def _pair_batch(a, b):
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
    low, high = np.minimum(a, b), np.maximum(a, b)
    pairs = np.unique(np.stack([low, high], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _first_pairs(num: int, den: int):
    """Each set of a list's part with the hub in the middle of the list and with its neighbour by size."""

    @trimmed
    def run(batches):
        for batch in batches:
            a, b = [], []
            for hub, hub_n, prev, prev_n, sids, sizes in zip(*[c.to_pylist() for c in batch.columns[:4]], batch.column(4), batch.column(5), strict=True):
                sid, n = np.asarray(sids.values), np.asarray(sizes.values).astype(np.int64)
                x, nx = np.concatenate([np.full(len(sid), hub), [prev], sid[:-1]]), np.concatenate([np.full(len(sid), hub_n), [prev_n], n[:-1]])
                y, ny = np.concatenate([sid, sid]), np.concatenate([n, n])
                ok = (x != y) & (den * np.minimum(nx, ny) >= num * np.maximum(nx, ny))
                a.append(x[ok])
                b.append(y[ok])
            yield _pair_batch(a, b)

    return run


def odd_sketch(s: np.ndarray) -> bytes:
    """Parities of the set's shingles over four to eight bits a shingle.

    Two sketches differ in at most as many bits as their sets differ in shingles, and in nearly as many
    while sets differ in a part of their shingles only.
    """
    bits = 1 << max(6, (len(s) - 1).bit_length() + 2)
    at = (wd.mix64(s ^ U64(0x3C6EF372FE94F82B)) & U64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _folded(sketches: list[bytes]) -> np.ndarray:
    """The sketches at the length of the shortest, as rows of 64-bit words."""
    least = min(map(len, sketches))
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, least), axis=0) for x in sketches]).view(U64)


def _cross_pairs(num: int, den: int):
    """Pairs of the sets of a cell (one block of a list, or two) that lie in different components and that sizes and sketches leave possible."""

    @trimmed
    def run(batches):
        a, b, held = [], [], 0
        for batch in batches:
            for own, members in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                v = members.values
                block, root, sid, n = (np.asarray(v.field(k)) for k in range(4))
                order = np.argsort(n, kind="stable")
                sketch = _folded(v.field(4).to_pylist())[order]
                block, root, sid, n = block[order], root[order], sid[order], n[order].astype(np.int64)
                stop = np.searchsorted(n, n * den // num, side="right")
                for i in range(len(sid)):
                    other = np.arange(i + 1, stop[i])
                    other = other[(root[other] != root[i]) & (own | (block[other] != block[i]))]
                    both = n[other] + n[i]
                    most = both - 2 * -(-num * both // (num + den))
                    other = other[np.bitwise_count(sketch[other] ^ sketch[i]).sum(axis=1, dtype=np.int64) <= most]
                    if len(other):
                        a.append(np.full(len(other), sid[i]))
                        b.append(sid[other])
                        held += len(other)
                    if held > 500_000:
                        yield _pair_batch(a, b)
                        a, b, held = [], [], 0
        if held:
            yield _pair_batch(a, b)

    return run


def _sets(n: int, salt: int):
    """Words and sketches of the sets asked for, once a task; the words lower-cased with one blank between."""

    @trimmed
    def run(batches):
        done = set()
        for b in batches:
            want = b.column(1).to_pylist()
            ids, texts, sketches = [], [], []
            for i, s in shingle_sets(b.column(0), n):
                if want[i] not in done and _digest(s, salt)[0] == want[i]:
                    done.add(want[i])
                    ids.append(want[i])
                    texts.append(b" ".join(b.column(0)[i].as_buffer().to_pybytes().lower().split()))  # of bytes: A-Z and the six separators only
                    sketches.append(odd_sketch(s))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.binary()), pa.array(sketches, pa.binary())], names=["sid", "words", "sketch"])

    return run


def exact_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingles of texts of words; two numbers are equal if and only if their words are."""
    data, offs = wd.text_buffer(texts)
    d, starts, ends, at = wd.split(data, offs, wd.NON_SPACE)
    ids, kinds = wd.word_ids(d, starts, ends)
    g = wd.gram_ids(ids, kinds, n)
    short: dict[tuple, int] = {}
    out = []
    for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if z - a >= n:
            out.append(np.unique(g[a : z - n + 1]))
        else:
            out.append(np.array([-1 - short.setdefault(tuple(ids[a:z].tolist()), len(short))], np.int64) if z > a else g[:0])
    return out


def _similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    common = int((x[at] == y).sum())
    return den * common >= num * (len(x) + len(y) - common)


def _verify(n: int, num: int, den: int):
    """From rows sorted by (a, part, b) whose first of each (a, part) has the words of ``a`` and no ``b``: the similar pairs."""

    @trimmed
    def run(batches):
        hub = b""
        for batch in batches:
            a, b, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            u, v = [], []
            for i, j in wd.chunks(wd.text_buffer(texts)[1], VERIFY_BYTES):
                own, *sets = exact_sets(pa.concat_arrays([pa.array([hub], texts.type), texts.slice(i, j - i)]), n)
                for k, s in enumerate(sets, i):
                    if b[k] is None:
                        own, hub = s, texts[k].as_py()
                    elif _similar(own, s, num, den):
                        u.append(a[k])
                        v.append(b[k])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def similar_pairs(sets: list[np.ndarray], first: int, num: int, den: int):
    """All similar pairs x < y of sets, as (x, ys); only those across ``first`` if it is not 0."""
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    flat, own = flat[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    count = np.diff(np.append(start, len(flat)))
    shared = np.empty(len(flat), np.int64)
    shared[order] = np.repeat(np.arange(len(start)), count)
    edge = np.concatenate([[0], np.cumsum(size)])
    for x in range(first or len(sets)):
        g = shared[edge[x] : edge[x + 1]]
        g = g[count[g] > 1]
        common = np.bincount(own[wd.ranges(start[g], count[g])], minlength=len(sets))
        low = first or x + 1
        c = common[low:]
        yield x, low + np.flatnonzero(den * c >= num * (size[x] + size[low:] - c))


def _cell_links(n: int, num: int, den: int, as_pairs: bool):
    """From sets sorted by cell (two blocks of a component): the pairs, or the number of links of each set in the cell."""

    def solve(rows):
        first = sum(r[0] == rows[0][0] for r in rows) % len(rows)
        sid = np.array([r[1] for r in rows], np.int64)
        out = [(np.full(len(y), x), y) for x, y in similar_pairs(exact_sets(pa.array([r[2] for r in rows], pa.binary()), n), first, num, den) if len(y)]
        x, y = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if as_pairs:
            return np.minimum(sid[x], sid[y]), np.maximum(sid[x], sid[y])
        links = np.bincount(np.concatenate([x, y]), minlength=len(sid))
        return sid[links > 0], links[links > 0]

    def batch(done):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*done, strict=True)], names=["u", "v"])

    @trimmed
    def run(batches):
        cell, rows, done = None, [], []

        def end():
            nonlocal done
            one = rows[0][0] == rows[-1][0]  # block
            if len(rows) > 1 and one == (cell[1] == cell[2]):  # a block may be empty
                done.append(solve(rows))
            if sum(len(u) for u, _ in done) > 100_000 or len(done) > 10_000:
                yield batch(done)
                done = []

        for b in batches:
            for root, i, j, block, sid, raw in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if (root, i, j) != cell:
                    if rows:
                        yield from end()
                    cell, rows = (root, i, j), []
                rows.append((block, sid, raw))
        if rows:
            yield from end()
        if done:
            yield batch(done)

    return run


def _links(named: DataFrame, sets: DataFrame, n: int, num: int, den: int, as_pairs: bool) -> DataFrame:
    """Columns u, v: all pairs of similar sets, or sets and their numbers of links."""
    sizes = named.groupBy("root").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles")).where("sets > 1")
    blocks = sizes.select("root", F.ceil(F.greatest(F.col("sets") / BLOCK_SETS, F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = named.select("sid", "root").join(blocks, "root").select("sid", "root", "blocks", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int").alias("block"))
    cells = placed.select("sid", "root", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("sid", "root", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    rows = cells.join(sets.select("sid", "words"), "sid").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "block")
    found = rows.select("root", "i", "j", "block", "sid", "words").mapInArrow(_cell_links(n, num, den, as_pairs), "u long, v long")
    return found if as_pairs else found.groupBy("u").agg(F.sum("v").alias("v"))


def _cells(members: DataFrame) -> DataFrame:
    """lid, i, j, block, root, sid, n: the sets of each list in cells of one block or two; every pair of components meets in a cell.

    A component of over LIST_BLOCK sets of a list has blocks of its own, which never meet; the others share blocks.
    """
    sizes = members.groupBy("lid", "root").agg(F.count(F.lit(1)).alias("sets"), F.collect_set("place").alias("places"))
    large = F.col("sets") > LIST_BLOCK
    small = sizes.where(~large).groupBy("lid").agg(F.ceil(F.sum("sets") / LIST_BLOCK).cast("long").alias("blocks"))
    plan = sizes.join(small, "lid", "left")
    plan = plan.select("lid", "root", F.explode("places").alias("place"), large.alias("large"), F.when(large, F.ceil(F.col("sets") / LIST_BLOCK).cast("long")).otherwise(F.col("blocks")).alias("blocks"))
    own = F.xxhash64("root", F.pmod(F.xxhash64("sid"), F.col("blocks"))).bitwiseOR(F.lit(-(1 << 63)))  # below 0
    placed = members.join(plan, ["lid", "root", "place"])
    placed = placed.select("lid", "root", "sid", "n", F.when(F.col("large"), own).otherwise(F.pmod(F.xxhash64("root"), F.col("blocks"))).alias("block"), F.when(F.col("large"), F.col("root")).alias("only"))
    blocks = cut(placed.groupBy("lid", "block").agg(F.min("only").alias("only")), "blocks")
    pairs = blocks.select("lid", F.col("block").alias("i"), F.col("only").alias("x")).join(blocks.select("lid", F.col("block").alias("j"), F.col("only").alias("y")), "lid")
    pairs = pairs.where("i <= j AND NOT coalesce(x = y, false)")
    ends = pairs.select("lid", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    return placed.select("lid", "root", "sid", "n", "block").join(ends, ["lid", "block"])


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, num: int = 90, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """(rows, links): id, n_shingles, set_id, component_id, root (the component as a set_id) and text_key of every row; and verified links between set_ids that span all components, not all links (``jaccard_join``)."""
    return _components(docs, id_col, text_col, n, num, den)[:2]


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, num: int = 90, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """(rows, pairs): id, n_shingles, set_id, class_id (smallest id with the same set), component_id and n_links (other sets that are similar) of every row; and all pairs u < v of similar set_ids."""
    rows, _, named, sets = _components(docs, id_col, text_col, n, num, den)
    links = _links(named, sets, n, num, den, False).select(F.col("u").alias("set_id"), F.col("v").alias("n_links"))
    known = named.select(F.col("sid").alias("set_id"), F.col("low").alias("class_id")).join(links, "set_id", "left")
    out = rows.select(F.col(id_col).alias("id"), "n_shingles", "set_id", "component_id").join(known, "set_id", "left")
    class_id = F.when(F.col("set_id").isNull(), F.col("id")).otherwise(F.col("class_id"))
    out = out.select(F.col("id").alias(id_col), "n_shingles", "set_id", class_id.alias("class_id"), "component_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    return out, _links(named, sets, n, num, den, True)


def _components(docs: DataFrame, id_col: str, text_col: str, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows and links as in ``jaccard_components``; sid, n, low (smallest id), root and component_id of every set; words of the sets that share a signature."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tk"), text.alias("text"))
    salt = 0
    while True:
        marked = cut(rows.mapInArrow(_mark(n, salt), "id long, tk long, n long, sid long, s2 long"), "sets")
        kinds = cut(marked.where("n > 0").groupBy("sid", "s2").agg(F.min("id").alias("low"), F.min(F.struct("tk", "id")).alias("of"), F.first("n").alias("n")), "kinds")
        facts = kinds.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("sid").alias("ids"), F.sum("n").alias("shingles"), F.max("n").alias("most")).first()
        if facts["rows"] == facts["ids"]:
            break
        salt += 1

    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((facts["shingles"] or 0) * signatures_per_shingle(num, den) / OWNER_ENTRIES))
    packed = rows.select("text").mapInArrow(_index(n, num, den, salt, facts["most"] or 1, min(owners, 65536)), "owner int, keys binary, which binary, sids binary, sizes binary")
    lists = packed.repartition(owners, "owner").mapInArrow(_lists(PART_SETS), _LIST)
    lists = lists.groupBy("h1", "h2", "part").agg(*[F.first(c).alias(c) for c in ("hub", "hub_n", "prev", "prev_n", "sids", "sizes")])
    lists = cut(lists.select(F.xxhash64("h1", "h2").alias("lid"), "part", "hub", "hub_n", "prev", "prev_n", "sids", "sizes"), "lists")  # lists of one lid by chance only add candidates

    wanted = lists.select(F.explode("sids").alias("sid")).distinct().join(kinds.select("sid", "of"), "sid")
    wanted = cut(wanted.select("sid", F.col("of.tk").alias("of_tk"), F.col("of.id").alias("of_id")), "wanted")
    n_wanted = wanted.count()
    one = rows.join(fitting(wanted, n_wanted, 32), (F.col("tk") == F.col("of_tk")) & F.col("id").eqNullSafe(F.col("of_id")))  # one row of each set
    sets = one.select("text", "sid").mapInArrow(_sets(n, salt), "sid long, words binary, sketch binary")
    sets = cut(sets.groupBy("sid").agg(F.first("words").alias("words"), F.first("sketch").alias("sketch")), "words")

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs that are similar.  A set verified against many is sent once for each share of them."""
        shares = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SHARE_SETS).cast("int").alias("shares"))
        salted = pairs.join(shares, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("shares")).alias("part"))
        left = salted.join(sets.select(F.col("sid").alias("b"), "words"), "b").select("a", "part", "b", "words")
        right = shares.join(sets.select(F.col("sid").alias("a"), "words"), "a").select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares").cast("long") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "words")
        return left.union(right).repartition("a", "part").sortWithinPartitions("a", "part", "b").select("a", "b", "words").mapInArrow(_verify(n, num, den), "u long, v long")

    tried = cut(lists.select("hub", "hub_n", "prev", "prev_n", "sids", "sizes").mapInArrow(_first_pairs(num, den), "a long, b long").distinct(), "pairs")
    links = cut(verified(tried), "verified")
    roots = components(links)
    place = F.floor((F.col("part") * PART_SETS + F.col("pos")) / LIST_BLOCK).cast("int").alias("place")  # a long list is joined place by place
    members = lists.select("lid", "part", F.posexplode(F.arrays_zip("sids", "sizes")).alias("pos", "m")).select("lid", place, F.col("m.sids").alias("sid"), F.col("m.sizes").alias("n"))
    members = members.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("lid", "place", F.coalesce("root", "sid").alias("root"), "sid", "n")
    mixed = members.groupBy("lid").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.max("place").alias("last")).where("r0 <> r1")
    mixed = mixed.select("lid", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("place"))
    members = cut(members.join(mixed, ["lid", "place"], "left_semi"), "members")
    rest = _cells(members).join(sets.select("sid", "sketch"), "sid").groupBy("lid", "i", "j").agg(F.collect_list(F.struct("block", "root", "sid", "n", "sketch")).alias("members"))
    rest = rest.select((F.col("i") == F.col("j")).alias("own"), "members").mapInArrow(_cross_pairs(num, den), "a long, b long")
    rest = cut(rest.distinct().join(tried, ["a", "b"], "left_anti"), "rest")
    more = cut(verified(rest), "verified")
    links = links.union(more)
    if not more.isEmpty():
        old = roots
        roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more))
        discard(old)

    named = kinds.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "n", "low", F.coalesce("root", "sid").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = cut(named.join(lowest, "root").select("sid", "n", "low", "root", "component_id"), "named")
    discard(kinds, lists, wanted, tried, members, rest, roots)
    out = marked.select("id", "tk", "n", F.when(F.col("n") > 0, F.col("sid")).alias("sid")).join(named.select("sid", "root", "component_id"), "sid", "left")
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("sid").alias("set_id"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), F.when(F.col("n") > 0, F.col("root")).alias("root"), F.col("tk").alias("text_key"))
    return out, links, named, sets


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """The rows of ``docs``, with all their columns, without near duplicates: one row of each component stays.

    It is the one with the smallest id (null counts as largest), then the smallest text key, and one
    only if that row is repeated.  Rows without shingles all stay.
    """
    rows, _ = jaccard_components(docs, id_col, text_col, n, num, den)
    key = F.struct(F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"))
    keyed = rows.where("n_shingles > 0").select(key.alias("_key"), F.col("text_key").alias("_tk"), "root")
    kinds = cut(keyed.groupBy("root", "_key", "_tk").agg(F.count(F.lit(1)).alias("times")), "kinds")
    first = kinds.groupBy("root").agg(F.min(F.struct("_key", "_tk")).alias("first"))
    judged = kinds.join(first, "root").select("_key", "_tk", "times", (F.struct("_key", "_tk") == F.col("first")).alias("stays"))
    out = cut(judged.where("NOT stays OR times > 1").select("_key", "_tk", "stays"), "dropped")
    n_out = out.count()
    all_rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("_key"), F.xxhash64(text_col).alias("_tk"))
    kept = all_rows.join(fitting(out, n_out, 48), ["_key", "_tk"], "left_anti").select("row")
    repeated = all_rows.join(fitting(out.where("stays"), n_out, 48), ["_key", "_tk"], "left_semi").dropDuplicates(["_key", "_tk"]).select("row")
    return kept.union(repeated).select("row.*")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = jaccard_components(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id")


OP5_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 3) - 1], ' ') AS g FROM d, unnest(generate_series(1, greatest(len(w) - 2, 1))) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id WHERE r.root < e.y)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.root AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c USING (doc_id)
"""


def op5_ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = jaccard_join(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "class_id", "component_id", "n_links")


OP5_LINKS_SQL = (
    OP5_SQL.partition("SELECT d.doc_id, coalesce")[0]
    + r"""
, c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY gs) AS class_id FROM (SELECT doc_id, string_agg(g, chr(10) ORDER BY g) AS gs FROM s GROUP BY doc_id)),
k AS (SELECT e.x AS doc_id, count(DISTINCT y.class_id) AS n_links FROM e JOIN c x ON x.doc_id = e.x JOIN c y ON y.doc_id = e.y WHERE x.class_id <> y.class_id GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.class_id, d.doc_id) AS class_id, m.root AS component_id, coalesce(k.n_links, 0)::BIGINT AS n_links
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id) JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) m USING (doc_id)
"""
)

QUERIES = {"op5_ngram_jaccard": op5_ngram_jaccard, "op5_ngram_jaccard_links": op5_ngram_jaccard_links}
ORACLE = {"op5_ngram_jaccard": OP5_SQL, "op5_ngram_jaccard_links": OP5_LINKS_SQL}
