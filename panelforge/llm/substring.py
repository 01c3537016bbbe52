"""Substring dedup: repeated word windows, found behind a count-min prefilter.

A window is ``WINDOW`` consecutive words of a text.  Its anchor is the first, of
the k-grams of words inside it, with the smallest hash; equal windows have equal
anchors, so the number of times an anchor's k-gram is selected anywhere is never
less than the count of any window it stands for.

1. Each partition counts its selected anchors in a count-min sketch; the sparse
   sketches are merged cell by cell, and one bit a cell ("at least two") is kept.
2. A second pass keeps the windows whose anchor the sketch estimates at two or
   more.  No repeated window is lost; most others are never shuffled.
3. The windows kept travel as runs, the words of all windows in a row that share an anchor, to the
   task that owns the anchor.  There equal runs become one, and windows are grouped by a hash and
   compared word by word, so that only windows of the same words count as repeated.  Those that
   occur again are sent back to their texts as positions, and the covered words are removed.

Rows of one text are handled as one: what is exchanged carries a 128-bit text key (of SHA-256)
and, after merging inside a task, whether the run was met more than once.  So a
group of copies, or a passage inside many texts, costs one entry a task, not one a row.

The sketch has ``cells`` cells, about eight for each expected anchor, between 2**20 and
``max_cells``; its bits are the only data sent to all tasks (2 * cells / 8 bytes,
128 MB at most).  A fuller sketch lets more windows through to the exact pass;
results don't change.

Words: ``[^\\x20\\x09-\\x0D]+``.  Null and empty texts have no words; texts shorter than a
window keep all; repeated rows are occurrences of their own, as are equal texts;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _words as wd
from ._filter import FILTER_BITS, bloom, may_hold
from ._spark import cut, small_batches, table, trimmed

WINDOW, ANCHOR = 35, 8
DEPTH, SHARDS = 2, 64
MIN_CELLS, MAX_CELLS = 1 << 20, 1 << 29
#: Anchors that a task counts, and bytes of runs that it gathers, before it sends them on.
FLUSH_ANCHORS, FLUSH_BYTES = 2_000_000, 24 << 20
#: Text behind the windows that one task groups, about.
TASK_BYTES = 32 << 20
_POS = np.uint64((1 << 24) - 1)


def _anchors(h: np.ndarray, at: np.ndarray, window: int, k: int):
    """Row, first word and anchor position of every window of the chunk."""
    count, where = wd.gram_rows(at, window)
    g = wd.grams(h, k)
    if not len(where):
        return np.zeros(0, np.int64), where, where, g
    parts = []
    step, w = 1 << 23, window - k + 1
    for a in range(0, len(g), step):
        part = g[a : a + step + w - 1]
        low = wd.sliding_min((part & ~_POS) | np.arange(len(part), dtype=np.uint64), w)
        own = where[(where >= a) & (where < a + step)] - a
        parts.append((low[own] & _POS).astype(np.int64) + a)
    return np.repeat(np.arange(len(count)), count), where, np.concatenate(parts), g


def _cells(anchor: np.ndarray, cells: int) -> list[np.ndarray]:
    mask = np.uint64(cells - 1)
    return [(wd.mix64(anchor ^ np.uint64(0xA0761D6478BD642F + r)) & mask).astype(np.int64) for r in range(DEPTH)]


def _sketch(window: int, k: int, cells: int):
    """Per task and shard: the cells that its anchors hit, and a bitmap of those hit twice or more."""

    def flush(gathered):
        anchor = np.concatenate(gathered)
        rows = []
        for r, c in enumerate(_cells(anchor, cells)):
            cell, n = np.unique(c, return_counts=True)
            shard = cell // (cells // SHARDS)
            edge = np.searchsorted(shard, np.arange(SHARDS + 1))
            rows += [(r * SHARDS + s, (cell[a:z] - s * (cells // SHARDS)).astype("<u4").tobytes(), np.packbits(n[a:z] > 1).tobytes()) for s, (a, z) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if z > a]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary()), pa.array([x[2] for x in rows], pa.binary())], names=["shard", "cells", "twice"])

    @trimmed
    def run(batches):
        gathered, size = [], 0
        for b in batches:
            data, offs = wd.text_buffer(b.column(0))
            for i, j in wd.chunks(offs):
                d, starts, ends, at = wd.split(data, offs[i : j + 1], wd.NON_SPACE)
                _, _, pos, g = _anchors(wd.word_hashes(d, starts, ends), at, window, k)
                if len(pos):
                    gathered.append(g[pos[np.flatnonzero(np.diff(pos, prepend=-1))]])
                    size += len(gathered[-1])
            if size > FLUSH_ANCHORS:
                yield flush(gathered)
                gathered, size = [], 0
        if size:
            yield flush(gathered)

    return run


def _merge(cells: int):
    """A shard's sketches added up, as one bit for each cell with a count of two or more."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        once, more = np.zeros(cells // SHARDS, bool), np.zeros(cells // SHARDS, bool)
        for c, t in zip(pdf["cells"], pdf["twice"], strict=True):
            at = np.frombuffer(c, "<u4")
            more[at] |= once[at] | np.unpackbits(np.frombuffer(t, np.uint8))[: len(at)].astype(bool)
            once[at] = True
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "bits": [np.packbits(more).tobytes()]})

    return run


def _packed(flags: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    cuts = np.cumsum(sizes)
    return [np.packbits(flags[z - n : z]).tobytes() for z, n in zip(cuts.tolist(), sizes.tolist(), strict=True)]


_RUN = [("owner", pa.int64()), ("text_key", pa.binary()), ("first", pa.int32()), ("n", pa.int32()), ("again", pa.bool_()), ("words", pa.binary())]
_RUN_SQL = "owner long, text_key binary, first int, n int, again boolean, words binary"


def _suspects(window: int, k: int, cells: int, bits):
    """Runs of windows whose anchor may be repeated.

    A run that a task meets twice is repeated as a whole: its holders know at once (no words go with
    them), and its words reach the owner of the anchor once, marked, without a holder.
    """

    def flush(runs, texts):
        rows = []
        for (anchor, words), holders in runs.items():
            again = len(holders) > 1 or texts[holders[0][0]] > 1
            n = holders[0][2]
            if again:
                rows += [(int.from_bytes(key[:8], "little", signed=True), key, first, n, True, None) for key, first, _ in holders]
            key, first, _ = holders[0]
            rows.append((anchor, None if again else key, first, n, again, words))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _RUN, strict=True)], names=[n for n, _ in _RUN])

    @trimmed
    def run(batches):
        sketch = bits.value
        runs: dict = {}  # (anchor, words): text key, first word and windows of each holder
        texts: dict = {}  # rows of each text met
        size = 0
        for b in batches:
            data, offs = wd.text_buffer(b.column(0))
            keys = b.column(1).to_pylist()
            for i, j in wd.chunks(offs):
                d, starts, ends, at = wd.split(data, offs[i : j + 1], wd.NON_SPACE)
                row, where, pos, g = _anchors(wd.word_hashes(d, starts, ends), at, window, k)
                if not len(pos):
                    continue
                new = np.flatnonzero((np.diff(pos, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
                stop = np.append(new[1:], len(pos))
                maybe = np.ones(len(new), bool)
                for r, c in enumerate(_cells(g[pos[new]], cells)):
                    maybe &= ((sketch[r * (cells >> 3) + (c >> 3)] >> (7 - (c & 7)).astype(np.uint8)) & 1).astype(bool)
                new, stop = new[maybe], stop[maybe]
                if not len(new):
                    continue
                words, begin, end = wd.plain(d, starts, ends, wd.NON_SPACE)
                words, last = words.tobytes(), where[new] + (stop - new) + window - 2
                known: set = set()
                x = -1
                for r, anchor, a, n, p, q in zip(row[new].tolist(), g[pos[new]].view(np.int64).tolist(), where[new].tolist(), (stop - new).tolist(), begin[where[new]].tolist(), end[last].tolist(), strict=True):
                    if r != x:
                        x, key = r, keys[i + r]
                        texts[key] = texts.get(key, 0) + 1
                        if texts[key] > 1:
                            known.add(r)
                    if r in known:
                        continue
                    runs.setdefault((anchor, words[p:q]), []).append((key, a - int(at[r]), n))
                    size += q - p
            if size > FLUSH_BYTES:
                yield flush(runs, texts)
                runs, texts, size = {}, {}, 0
        if runs:
            yield flush(runs, texts)

    return run


def _equal_windows(d: np.ndarray, offs: np.ndarray, window: int):
    """Of distinct runs: how many windows each has, and which windows have the words of another window (its own run's included)."""
    d, starts, ends, at = wd.split(d, offs, wd.NON_SPACE)
    count, where = wd.gram_rows(at, window)
    h = wd.grams(wd.word_hashes(d, starts, ends), window)[where]
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    shared = ~new | ~np.append(new[1:], True) if len(s) else new
    order, new = order[shared], new[shared]
    out = np.zeros(len(h), bool)
    if len(order):
        ids, _ = wd.word_ids(d, starts, ends)
        mine = where[order]
        lead = mine[np.flatnonzero(new)[np.cumsum(new) - 1]]  # the first window with this hash
        same = np.ones(len(order), bool)
        for j in range(window):
            same &= ids[mine + j] == ids[lead + j]
        if same.all():
            out[order] = True
        else:  # different words under one hash: group by the words
            kinds: dict[bytes, list[int]] = {}
            for w, a in zip(order.tolist(), mine.tolist(), strict=True):
                kinds.setdefault(ids[a : a + window].tobytes(), []).append(w)
            for group in kinds.values():
                out[group] = len(group) > 1
    return count, out


def _repeats(window: int):
    """At the task that owns their anchors: the positions of repeated windows, as bitmaps (null: all of the run)."""

    @trimmed
    def run(batches):
        sent = []
        for b in batches:
            waiting = b.column(5).is_valid()
            done = b.filter(b.column(5).is_null())
            if done.num_rows:
                yield pa.RecordBatch.from_arrays([*done.columns[1:4], pa.nulls(done.num_rows, pa.binary())], names=["text_key", "first", "n", "bits"])
            if done.num_rows < b.num_rows:
                sent.append(b.filter(waiting))
        if not sent:
            return
        t = pa.Table.from_batches(sent)
        coded = t.column(5).cast(pa.large_binary()).combine_chunks().dictionary_encode()
        kind = np.asarray(coded.indices)
        times = np.bincount(kind) + np.bincount(kind, weights=np.asarray(t.column(4).combine_chunks()).astype(np.int64))  # runs met again count twice
        data, offs = wd.text_buffer(coded.dictionary)
        count, hit = _equal_windows(data, offs, window)
        any_hit = np.bincount(np.repeat(np.arange(len(count)), count)[hit], minlength=len(count)) > 0
        packed = _packed(hit, count)
        out = [(key, first, n, None if times[c] > 1 else packed[c]) for key, first, n, c in zip(t.column(1).to_pylist(), t.column(2).to_pylist(), t.column(3).to_pylist(), kind.tolist(), strict=True) if key is not None and (times[c] > 1 or any_hit[c])]
        for a in range(0, len(out), 10_000):
            keys, firsts, ns, bitmaps = zip(*out[a : a + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(firsts, pa.int32()), pa.array(ns, pa.int32()), pa.array(bitmaps, pa.binary())], names=["text_key", "first", "n", "bits"])

    return run


def _strip(window: int):
    """Removes the covered words: counts, kept text and removed word ranges of each row."""

    @trimmed
    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            hits = b.column(2).to_pylist()
            n_words, n_removed, kept, spans = [], [], [], []
            for text, runs in zip(texts, hits, strict=True):
                words = (text or b"").split()
                n_words.append(len(words))
                ranges = []
                if runs:
                    edge = np.zeros(len(words) + 1, np.int32)
                    for r in runs:
                        at = r["first"] + (np.arange(r["n"]) if r["bits"] is None else np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8))[: r["n"]]))
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + window, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    ranges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).reshape(-1, 2).tolist()
                    words = [words[i] for i in np.flatnonzero(~gone)]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
                spans.append(ranges)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int32())))],
                names=["row", "n_words", "n_removed", "kept_text", "removed"],
            )

    return run


def remove_repeats(docs: DataFrame, keep: list[Column], text_col: str = "text", window: int = WINDOW, k: int = ANCHOR, max_cells: int = MAX_CELLS) -> DataFrame:
    """``row`` (struct of the ``keep`` columns), n_words, n_removed, kept_text and removed (word ranges) of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.col(text_col).alias("text")
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    expected = size / 6 * 2 / (window - k + 2)  # words, and the share of positions that are anchors
    cells = 1 << min(max(math.ceil(math.log2(expected * 8 + 1)), int(math.log2(MIN_CELLS))), int(math.log2(max_cells)))

    rows = docs.select(F.struct(*keep).alias("row"), text, F.substring(F.unhex(F.sha2(text_col, 256)), 1, 16).alias("text_key"))
    long_enough = rows.where(F.length("text") >= 2 * window - 1).select("text", "text_key")
    merged = long_enough.select("text").mapInArrow(_sketch(window, k, cells), "shard int, cells binary, twice binary").groupBy("shard").applyInPandas(_merge(cells), "shard int, bits binary")
    sketch = np.zeros(DEPTH * cells >> 3, np.uint8)
    part = cells // SHARDS >> 3
    for r in merged.toLocalIterator():  # DEPTH * cells / 8 bytes in all
        sketch[r["shard"] * part : (r["shard"] + 1) * part] = np.frombuffer(r["bits"], np.uint8)
    bits = spark.sparkContext.broadcast(sketch)

    runs = long_enough.mapInArrow(_suspects(window, k, cells, bits), _RUN_SQL)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / TASK_BYTES))
    found = runs.repartition(parts, "owner").mapInArrow(_repeats(window), "text_key binary, first int, n int, bits binary")
    hits = cut(found.distinct().groupBy("text_key").agg(F.collect_list(F.struct("first", "n", "bits")).alias("hits")), "hits")  # one text's runs
    bits.destroy()
    return _joined(rows, hits).mapInArrow(_strip(window), f"row {rows.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept_text string, removed array<array<int>>")


def _joined(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """row, text and hits of every row; only texts that a filter of the hit ones lets through are shuffled."""
    keys = bloom(hits.select(F.conv(F.hex(F.substring("text_key", 1, 7)), 16, 10).cast("long")), hits.count(), each=8, most=FILTER_BITS)

    def sifted(pick: bool):
        @trimmed
        def run(batches):
            for b in batches:
                raw = b.column(2).fill_null(bytes(16)).cast(pa.binary())
                first = np.frombuffer(b"".join(x[6::-1] + b"\0" for x in raw.to_pylist()), "<u8")
                yield b.filter(pa.array(may_hold(keys.value, first) == pick))

        return rows.mapInArrow(run, rows.schema)

    touched = sifted(True).join(hits.hint("merge"), "text_key", "left").select("row", "text", "hits")
    return touched.union(sifted(False).select("row", "text", F.lit(None).cast(hits.schema["hits"].dataType).alias("hits")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), [F.col("doc_id")])
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT rid, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS s FROM d, unnest(generate_series(1, len(w) - {WINDOW - 1})) t(i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY s) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT rid, unnest(generate_series(i, i + {WINDOW - 1})) AS p FROM rep),
lists AS (SELECT rid, list(p) AS ps FROM gone GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_select(w, list_filter(generate_series(1, len(w)), lambda p: NOT list_contains(coalesce(ps, []), p))), ' ')) AS kept_sha256
FROM d LEFT JOIN lists USING (rid)
"""

QUERIES = {"op6_substring_dedup": op6_substring_dedup}
ORACLE = {"op6_substring_dedup": OP6_SQL}
