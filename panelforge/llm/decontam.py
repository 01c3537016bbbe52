"""Benchmark decontamination by winnowing.

Of every window of ``window - k + 1`` consecutive k-grams of words, the one with
the smallest hash is kept as a fingerprint, for benchmark items and documents
alike.  A span of ``window`` shared words therefore shares a fingerprint.  Equal
fingerprints are joined and each hit is extended, word by word, to the
shared run; runs of at least ``window`` words count.  An item of fewer words,
but not none, is one window as a whole and is looked up by the hash of its words.
A hit counts only if the words themselves are equal, not just their hashes.

* A benchmark of up to ``INDEX_BYTES`` goes to the workers as one index, and all documents pass it in
  one stage without a shuffle.
* A larger one is joined by shuffle: both sides send their fingerprints with the few words around
  them that a window can reach, the documents only those that a Bloom filter of the benchmark's
  fingerprints (``FILTER_BITS`` at most) lets through.  What is found returns to the documents by text, so a
  group of copies is joined about once.  Spans of the same item that overlap are merged.

Both give the same words and items.  Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  Null and empty
texts have no words and are never hit; items without words hit nothing; a null
item id counts as the empty string; repeated rows get repeated results; an empty
benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _words as wd
from ._filter import FILTER_BITS, bloom, may_hold
from ._spark import cut, discard, fitting, small_batches, table, trimmed

WINDOW, K = 10, 5
#: Bytes of benchmark text that every worker may hold as an index.
INDEX_BYTES = 8 << 20
_POS = np.uint64((1 << 24) - 1)


def _selected(g: np.ndarray, windows_at: np.ndarray, w: int) -> np.ndarray:
    """Positions of the fingerprints of the windows of ``w`` k-grams that begin at ``windows_at``."""
    picked = []
    for a in range(0, len(g), 1 << 23):  # positions share the key with 40 bits of the hash
        part = g[a : a + (1 << 23) + w - 1]
        key = (part & ~_POS) | np.arange(len(part), dtype=np.uint64)
        low = wd.sliding_min(key, w)
        at = windows_at[(windows_at >= a) & (windows_at < a + (1 << 23))] - a
        picked.append((low[at] & _POS).astype(np.int64) + a)
    return np.unique(np.concatenate(picked)) if picked else np.zeros(0, np.int64)


class Texts:
    """Words of some texts: their hashes, where each text begins, and on demand the words themselves."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self._d, self._starts, self._ends, self.at = wd.split(data, offs, wd.ALNUM)
        self.h = wd.word_hashes(self._d, self._starts, self._ends, wd.LOWER)
        self._plain = None

    def words(self, a: int, z: int) -> bytes:
        """Words a to z - 1 of one text, lower-cased, with one blank between."""
        if self._plain is None:
            out, begin, end = wd.plain(self._d, self._starts, self._ends, wd.ALNUM, wd.LOWER)
            self._plain = out.tobytes(), begin, end
        out, begin, end = self._plain
        return out[begin[a] : end[z - 1]] if z > a else b""


def _same_run(x: list[bytes], y: list[bytes], left: int) -> tuple[int, int]:
    """How far ``x`` and ``y`` agree before and from position ``left``."""
    same = [a == b for a, b in zip(x, y, strict=True)]
    before = next((k for k in range(left) if not same[left - 1 - k]), left)
    after = next((k for k in range(len(same) - left) if not same[left + k]), len(same) - left)
    return before, after


class Index:
    """Index of some benchmark items."""

    def __init__(self, ids: list[str], texts: list[str], window: int = WINDOW, k: int = K):
        self.window, self.k, self.ids = window, k, ids
        self.texts = Texts(*wd.text_buffer(pa.array(texts, pa.string())))
        self.at = at = self.texts.at
        g = wd.grams(self.texts.h, k)
        pos = _selected(g, wd.gram_rows(at, window)[1], window - k + 1)
        order = np.argsort(g[pos], kind="stable")
        self.pos, self.prints = pos[order], g[pos][order]
        self.item_of = np.repeat(np.arange(len(ids)), np.diff(at))
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes = np.diff(at)
        for n in range(1, window):
            items = np.flatnonzero(sizes == n)
            if len(items):
                h = wd.grams(self.texts.h, n)[at[:-1][items]]
                o = np.argsort(h, kind="stable")
                self.short[n] = h[o], items[o]

    def find(self, texts: Texts):
        """(row, first word, end, item index) of every maximal shared run of the rows of ``texts``."""
        out, h, at, own = [], texts.h, texts.at, self.texts
        rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
        if len(self.prints) and len(h) >= self.window:
            g = wd.grams(h, self.k)
            pos = _selected(g, wd.gram_rows(at, self.window)[1], self.window - self.k + 1)
            a = np.searchsorted(self.prints, g[pos], "left")
            z = np.searchsorted(self.prints, g[pos], "right")
            seen: dict[int, int] = {}
            for i in np.flatnonzero(z > a):
                p = int(pos[i])
                row = int(rows[p])
                c, e = int(at[row]), int(at[row + 1])
                for q in self.pos[a[i] : z[i]].tolist():
                    if seen.get(p - q, -1) > p:  # inside a run found on this diagonal
                        continue
                    item = int(self.item_of[q])
                    b, f = int(self.at[item]), int(self.at[item + 1])
                    left, right = min(p - c, q - b), min(e - p, f - q)
                    off = np.flatnonzero(h[p - left : p] != own.h[q - left : q])
                    left = left - int(off[-1]) - 1 if len(off) else left
                    off = np.flatnonzero(h[p : p + right] != own.h[q : q + right])
                    right = int(off[0]) if len(off) else right
                    if left + right >= self.window:
                        x, y = texts.words(p - left, p + right), own.words(q - left, q + right)
                        if x != y:  # words of one hash
                            left, right = _same_run(x.split(b" "), y.split(b" "), left)
                            if left + right < self.window:
                                continue
                        seen[p - q] = p + right
                        out.append((row, p - left, p + right, item))
        for n, (prints, items) in self.short.items():
            pos = wd.gram_rows(at, n)[1]
            if not len(pos):
                continue
            g = wd.grams(h, n)[pos]
            a, z = np.searchsorted(prints, g, "left"), np.searchsorted(prints, g, "right")
            for i in np.flatnonzero(z > a):
                p = int(pos[i])
                words = texts.words(p, p + n)
                out += [(int(rows[p]), p, p + n, int(x)) for x in items[a[i] : z[i]] if own.words(int(self.at[x]), int(self.at[x]) + n) == words]
        return out


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("item", pa.string())]))


def _judge(index: Index):
    """Spans of each row, with counts of words and hits."""

    @trimmed
    def run(batches):
        for b in batches:
            data, offs = wd.text_buffer(b.column(1))
            spans: list[list[dict]] = [[] for _ in range(b.num_rows)]
            n_words = np.zeros(len(spans), np.int64)
            for i, j in wd.chunks(offs):
                texts = Texts(data, offs[i : j + 1])
                n_words[i:j] = np.diff(texts.at)
                for row, p, e, item in index.find(texts):
                    first = int(texts.at[row])
                    spans[i + row].append({"start": p - first, "end": e - first, "item": index.ids[item]})
            yield _result(b.column(0), spans, n_words)

    return run


def _result(rows: pa.Array, spans: list[list[dict]], n_words: np.ndarray) -> pa.RecordBatch:
    n_hit = np.array([_covered(int(n), s) if s else 0 for n, s in zip(n_words, spans, strict=True)], np.int64)
    return pa.RecordBatch.from_arrays([rows, pa.array(spans, _SPANS), pa.array(n_words), pa.array(n_hit)], names=["row", "spans", "n_words", "n_hit"])


def _covered(n: int, spans: list[dict]) -> int:
    """Words inside any of the spans of a text of ``n`` words."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, [s["start"] for s in spans], 1)
    np.add.at(edge, [s["end"] for s in spans], -1)
    return int((np.cumsum(edge) > 0).sum())


def _contexts(window: int, k: int, lengths: tuple[int, ...] | None, bits=None):
    """Fingerprints of texts with the words that a window around them can reach.

    ``lengths``: the lengths below ``window`` that whole items have, whose grams documents look up; None for
    items, of which one of such a length gives its words as a whole.  ``bits``: a Bloom filter of the fingerprints wanted.
    """
    reach = window - k

    def wanted(prints):
        return np.arange(len(prints)) if bits is None else np.flatnonzero(may_hold(bits.value, prints))

    @trimmed
    def run(batches):
        met: set = set()
        for b in batches:
            data, offs = wd.text_buffer(b.column(1))
            keys = b.column(0).to_pylist()
            rows = []
            for i, j in wd.chunks(offs):
                t = Texts(data, offs[i : j + 1])
                at = t.at
                row_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
                g = wd.grams(t.h, k)
                pos = _selected(g, wd.gram_rows(at, window)[1], reach + 1)
                found = [(0, pos[x], g[pos[x]]) for x in (wanted(g[pos]),)]
                for n in range(1, window) if lengths is None else lengths:
                    p = at[:-1][np.diff(at) == n] if lengths is None else wd.gram_rows(at, n)[1]
                    if len(p):
                        h = wd.mix64(wd.grams(t.h, n)[p] + np.uint64(n))
                        x = wanted(h)
                        found.append((n, p[x], h[x]))
                new = {r for r in range(j - i) if lengths is None or keys[i + r] not in met}
                for n, ps, prints in found:
                    for p, r, x in zip(ps.tolist(), row_of[ps].tolist(), prints.view(np.int64).tolist(), strict=True):
                        if r in new:
                            c, e = (p, p + n) if n else (max(p - reach, int(at[r])), min(p + window, int(at[r + 1])))
                            rows.append((x, keys[i + r], p - int(at[r]), p - c, n, t.words(c, e)))
                if lengths is not None:
                    met.update(keys[i:j])
                    if len(met) > 200_000:
                        met.clear()
            kinds = (pa.int64(), b.column(0).type, pa.int32(), pa.int32(), pa.int32(), pa.binary())
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["print", "of", "pos", "before", "whole", "words"])

    return run


def _extend(window: int):
    """From joined fingerprints: the spans of texts whose words agree with the item's."""

    @trimmed
    def run(batches):
        for b in batches:
            out = []
            for key, pos, before, whole, words, item, item_before, item_words in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if whole:
                    if words == item_words:
                        out.append((key, pos, pos + whole, item))
                    continue
                x, y = words.split(b" "), item_words.split(b" ")
                left, right = min(before, item_before), min(len(x) - before, len(y) - item_before)
                left, right = _same_run(x[before - left : before + right], y[item_before - left : item_before + right], left)
                if left + right >= window:
                    out.append((key, pos - left, pos + right, item))
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.binary(), pa.int32(), pa.int32(), pa.string()), strict=True)], names=["text_key", "start", "end", "item"])

    return run


@trimmed
def _counted(batches):
    for b in batches:
        data, offs = wd.text_buffer(b.column(1))
        n_words = np.concatenate([np.diff(wd.split(data, offs[i : j + 1], wd.ALNUM)[3]) for i, j in wd.chunks(offs)]) if b.num_rows else np.zeros(0, np.int64)
        yield _result(b.column(0), [_merged(s or []) for s in b.column(2).to_pylist()], n_words)


def _merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["item"], s["start"], s["end"])):
        if out and out[-1]["item"] == s["item"] and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return out


_PRINTS = "print long, of {}, pos int, before int, whole int, words binary"
_SPANS_SQL = "array<struct<start:int,end:int,item:string>>"


def _joined(found: DataFrame, items: DataFrame, window: int, k: int) -> DataFrame:
    """row, text and spans of every row of ``found`` (row, text) by a join of fingerprints."""
    spark = found.sparkSession
    prints = cut(items.select("id", "text").mapInArrow(_contexts(window, k, None), _PRINTS.format("string")), "prints")
    lengths = tuple(sorted(r[0] for r in prints.where("whole > 0").select("whole").distinct().collect()))  # below ``window``
    n = prints.count()
    bits = bloom(prints.select("print"), n, most=FILTER_BITS)
    keyed = found.select("row", "text", F.substring(F.unhex(F.sha2("text", 256)), 1, 16).alias("text_key"))
    own = keyed.where("text_key IS NOT NULL").select("text_key", "text").mapInArrow(_contexts(window, k, lengths, bits), _PRINTS.format("binary"))
    own = own.select("print", F.col("of").alias("text_key"), "pos", "before", "whole", "words")
    theirs = fitting(prints.select("print", F.col("of").alias("item"), F.col("before").alias("item_before"), F.col("whole").alias("item_whole"), F.col("words").alias("item_words")), n, 200)
    pairs = own.join(theirs, "print").where("whole = item_whole").select("text_key", "pos", "before", "whole", "words", "item", "item_before", "item_words")
    hits = pairs.mapInArrow(_extend(window), "text_key binary, start int, end int, item string").distinct()
    hits = cut(hits.groupBy("text_key").agg(F.collect_list(F.struct("start", "end", "item")).alias("spans")), "hits")
    bits.destroy()
    discard(prints)
    size = hits.agg(F.sum(F.size("spans") * 32 + 64)).first()[0] or 0
    return keyed.join(fitting(hits, size, 1), "text_key", "left").select("row", "text", "spans")


def _scan(docs: DataFrame, row: Column, text_col: str, benchmark: DataFrame, item_col: str, item_text: str, window: int, k: int) -> DataFrame:
    small_batches(docs.sparkSession)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), F.coalesce(item_text, F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    found = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    kind = f"row {found.schema['row'].dataType.simpleString()}, spans {_SPANS_SQL}, n_words long, n_hit long"
    if size > INDEX_BYTES:
        return _joined(found, items, window, k).mapInArrow(_counted, kind)
    own = items.collect()  # INDEX_BYTES at most
    return found.mapInArrow(_judge(Index([r["id"] for r in own], [r["text"] for r in own], window, k)), kind)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """id, n_words, n_hit (words inside a shared window), spans (word ranges and items), items (sorted, distinct)."""
    out = _scan(docs, F.struct(F.col(id_col).alias("id")), text_col, benchmark, item_col, item_text, window, k)
    return out.select(F.col("row.id").alias(id_col), "n_words", "n_hit", "spans", F.sort_array(F.array_distinct("spans.item")).alias("items"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """The rows of ``docs``, with all their columns, that share no window with the benchmark."""
    out = _scan(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), text_col, benchmark, item_col, item_text, window, k)
    return out.where("n_hit = 0").select("row.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP8_SQL = f"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
iw AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
iwin AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
         FROM iw, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iwin),
dwin AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM dw, sizes, unnest(generate_series(1, len(w) - n + 1)) t(i)),
hits AS (SELECT rid, i, n, item_id FROM dwin JOIN iwin USING (n, s)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

QUERIES = {"op8_decontamination": op8_decontamination}
ORACLE = {"op8_decontamination": OP8_SQL}
