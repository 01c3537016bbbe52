"""URL filter: ratio of two character language models, under explicit host/path rules.

A rule ("allow"/"block", host + path prefix) that fits a URL decides; the longest
fitting rule wins (ties: the greatest rule string).  Other URLs are judged by the
method: two variable-order Markov models of the lower-cased host and path, one
trained on accepted and one on rejected URLs, each interpolating orders 0 to
ORDER by Witten-Bell smoothing; the score is the log-likelihood difference
divided by the length.  The threshold is calibrated on a fold of labelled URLs with
a model that has not seen them; the final model counts every labelled URL.

Counts are kept by exact context, for those contexts that occur: a task sums its
URLs by (order, context, symbol) and emits the cells, which are summed by key, so
the models grow with the distinct contexts of the corpus and no two share a cell.
A cell takes 16 bytes on the driver and in a worker; nothing is hashed or left out.

Labels are the caller's (a boolean column expression; null: unlabelled).  Without them the
URLs that a rule decides are the labels, allowed ones as accepted and blocked ones as rejected, and the
models carry the rules over to the hosts and paths that no rule names.

Null URL, or one without "://": host and path are empty, no rule fits, and the
verdict is "allow" for want of evidence.  If one class has no URL the method
accepts everything; if the calibration fold lacks one, the threshold is 0.  A score equal to the threshold is allowed.  Repeated rows get repeated verdicts; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _words as wd
from ._spark import small_batches, table, trimmed

ORDER = 4
SYMBOLS = 64
#: Cells that a task sums before it emits them.
FLUSH = 2_000_000
BINS = 4000
FOLDS = 5

Rules = list[tuple[str, str]]
RULES: Rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]

_ORDER_BIT = 6 * ORDER
_CODE = np.full(256, 1, dtype=np.int64)  # other bytes
for _i, _c in enumerate(b"abcdefghijklmnopqrstuvwxyz0123456789-._~/%+=,;:@!$'()*"):
    _CODE[_c] = _i + 2
_CODE[0x41:0x5B] = _CODE[0x61:0x7B]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: Rules) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1]), reverse=True):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        out = out.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
    return out if isinstance(out, Column) else F.lit(None).cast("struct<rule:string,verdict:string>")


def _contexts(codes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """For each order, the context of every character, with the order above its bits; code 0 pads before a text."""
    out, ctx = [], np.zeros(len(codes), dtype=np.int64)
    prev = codes
    begun = np.zeros(len(codes), dtype=np.int64)
    begun[first[first < len(codes)]] = 1
    at = np.arange(len(codes)) - np.maximum.accumulate(np.where(begun, np.arange(len(codes)), 0))
    for k in range(ORDER + 1):
        if k:
            prev = np.concatenate([[0], prev[:-1]])
            ctx = ctx * SYMBOLS + np.where(at >= k, prev, 0)
        out.append(ctx + (k << _ORDER_BIT))
    return out


def _codes(col: pa.Array):
    data, offs = wd.text_buffer(col)
    return _CODE[data[offs[0] : offs[-1]]], offs - offs[0]


@trimmed
def _count(batches):
    """Sums of cells: context * SYMBOLS + symbol, by label."""

    def summed(parts):
        cell, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        return cell, np.bincount(at, weights=np.concatenate([n for _, n in parts]), minlength=len(cell)).astype(np.int64)

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array((held[0] & 1).astype(np.int32)), pa.array(held[0] >> 1), pa.array(held[1])], names=["label", "cell", "n"])

    parts = []
    for b in batches:
        codes, offs = _codes(b.column(0))
        if not len(codes):
            continue
        label = np.repeat(np.asarray(b.column(1)).astype(np.int64), np.diff(offs))
        cell = np.concatenate([(ctx * SYMBOLS + codes) * 2 + label for ctx in _contexts(codes, offs[:-1])])
        parts.append(np.unique(cell, return_counts=True))
        if sum(len(c) for c, _ in parts) > FLUSH:
            parts = [summed(parts)]
            if len(parts[0][0]) > FLUSH // 2:
                yield batch(parts[0])
                parts = []
    if parts:
        yield batch(summed(parts))


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    """Values of sorted keys; each distinct key is searched once."""
    if not len(keys):
        return np.full(len(wanted), default)
    distinct, back = np.unique(wanted, return_inverse=True)
    at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
    return np.where(keys[at] == distinct, values[at], default)[back]


class UrlModel:
    """Both Markov models as sorted tables of what occurs: P_k = own[ctx, symbol] + back[ctx] * P_(k-1)."""

    def __init__(self, cells: list[tuple[np.ndarray, np.ndarray]]):
        """``cells``: for each label its cells and their counts."""
        self.known = all(len(cell) for cell, _ in cells)
        self.tables = []
        for cell, n in cells:
            order = np.argsort(cell)
            cell, n = cell[order], n[order].astype(np.float64)
            ctx = cell // SYMBOLS
            first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(ctx) else np.zeros(0, np.int64)
            kinds = np.diff(np.append(first, len(ctx)))
            whole = (np.add.reduceat(n, first) if len(first) else np.zeros(0)) + kinds
            self.tables.append((cell, (n / np.repeat(whole, kinds)).astype(np.float32), ctx[first], (kinds / whole).astype(np.float32)))
        self.threshold = 0.0

    def score(self, col: pa.Array) -> np.ndarray:
        """Accepted minus rejected log-likelihood per character; 0 for an empty text."""
        codes, offs = _codes(col)
        contexts = _contexts(codes, offs[:-1])
        logs = []
        for cells, own, known, back in self.tables:
            p = np.full(len(codes), 1 / SYMBOLS)
            for ctx in contexts:
                p = _look_up(cells, own, ctx * SYMBOLS + codes, 0.0) + _look_up(known, back, ctx, 1.0) * p
            logs.append(np.log(p))
        total = np.concatenate([[0.0], np.cumsum(logs[1] - logs[0])])
        return (total[offs[1:]] - total[offs[:-1]]) / np.maximum(np.diff(offs), 1)


def train(urls: DataFrame, text: str, accepted: str) -> UrlModel:
    """``urls``: column ``text`` and boolean ``accepted`` (null rows are ignored)."""
    small_batches(urls.sparkSession)
    known = urls.where(F.col(accepted).isNotNull()).select(F.col(text).alias("t"), F.col(accepted).cast("int").alias("label"), F.pmod(F.xxhash64(text), F.lit(FOLDS)).alias("fold"))
    def fit(rows):
        cells = rows.select("t", "label").mapInArrow(_count, "label int, cell long, n long").groupBy("label", "cell").agg(F.sum("n").alias("n")).toArrow()
        label, cell, n = (cells.column(c).to_numpy() for c in ("label", "cell", "n"))
        return UrlModel([(cell[label == c], n[label == c]) for c in (0, 1)])

    final, model = fit(known), fit(known.where("fold <> 0"))
    if not model.known:  # nothing to calibrate with
        return final

    @trimmed
    def bins(batches):
        for b in batches:
            at = np.clip(np.round(model.score(b.column(0)) * 100), -BINS // 2, BINS // 2).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(at)], names=["label", "bin"])

    held = np.zeros((2, BINS + 1))  # scores of held-out URLs by label
    for r in known.where("fold = 0").select("t", "label").mapInArrow(bins, "label int, bin int").groupBy("label", "bin").count().collect():
        held[r["label"], r["bin"] + BINS // 2] = r["count"]
    if held.sum(1).all():
        share = held / held.sum(1, keepdims=True)
        lost, passed = np.cumsum(share[1]), np.cumsum(share[0][::-1])[::-1]
        cost = np.concatenate([[1.0], lost]) + np.concatenate([passed, [0.0]])  # error rates of both kinds if bins below i are rejected
        best = np.flatnonzero(cost <= cost.min() + 1e-12)
        final.threshold = (float(best[len(best) // 2]) - BINS // 2 - 0.5) / 100
    return final


def filter_urls(pages: DataFrame, rules: Rules, accepted: Column | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, lm_score for every row; ``accepted`` labels URLs by ``host``, ``path`` for training (by default the rules do)."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.select("id", "host", "path", F.concat("host", "path").alias("text"))
    ruled = match_rule(F.col("host"), F.col("path"), rules)
    label = ruled["verdict"] == "allow" if accepted is None else accepted
    model = train(rows.select("text", F.when(F.col("text") != "", label).alias("accepted")), "text", "accepted")

    @trimmed
    def judge(batches):
        for b in batches:
            score = model.score(b.column(3)) if model.known else np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(score, pa.float64())], names=["id", "host", "path", "lm_score"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(judge, f"id {kind}, host string, path string, lm_score double").select("*", ruled.alias("ruled"))
    method = F.when((F.col("host") == "") & (F.col("path") == "") | ~F.lit(model.known), "allow").when(F.col("lm_score") >= model.threshold, "allow").otherwise("block")
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("ruled.rule").alias("rule"), F.coalesce("ruled.verdict", method).alias("verdict"), "lm_score")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


QUERIES = {"op1_url_filter": op1_url_filter}
ORACLE: dict = {}
