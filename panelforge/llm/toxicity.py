"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w . x - t_k): one weight vector shared by all ordered
thresholds t_0 < t_1 < ...; x are presence flags of words and of their beginnings, and weights are not
negative, so harmless text cannot outweigh an insult.  The output is the
expected severity, the sum of P(grade > k) over k, and a decision against a
threshold between 0.5 and 0.75 chosen on out-of-fold scores of the labelled rows.

The fit uses at most ``MAX_TRAIN`` distinct labelled rows (those whose id and text hash lowest) and
the ``MAX_FEATURES`` words most associated with the higher grades; word counts for that
choice are made on the workers, so the driver sees at most MAX_TRAIN rows of
MAX_FEATURES flags.  Scoring covers every row and whole texts in one pass
without a shuffle.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  Null and empty
texts have no features and get the severity of the thresholds alone; labels that
are null or whose id is not in the table are ignored; with fewer than two grades
among the labels every severity is 0 and nothing is rejected.  Repeated rows get
repeated results, and count once for the fit; of several grades for one id all count; ties of scores fall on one
side of the threshold together (a severity equal to it is kept); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _words as wd
from ._spark import cut, discard, small_batches, table, trimmed

MAX_TRAIN, MAX_FEATURES, MIN_ROWS = 20_000, 2048, 2
#: Lengths in bytes of word beginnings that are features beside the words, so that inflected forms share evidence.
PREFIXES = (4, 5, 7)
#: L1 penalty in rows: a word needs about so many rows that other words do not explain.
PENALTY, STEPS = 2.0, 300
#: L1 penalty of the second fit, over the words that the first one kept.
REFIT_PENALTY = 0.05


def _row_words(col: pa.Array):
    """For chunks of rows: first row, row of each feature (words and their beginnings) and its hash."""
    data, offs = wd.text_buffer(col)
    for i, j in wd.chunks(offs):
        d, starts, ends, at = wd.split(data, offs[i : j + 1], wd.ALNUM)
        row = np.repeat(np.arange(j - i), np.diff(at))
        rows, hashes = [row], [wd.word_hashes(d, starts, ends, wd.LOWER)]
        for n in PREFIXES:
            long = ends - starts > n
            rows.append(row[long])
            hashes.append(wd.word_hashes(d, starts[long], starts[long] + n, wd.LOWER) ^ np.uint64(n))
        yield i, np.concatenate(rows), np.concatenate(hashes)


@trimmed
def _presence(batches):
    """Rows that hold each word, by grade; summed inside the task first."""
    keys, counts = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
    for b in batches:
        high = np.asarray(b.column(1)).astype(np.int64) > 0
        for i, row, h in _row_words(b.column(0)):
            o = np.lexsort((row, h))
            h, row = h[o], row[o]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            h, up = h[new], high[i + row[new]]
            keys, inverse = np.unique(np.concatenate([keys, h]), return_inverse=True)
            n = len(counts)
            merged = np.zeros((len(keys), 2), np.int64)
            merged[inverse[:n]] = counts
            np.add.at(merged, (inverse[n:], up.astype(np.int64)), 1)
            counts = merged
    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts[:, 0]), pa.array(counts[:, 1])], names=["word", "low", "high"])


class Model:
    """``vocabulary``: sorted hashes; ``weights``; ``thresholds``; ``reject_at``."""

    def __init__(self, vocabulary: np.ndarray, grades: int):
        self.vocabulary, self.grades = vocabulary, grades
        self.weights, self.thresholds, self.reject_at = np.zeros(len(vocabulary)), np.zeros(max(grades - 1, 0)), np.inf

    def flags(self, col: pa.Array):
        """Distinct (row, feature) pairs."""
        rows, feats = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        v = len(self.vocabulary)
        for i, row, h in _row_words(col):
            if v and len(h):
                at = np.minimum(np.searchsorted(self.vocabulary, h), v - 1)
                hit = self.vocabulary[at] == h
                pair = np.unique(row[hit] * v + at[hit])
                rows.append(i + pair // v)
                feats.append(pair % v)
        return np.concatenate(rows), np.concatenate(feats)

    def above(self, rows: np.ndarray, feats: np.ndarray, n: int) -> np.ndarray:
        """P(grade > k) for each row and k."""
        z = np.bincount(rows, weights=self.weights[feats], minlength=n)[:n]
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -40, 40)))

    def fit(self, rows: np.ndarray, feats: np.ndarray, grade: np.ndarray) -> Model:
        """Selects words with PENALTY, then fits those alone with REFIT_PENALTY."""
        n, k = len(grade), self.grades - 1
        share = np.array([(grade > j).mean() for j in range(k)]).clip(1e-4, 1 - 1e-4)
        first = np.log((1 - share) / share)
        start = np.concatenate([np.zeros(len(self.vocabulary)), first[:1], np.log(np.maximum(np.diff(first), 0.05))])
        start = self._descend(start, rows, feats, grade, PENALTY / n, STEPS)
        kept = np.flatnonzero(start[: len(self.vocabulary)] > 0.05)
        index = np.full(len(self.vocabulary), -1)
        index[kept] = np.arange(len(kept))
        own = index[feats] >= 0
        p = self._descend(np.concatenate([start[kept], start[len(self.vocabulary) :]]), rows[own], index[feats[own]], grade, REFIT_PENALTY / n, 3 * STEPS)
        self.weights[:] = 0
        self.weights[kept] = p[: len(kept)]
        self.thresholds = np.cumsum(np.concatenate([p[len(kept) :][:1], np.exp(p[len(kept) + 1 :])]))
        return self

    def _descend(self, p: np.ndarray, rows: np.ndarray, feats: np.ndarray, grade: np.ndarray, penalty: float, steps: int) -> np.ndarray:
        """Penalised maximum likelihood by Adam, weights kept at or above 0; thresholds are a first one and positive steps."""
        n, k = len(grade), self.grades - 1
        v = len(p) - k
        m, s, pick = np.zeros_like(p), np.zeros_like(p), np.arange(n)
        for t in range(1, steps + 1):
            thr = np.cumsum(np.concatenate([p[v : v + 1], np.exp(p[v + 1 :])]))
            z = np.bincount(rows, weights=p[:v][feats], minlength=n)[:n]
            f = 1 / (1 + np.exp(np.clip(thr[None, :] - z[:, None], -40, 40)))
            full = np.concatenate([np.ones((n, 1)), f, np.zeros((n, 1))], axis=1)  # P(grade >= 0), P(> 0), ...
            slope = full * (1 - full)
            prob = np.maximum(full[pick, grade] - full[pick, grade + 1], 1e-12)
            dz = -(slope[pick, grade] - slope[pick, grade + 1]) / prob / n
            dthr = np.array([(np.where(grade == j + 1, slope[:, j + 1], 0) - np.where(grade == j, slope[:, j + 1], 0)).dot(1 / prob) / n for j in range(k)])
            back = np.cumsum(dthr[::-1])[::-1]
            g = np.concatenate([np.bincount(feats, weights=dz[rows], minlength=v) + penalty, back[:1], back[1:] * np.exp(p[v + 1 :])])
            m, s = 0.9 * m + 0.1 * g, 0.98 * s + 0.02 * g * g
            p = p - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.98**t)) + 1e-8)
            p[:v] = np.maximum(p[:v], 0)
        return p


def _cutoff(severity: np.ndarray, bad: np.ndarray) -> float:
    """The middle of the gap below the lowest score of the best F1."""
    order = np.argsort(-severity, kind="stable")
    s, hits = severity[order], np.cumsum(bad[order])
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + bad.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # no cut between ties
    best = int(np.flatnonzero(f1 >= f1.max() - 1e-12)[-1])
    return float(s[best] + s[best + 1]) / 2 if best + 1 < len(s) else float(s[best])


def train(docs: DataFrame, labels: DataFrame, grade: Column, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """``grade``: an integer expression over ``labels``, 0 for clean and larger for worse."""
    small_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), grade.cast("int").alias("grade")).where("id IS NOT NULL AND grade IS NOT NULL")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tk"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = known.join(texts.select("id", "tk"), "id").distinct()  # labels of other tables' documents, and repeated rows, take none of the bound
    some = known.orderBy(F.xxhash64("id", "tk"), "id", "tk", "grade").limit(MAX_TRAIN)
    rows = texts.join(F.broadcast(some), ["id", "tk"]).dropDuplicates(["id", "tk", "grade"])  # MAX_TRAIN rows of three numbers
    rows = cut(rows.select("id", "text", "grade"), "labelled")
    sizes = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}
    if len(sizes) < 2:
        discard(rows)
        return Model(np.zeros(0, np.uint64), 0)
    rank = {g: k for k, g in enumerate(sorted(sizes))}
    n_low = float(sizes[min(sizes)])
    n_high = float(sum(sizes.values())) - n_low

    def part(k, n, total):  # k * log(k / expected)
        return F.when(k > 0, k * F.log(k / (n * total))).otherwise(0.0)

    n = F.col("low") + F.col("high")
    p = n_high / (n_low + n_high)
    gain = part(F.col("low").cast("double"), n, F.lit(1 - p)) + part(F.col("high").cast("double"), n, F.lit(p))
    high = F.when(F.col("grade") > min(sizes), 1).otherwise(0)
    words = rows.select("text", high.alias("high")).mapInArrow(_presence, "word long, low long, high long").groupBy("word").agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
    best = words.where((n >= MIN_ROWS) & (F.col("high") > n * p)).select("word", gain.alias("gain")).orderBy(F.desc("gain"), "word").limit(MAX_FEATURES).collect()
    model = Model(np.sort(np.array([r["word"] for r in best], dtype=np.int64).view(np.uint64)), len(sizes))

    @trimmed
    def flagged(batches):
        for b in batches:
            r, f = model.flags(b.column(1))
            order = np.lexsort((f, r))
            r, f = r[order], f[order]
            cuts = np.searchsorted(r, np.arange(b.num_rows + 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([f[a:z].astype("<u2").tobytes() for a, z in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], names=["id", "grade", "flags"])

    got = sorted(rows.mapInArrow(flagged, f"id {rows.schema['id'].dataType.simpleString()}, grade int, flags binary").collect(), key=lambda r: (r["id"], r["grade"], bytes(r["flags"])))
    discard(rows)
    feats = [np.frombuffer(r["flags"], "<u2").astype(np.int64) for r in got]
    at, feats = np.repeat(np.arange(len(got)), [len(f) for f in feats]), np.concatenate(feats)
    y = np.array([rank[r["grade"]] for r in got])
    severity = np.zeros(len(got))
    for fold in (0, 1):  # out-of-fold scores for the decision
        out = np.arange(len(got)) % 2 == fold
        if len(np.unique(y[~out])) < 2:
            continue
        own = ~out[at]
        index = np.cumsum(~out) - 1
        half = Model(model.vocabulary, model.grades).fit(index[at[own]], feats[own], y[~out])
        severity[out] = half.above(at, feats, len(got)).sum(1)[out]
    model.fit(at, feats, y)
    model.reject_at = min(max(_cutoff(severity, y > 0), 0.5), 0.75)
    return model


def score(docs: DataFrame, model: Model, keep: list[Column], text_col: str = "text") -> DataFrame:
    """struct ``row`` of the ``keep`` columns, severity, p_above (P(grade > k) for each k) and rejected."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text"))

    @trimmed
    def run(batches):
        for b in batches:
            above = model.above(*model.flags(b.column(1)), b.num_rows)
            severity = above.sum(1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(severity), pa.array(list(above), pa.list_(pa.float64())), pa.array(severity > model.reject_at)], names=["row", "severity", "p_above", "rejected"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, severity double, p_above array<double>, rejected boolean")


def severity_grade() -> Column:
    """Grade of a row of ``labels``: 0 not toxic, 1 toxic.  The model takes any number of grades, see ``three_grades``."""
    return F.when(F.col("toxic").isin(0, 1), F.col("toxic"))


def three_grades() -> Column:
    """0 not toxic; 1 toxic in a text of quality; 2 toxic in one without (or of unknown quality)."""
    return F.when(F.col("toxic") == 0, 0).when(F.col("toxic") == 1, F.when(F.col("quality") == 1, 1).otherwise(2))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not rejected."""
    model = train(docs, labels, severity_grade(), id_col, text_col)
    return score(docs, model, [F.col(f"`{c}`") for c in docs.columns], text_col).where("NOT rejected").select("row.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), severity_grade())
    return score(docs, model, [F.col("doc_id")]).select("row.doc_id", "severity", "p_above", "rejected")


QUERIES = {"op7_toxicity": op7_toxicity}
ORACLE: dict = {}
