"""Language ID: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased; everything that is not a letter becomes one blank,
so numbers, punctuation and layout carry no language.  N-grams of 1 to 3
characters are hashed into ``BUCKETS``; a text's score for a language is the sum of
the smoothed log-probabilities of all its n-grams plus the log prior.  The matrix
(languages x buckets, ``MAX_CELLS`` at most: with over 512 languages buckets are merged in pairs until it fits) is sent to the workers, which score
batches of whole texts as sparse sums in numpy.

Training counts every n-gram of all labelled texts given: tasks emit their
non-zero (language, bucket) cells and a native sum merges them and the buckets, so what reaches
the driver is at most ``MAX_CELLS`` cells.

A null text, or one without a letter, is ``und`` with score 0; without training
rows every text is.  Ties go to the smallest language name.  Repeated rows get
repeated results, and an empty table an empty result.  Labels, sources and ids
are never inputs of a prediction.  Marks that are no letters, as vowel signs of Indic scripts, count as blanks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import cut, discard, small_batches, table, trimmed

BUCKETS = 1 << 15
#: Cells of the matrix (4 bytes each), at most, and the fewest buckets.
MAX_CELLS, MIN_BUCKETS = 1 << 24, 1 << 6
#: Languages that a task counts at a time.
HELD_LANGS = 256
#: Weight of a count that no text has, for smoothing.
ALPHA = 0.5
_END = 0xFFFF


class _Letters:
    """A flag for each code point of the basic plane, made once in each worker."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            flags = np.zeros(0x10000, dtype=bool)
            flags[:0xD800] = [chr(c).isalpha() for c in range(0xD800)]
            flags[0xE000:] = [chr(c).isalpha() for c in range(0xE000, 0x10000)]
            cls.table = flags
        return cls.table


def _grams(texts: list[str]):
    """Buckets of all n-grams of the texts, and for each n-gram its text's index; letters as found by str.isalpha."""
    joined = "￿".join(t.replace("￿", " ") if "￿" in t else t for t in texts)
    x = np.frombuffer(joined.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = x == _END
    letter = np.ones(len(x), dtype=bool)
    low = x < 0x10000
    letter[low] = _Letters.get()[x[low]]
    c = np.where(letter, x, np.uint32(32))
    keep = letter.copy()  # the first of a row of blanks stays
    keep[1:] |= letter[:-1]
    keep |= ends
    c, ends = c[keep], ends[keep]
    row = np.cumsum(ends) - ends
    one = c * np.uint32(0x9E3779B1)
    two = one[1:] ^ (c[:-1] * np.uint32(0x85EBCA77))
    three = two[1:] ^ (c[:-2] * np.uint32(0xC2B2AE3D))
    out = []
    for n, h in ((1, one), (2, two), (3, three)):
        h = h + np.uint32(n * 0x27D4EB2F)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        inside = ~ends[: len(h)]
        for k in range(1, n):
            inside &= ~ends[k : k + len(h)]
        out.append(((h & np.uint32(BUCKETS - 1)).astype(np.int32), row[: len(h)], inside))
    return out


def _blocks(texts: list[str | None], most: int = 1 << 20):
    """Ranges of texts of about ``most`` characters together."""
    i = size = 0
    for j, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield i, j + 1
            i, size = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


@trimmed
def _count(batches):
    totals: dict[str, np.ndarray] = {}
    n_texts: dict[str, int] = {}

    def flush():
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(counts[at], n_texts[lang]))], names=["lang", "bucket", "n"])
        totals.clear()
        n_texts.clear()

    for b in batches:
        langs = np.asarray(b.column(0).to_pylist(), dtype=object)
        texts = b.column(1).to_pylist()
        for lang in sorted(set(langs.tolist())):
            if lang not in totals and len(totals) >= HELD_LANGS:
                yield from flush()
            own = [texts[i] for i in np.flatnonzero(langs == lang)]
            n_texts[lang] = n_texts.get(lang, 0) + len(own)
            into = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            for i, j in _blocks(own):
                for h, _, inside in _grams(own[i:j]):
                    into += np.bincount(h[inside], minlength=BUCKETS)
    yield from flush()


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray, texts: np.ndarray):
        self.langs, self.mask = langs, np.int32(counts.shape[1] - 1)
        c = counts + ALPHA
        self.logp = np.ascontiguousarray(np.log(c / c.sum(1, keepdims=True)).astype(np.float32).T)
        self.prior = np.log(texts / texts.sum())

    def predict(self, texts: list[str | None], has_letter: list[bool]) -> tuple[list[str], np.ndarray]:
        total = np.tile(self.prior, (len(texts), 1)) if self.langs else np.zeros((len(texts), 0))
        if self.langs:
            for i, j in _blocks(texts):
                for h, row, inside in _grams([t or "" for t in texts[i:j]]):
                    h, row = h[inside] & self.mask, row[inside]
                    first = np.flatnonzero(np.diff(row, prepend=-1))
                    if len(first):
                        for k in range(len(self.langs)):
                            total[i + row[first], k] += np.add.reduceat(self.logp[h, k].astype(np.float64), first)
        langs, scores = [], np.zeros(len(texts))
        for i, ok in enumerate(has_letter):
            if not ok or not self.langs:
                langs.append("und")
                continue
            best = int(total[i].argmax())
            langs.append(self.langs[best])
            scores[i] = 1 / np.exp(total[i] - total[i, best]).sum()
        return langs, scores


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fits all rows with a non-null language and text."""
    small_batches(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sums = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = cut(sums, "langid-counts")
    langs = sorted(r["lang"] for r in sums.where("bucket = -1").select("lang").collect())
    buckets = BUCKETS
    while len(langs) * buckets > MAX_CELLS and buckets > MIN_BUCKETS:
        buckets //= 2
    at = {x: k for k, x in enumerate(langs)}
    counts, texts = np.zeros((len(langs), buckets), np.float32 if len(langs) > 512 else np.float64), np.zeros(len(langs))
    merged = F.when(F.col("bucket") < 0, F.col("bucket")).otherwise(F.col("bucket") % buckets).alias("bucket")  # buckets are the low bits of a hash
    for r in sums.groupBy("lang", merged).agg(F.sum("n").alias("n")).toLocalIterator():
        if r["bucket"] < 0:
            texts[at[r["lang"]]] = r["n"]
        else:
            counts[at[r["lang"]], r["bucket"]] = r["n"]
    discard(sums)
    return Model(langs, counts, texts)


def identify(docs: DataFrame, model: Model, keep: list[Column], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, lang_pred and score (posterior probability) of every row."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("has"))

    @trimmed
    def run(batches):
        for b in batches:
            langs, scores = model.predict(b.column(1).to_pylist(), b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores)], names=["row", "lang_pred", "score"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, lang_pred string, score double").select("row.*", "lang_pred", "score")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    model = train(docs.where(~held_out))
    return identify(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


QUERIES = {"op10_language_id": op10_language_id}
ORACLE: dict = {}
