"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, extra=False):
        df = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCS)
        if extra:  # columns whose names the operators use themselves
            from pyspark.sql import functions as F

            for c in ("id", "fp", "sha", "key", "size", "row", "n", "sid", "tk", "tokens", "weight", "epoch", "block", "shard", "slot", "severity", "keep_id", "spans", "html", "score", "rid", "root"):
                df = df.withColumn(c, F.lit(c))
        return df

    return make


@pytest.fixture(scope="session")
def words():
    """Deterministic text: distinct words of a numbered vocabulary."""

    def make(start, n, sep=" "):
        return sep.join(f"w{start + i}x" for i in range(n))

    return make


@pytest.fixture(scope="session")
def alike():
    """Two words of 1,024 letters that a polynomial hash modulo 2**64 can't tell apart (a Thue-Morse word and its complement)."""
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    return a, b


@pytest.fixture
def twins(monkeypatch):
    """Two words that have one hash in this process for as long as the test runs."""
    from panelforge.llm import _words as wd

    honest = wd.word_hashes

    def weak(d, starts, ends, fold=wd.SAME):
        out = honest(d, starts, ends, fold)
        if len(starts):
            out[d[starts] == ord("0")] = 1
        return out

    monkeypatch.setattr(wd, "word_hashes", weak)
    return "0one", "0two"
