from __future__ import annotations

import re

import pyarrow as pa
import pytest

from panelforge.llm import _words as wd
from panelforge.llm import decontam
from panelforge.llm.decontam import drop_leaks, find_leaks


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, items, window=10):
    w, hit, found = words_of(text), set(), set()
    for name, t in items:
        iw = words_of(t)
        n = min(len(iw), window)
        grams = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found.add("" if name is None else str(name))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize(("index_bytes", "filter_bits"), [(decontam.INDEX_BYTES, 1), (0, decontam.FILTER_BITS), (0, 64)])
def test_against_brute_force(spark, docs_of, words, monkeypatch, index_bytes, filter_bits):
    """By one index, by a join of fingerprints, and by a join behind a filter so full that it lets all through."""
    monkeypatch.setattr(decontam, "INDEX_BYTES", index_bytes)
    monkeypatch.setattr(decontam, "FILTER_BITS", filter_bits)
    items = [(1, words(0, 25)), (2, words(100, 10)), (3, "Short one"), (4, "x"), (5, None), (6, ""), (7, words(5, 12)), (None, words(300, 11)), (8, "Ünïcode wörd " + words(400, 9)), (9, words(0, 25)), (10, "r " * 30)]
    texts = [
        words(0, 40), words(3, 9), words(0, 10).upper(), words(4, 11, "--"), "zz " + words(100, 10) + " yy " + words(5, 12) + " " + words(300, 11), "a short one here", "x", "", None, "no match at all",
        "ünïcode Wörd " + words(400, 9), words(100, 9) + " gap " + words(109, 1), " ".join([words(0, 12)] * 3), "r r r r r r r r r r r", "q " * 3000 + words(2, 13) + " q" * 3000,
    ]
    bench = spark.createDataFrame(items, "item_id int, text string")
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(0, texts[0], "en", "s"), (None, texts[4], None, None)]
    for extra in (False, True):
        got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in find_leaks(docs_of(rows, extra), bench).collect()), key=repr)
        assert got == sorted(((i, *brute(t, items)) for i, t, *_ in rows), key=repr)
    clean = drop_leaks(docs_of(rows), bench)
    assert clean.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.text or "" for r in clean.collect()) == sorted(t or "" for _, t, *_ in rows if not brute(t, items)[1])


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([], "item_id int, text string")
    assert [tuple(r)[:3] for r in find_leaks(docs_of([(1, "a b", "en", "s")]), bench).collect()] == [(1, 2, 0)]
    assert find_leaks(docs_of([]), spark.createDataFrame([(1, "a")], "item_id int, text string")).collect() == []


@pytest.mark.parametrize("index_bytes", [decontam.INDEX_BYTES, 0])
def test_words_that_a_weak_hash_confuses(spark, docs_of, words, monkeypatch, alike, index_bytes):
    monkeypatch.setattr(decontam, "INDEX_BYTES", index_bytes)
    a, b = alike
    items = [(1, words(0, 9) + f" {a} " + words(50, 9)), (2, a)]
    texts = [words(0, 9) + f" {b} " + words(50, 9), b, f"x {a} x", words(0, 9) + f" {a} " + words(50, 9)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in find_leaks(docs_of(rows), spark.createDataFrame(items, "item_id int, text string")).collect())
    assert got == sorted((i, *brute(t, items)) for i, t, *_ in rows)


def test_words_decide_not_their_hashes(words, twins):
    a, b = twins
    items = [words(0, 12) + f" {a} " + words(50, 12), a, words(0, 9) + f" {a}"]
    index = decontam.Index(["1", "2", "3"], items)
    texts = [words(0, 12) + f" {b} " + words(50, 12), b, f"x {a} x", items[0], words(0, 9) + f" {b} " + words(50, 9)]
    for t in texts:
        found = index.find(decontam.Texts(*wd.text_buffer(pa.array([t]))))
        hit = {p for _, s, e, _ in found for p in range(s, e)}
        assert (len(hit), sorted({index.ids[x] for *_, x in found})) == brute(t, list(zip(index.ids, items, strict=True)))[1:]


def test_a_large_benchmark_takes_no_more_python_nodes(spark, docs_of, words, monkeypatch):
    monkeypatch.setattr(decontam, "INDEX_BYTES", 100)
    docs = docs_of([(i, words(i * 7, 60), "en", "s") for i in range(50)])
    plans = []
    for n in (3, 300):
        bench = spark.createDataFrame([(i, words(i * 40, 30)) for i in range(n)], "item_id int, text string")
        plans.append(find_leaks(docs, bench)._jdf.queryExecution().executedPlan().toString().count("MapInArrow"))
    assert plans[0] == plans[1] == 1
