from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelforge.llm import substring
from panelforge.llm.substring import remove_repeats


def brute(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (i, *_), w in zip(rows, texts, strict=True):
        gone = {p for a in range(len(w) - window + 1) if seen[tuple(w[a : a + window])] > 1 for p in range(a, a + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("cells", "flush", "filter_bits"), [(1 << 20, 8_000_000, 1 << 28), (1 << 9, 2000, 64)])
def test_against_brute_force(spark, docs_of, words, monkeypatch, cells, flush, filter_bits):
    """Also with a sketch or a filter so full that it lets everything through, with and with many small flushes."""
    monkeypatch.setattr(substring, "FILTER_BITS", filter_bits)
    monkeypatch.setattr(substring, "FLUSH_ANCHORS", flush)
    monkeypatch.setattr(substring, "FLUSH_BYTES", flush)
    monkeypatch.setattr(substring, "MIN_CELLS", 1 << 9)
    rng = random.Random(6)
    passage = words(0, 60)
    rows = [(i, words(1000 * i, rng.randrange(0, 120)) + " " + passage + "\n" + words(1000 * i + 500, 30), "en", "s") for i in range(1, 60)]
    rows += [(100, words(70_000, 34), "en", "s"), (101, words(70_000, 34), "en", "s"), (102, words(80_000, 35), "en", "s"), (103, words(80_000, 35), "en", "s"), (104, "a " * 36, "en", "s"), (105, "a " * 35, "en", "s")]
    rows += [(106, words(90_000, 40) + " " + words(90_000, 40), "en", "s"), (107, "b c " * 60, "en", "s"), (108, "x  y\t" * 18, "en", "s"), (109, "", None, None), (110, None, None, None), (111, words(95_000, 20_000), "en", "s")]
    rows += [(200 + i, words(60_000, 80), "en", "s") for i in range(30)] + [(None, words(60_000, 80), "en", "s"), (111, words(95_000, 100), "en", "s"), (112, passage.upper(), "en", "s")]
    for extra in (False, True):
        out = remove_repeats(docs_of(rows, extra), [F.col("doc_id")], max_cells=cells).select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
        assert sorted(map(tuple, out), key=repr) == brute(rows, 35)


def test_spans_and_empty(spark, docs_of, words):
    rows = [(1, "head " + words(0, 40) + " tail", "en", "s"), (2, words(0, 40), "en", "s")]
    out = {r.row.doc_id: r for r in remove_repeats(docs_of(rows), [F.col("doc_id")]).collect()}
    assert out[1].removed == [[1, 41]] and out[1].kept_text == "head tail" and out[2].removed == [[0, 40]] and out[2].kept_text == ""
    assert remove_repeats(docs_of([]), [F.col("doc_id")]).collect() == []


def test_sketch_never_loses_a_repeat(spark, docs_of):
    """Random texts over few words, so that windows repeat in odd ways; a short window."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 60))), "en", "s") for i in range(60)]
    out = remove_repeats(docs_of(rows), [F.col("doc_id")], window=12, k=4).select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    assert sorted(map(tuple, out), key=repr) == brute(rows, 12)


def test_words_that_a_weak_hash_confuses(spark, docs_of, words, alike):
    rows = [(i, f"{a} " + words(0, 34), "en", "s") for i, a in enumerate(alike)] + [(2, alike[0] + " " + words(50, 40), "en", "s"), (3, alike[0] + " " + words(50, 40), "en", "s")]
    out = remove_repeats(docs_of(rows), [F.col("doc_id")]).select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    assert sorted(map(tuple, out)) == brute(rows, 35)


def test_words_decide_not_their_hashes(words, twins):
    """Runs whose windows have one hash and different words, at the task that owns their anchor."""
    a, b = twins
    runs = [words(0, 20) + f" {a} " + words(30, 20), words(0, 20) + f" {b} " + words(30, 20), words(60, 40) + f" {a}", words(59, 41) + f" {b}", words(59, 41) + f" {b} {a}"]
    batch = pa.record_batch([pa.array([1] * 5), pa.array([bytes([i]) for i in range(5)]), pa.array([0] * 5, pa.int32()), pa.array([len(r.split()) - 34 for r in runs], pa.int32()), pa.array([False] * 5), pa.array([r.encode() for r in runs])], names=["owner", "text_key", "first", "n", "again", "words"])
    found = {}
    for out in substring._repeats(35)([batch]):
        for key, first, n, bits in zip(*[c.to_pylist() for c in out.columns], strict=True):
            found[key[0]] = [i for i in range(n) if bits is None or bits[i // 8] >> (7 - i % 8) & 1]
    seen = Counter(tuple(r.split()[i : i + 35]) for r in runs for i in range(len(r.split()) - 34))
    want = {x: [i for i in range(len(r.split()) - 34) if seen[tuple(r.split()[i : i + 35])] > 1] for x, r in enumerate(runs)}
    assert found == {x: hits for x, hits in want.items() if hits}
