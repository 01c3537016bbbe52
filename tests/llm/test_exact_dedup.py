from __future__ import annotations

import hashlib
import random

import numpy as np

from panelforge.llm import golomb
from panelforge.llm.exact_dedup import exact_dedup


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))


def expected(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for i, t, *_ in rows:
        ids = groups[lower(t)]
        known = [x for x in ids if x is not None]
        keep = max(known) if known else None
        out.append((i, keep, len(ids), hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_golomb_round_trip():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 1000):
        v = np.array(sorted({rng.randrange(1 << 64) for _ in range(n)}), dtype=np.uint64)
        assert (golomb.decode(golomb.encode(v)) == v).all()
    v = np.arange(5000, dtype=np.uint64) + np.uint64((1 << 64) - 5000)
    assert (golomb.decode(golomb.encode(v)) == v).all() and len(golomb.encode(v)) < 1000
    v = np.array(sorted(rng.randrange(1 << 48) for _ in range(10000)), dtype=np.uint64)
    assert len(golomb.encode(np.unique(v))) < 10000 * 4.7


def test_against_brute_force(spark, docs_of):
    rng = random.Random(3)
    base = ["Hello World", "hello world", "HELLO world", "ÉTÉ", "été", "", None, "  ", "a" * 50_000, "A" * 50_000, "x\ty", "x y", "日本"]
    rows = [(i, rng.choice(base), "en", "s") for i in range(400)] + [(None, "Hello World", None, None), (None, "only null id", None, None), (None, "only null id", None, None)]
    for extra in (False, True):
        got = exact_dedup(docs_of(rows, extra)).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == expected(rows)
        kept = {}
        for r in got:
            kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
            assert not r.kept or r.doc_id == r.keep_id
        assert set(kept.values()) == {1}


def test_repeated_rows_and_empty(spark, docs_of):
    got = exact_dedup(docs_of([(7, "Same", "en", "s")] * 3)).collect()
    assert sorted(r.kept for r in got) == [False, False, True] and {r.keep_id for r in got} == {7} and {r.group_size for r in got} == {3}
    assert exact_dedup(docs_of([])).collect() == []
