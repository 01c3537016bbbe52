from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from panelforge.llm import jaccard
from panelforge.llm.components import components
from panelforge.llm.jaccard import bands, jaccard_components, jaccard_join, keep_one, odd_sketch, signatures


def shingles(t, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def brute(rows, n, num, den):
    sets = [shingles(t, n) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                c = len(sets[i] & sets[j])
                if den * c >= num * (len(sets[i]) + len(sets[j]) - c):
                    root[find(i)] = find(j)
    low = {}
    for i, (d, *_) in enumerate(rows):
        r = find(i)
        low[r] = d if low.get(r) is None else low[r] if d is None else min(low[r], d)
    return sorted(((d, len(sets[i]), low[find(i)] if sets[i] else d) for i, (d, *_) in enumerate(rows)), key=repr)


def family(rng, start, size, members, edits, words):
    """Texts around one base; distances lie on both sides of the threshold."""
    base = words(start, size).split()
    out = []
    for _ in range(members):
        w = list(base)
        for _ in range(rng.randrange(0, edits + 1)):
            p = rng.randrange(len(w))
            kind = rng.randrange(3)
            if kind == 0:
                w[p] = f"e{rng.randrange(10**6)}"
            elif kind == 1 and len(w) > 4:
                del w[p]
            else:
                w.insert(p, f"i{rng.randrange(10**6)}")
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80), (1, 50), (2, 95)])
def test_against_brute_force(spark, docs_of, words, n, num):
    rng = random.Random(n * 100 + num)
    texts = []
    for f in range(14):
        size = rng.choice([3, 5, 8, 12, 20, 40, 90, 200, 400])
        texts += family(rng, f * 10_000, size, rng.randrange(2, 9), max(1, size // rng.choice([12, 25, 40])), words)
    texts += ["one", "One", "one two", "ONE two", "", None, "  ", "a b c", "A B C d", "x " * 500, "x " * 501, words(0, 40), words(0, 40)]
    rng.shuffle(texts)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, texts[3], "en", "s"), (0, texts[0], "en", "s")]
    for extra in (False, True):
        got, links = jaccard_components(docs_of(rows, extra), n=n, num=num)
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == brute(rows, n, num, 100)
    kept = keep_one(docs_of(rows), n=n, num=num).collect()
    want = brute(rows, n, num, 100)
    assert sorted(r.doc_id for r in kept if shingles(r.text, n)) == sorted({c for _, s, c in want if s})
    assert sum(not shingles(r.text, n) for r in kept) == sum(not s for _, s, _ in want)


def test_chain_of_links_is_one_component(spark, docs_of, words):
    """Neighbours are similar, the ends are not."""
    rows = [(i, words(i * 2, 60), "en", "s") for i in range(12)]
    got, _ = jaccard_components(docs_of(rows))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == brute(rows, 3, 90, 100)
    assert {r.component_id for r in got.collect()} == {0}


def test_signatures_keep_every_similar_pair():
    """All pairs at the largest allowed difference share a signature, for sizes of every kind."""
    rng = np.random.default_rng(5)
    for num in (80, 90, 95):
        low, segments, top = bands(num, 100, 3000)
        for _ in range(400):
            a = int(rng.integers(1, 300))
            k = int(np.searchsorted(low, a, side="right")) - 1
            b = int(rng.integers(a, a * 100 // num + 1))
            common = -(-num * (a + b) // (num + 100))
            if common > a:
                continue
            pool = rng.integers(0, 1 << 63, size=a + b - common, dtype=np.uint64)
            x, y = np.sort(pool[:a]), np.sort(np.concatenate([pool[:common], pool[a:]]))
            assert b <= top[k]
            if segments[k] > 1:
                assert set(signatures(x, k, int(segments[k])).tolist()) & set(signatures(y, k, int(segments[k])).tolist())
            else:
                assert common == a == b


def test_sketch_bounds_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a, b, c = (rng.integers(0, 1 << 63, size=int(rng.integers(1, 400)), dtype=np.uint64) for _ in range(3))
        x, y = np.unique(np.concatenate([a, c])), np.unique(np.concatenate([b, c]))
        s = jaccard._folded([odd_sketch(x), odd_sketch(y)])
        assert np.bitwise_count(s[0] ^ s[1]).sum() <= len(np.setxor1d(x, y))


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 2), (200, 201)], "u long, v long")
    root = {r.node: r.root for r in components(edges).collect()}
    assert all(root[i] == 0 for i in range(1, 41)) and all(root[i] == 100 for i in range(101, 160)) and root[201] == 200 and len(root) == 40 + 59 + 1
    assert components(edges.limit(0)).collect() == []


def test_empty(spark, docs_of):
    got, _ = jaccard_components(docs_of([]))
    assert got.collect() == [] and keep_one(docs_of([])).collect() == []


@pytest.mark.parametrize("block", [1000, 7])
def test_join_gives_every_link(spark, docs_of, words, monkeypatch, block):
    """All pairs of different sets, and the number of links of each row, against brute force; groups larger than a block too."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rng = random.Random(block)
    texts = [t for f, (size, members) in enumerate([(60, 40), (200, 25), (12, 9), (5, 6), (90, 2)]) for t in family(rng, f * 10_000, size, members, 4, words)]
    texts += [words(90_000 + i * 2, 60) for i in range(12)] + [texts[0], texts[3].upper(), "", None, "one"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    sets = [shingles(t, 3) for t in texts]
    first = [next((j for j in range(i) if sets[j] == s), i) if s else i for i, s in enumerate(sets)]
    own = [i for i, s in enumerate(sets) if s and first[i] == i]
    want = {(i, j) for i in own for j in own if i < j and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])}
    assert len(want) > 60
    got, pairs = jaccard_join(docs_of(rows, extra=True))
    got = got.collect()
    named = {r.set_id: r.class_id for r in got}
    found = [tuple(sorted((named[r.u], named[r.v]))) for r in pairs.collect()]
    assert len(found) == len(set(found)) and set(found) == want
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {i: (first[i], sum(first[i] in p for p in want)) for i in range(len(rows))}


def test_words_that_a_weak_hash_confuses(spark, docs_of, words, alike):
    a, b = alike
    rows = [(0, a, "en", "s"), (1, b, "en", "s"), (2, a, "en", "s"), (3, f"{a} " + words(0, 3), "en", "s"), (4, f"{b} " + words(0, 3), "en", "s")]
    got, _ = jaccard_components(docs_of(rows))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, 3, 90, 100)


def test_words_decide_not_their_hashes(words, twins):
    a, b = twins
    texts = [f"{a} " + words(0, 30), f"{b} " + words(0, 30), f"{a} " + words(0, 30), a, b, f"{a} {a}", words(0, 1)]
    sets = jaccard.exact_sets(pa.array([t.encode() for t in texts]), 3)
    for x, s in zip(texts, sets, strict=True):
        for y, t in zip(texts, sets, strict=True):
            assert len(np.intersect1d(s, t)) == len(shingles(x, 3) & shingles(y, 3))
    batch = pa.record_batch([pa.array([1] * 3), pa.array([None, 2, 3]), pa.array([texts[i].encode() for i in range(3)])], names=["a", "b", "words"])
    (out,) = jaccard._verify(3, 95, 100)([batch])
    assert out.column(1).to_pylist() == [3]


@pytest.mark.parametrize("k", [1, 2, 3, 5, 9])
def test_numbers_of_shingles(k):
    """Also where the numbers outgrow 62 bits and are made small again."""
    from panelforge.llm._words import gram_ids

    rng = np.random.default_rng(k)
    ids = rng.integers(0, 4, 400) + (1 << 29)
    for kinds in (1 << 30, int(ids.max()) + 1):
        got = gram_ids(ids, kinds, k).tolist()
        want = [tuple(ids[i : i + k].tolist()) for i in range(400 - k + 1)]
        assert len(got) == len(want) and len(set(got)) == len(set(want)) == len(set(zip(got, want, strict=True)))


@pytest.mark.parametrize("size", [4096, 5])
def test_long_lists_in_parts_and_cells(spark, docs_of, words, monkeypatch, size):
    """Groups of near copies beyond a part of a list and a block of it."""
    monkeypatch.setattr(jaccard, "PART_SETS", size)
    monkeypatch.setattr(jaccard, "LIST_BLOCK", size)
    monkeypatch.setattr(jaccard, "SHARE_SETS", size)
    rng = random.Random(size)
    texts = [t for f, (n, members) in enumerate([(40, 45), (24, 30), (150, 20)]) for t in family(rng, f * 10_000, n, members, 4, words)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got, _ = jaccard_components(docs_of(rows))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == brute(rows, 3, 90, 100)
