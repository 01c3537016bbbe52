from __future__ import annotations

import math
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from panelforge.llm import mixing
from panelforge.llm.mixing import mix_sources


def skewed(n=900):
    rng = random.Random(8)
    return [(i, f"doc {i} " + "word " * rng.randrange(1, 40), "en", "big" if i % 3 else f"s{i % 10}") for i in range(n)]


def shares(rows):
    t = Counter()
    for _, text, _, s in rows:
        t[s or ""] += max(1, math.ceil(len((text or "").encode()) / 4))
    return t


def brute_exponent(t, target, limit):
    total = sum(t.values())
    p = [x / total for x in t.values()]

    def weights(a):
        w = [x**a for x in p]
        return [x / sum(w) for x in w]

    def entropy(a):
        return -sum(x * math.log(x) for x in weights(a))

    def repeat(a):
        return max(w / x for w, x in zip(weights(a), p, strict=True))

    lo, hi = 0.0, 1.0
    if entropy(1.0) < target * math.log(len(p)):
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if entropy(mid) >= target * math.log(len(p)) else (lo, mid)
    else:
        lo = 1.0
    a = lo
    if repeat(a) > limit:
        lo, hi = a, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if repeat(mid) <= limit else (mid, hi)
        a = hi
    return dict(zip(t, weights(a), strict=True))


@pytest.mark.parametrize(("target", "limit"), [(0.95, 4.0), (1.0, 2.0), (0.1, 4.0), (0.97, 1.2)])
def test_weights_and_quotas(spark, docs_of, target, limit):
    rows = skewed()
    t = shares(rows)
    want = brute_exponent(t, target, limit)
    got = mix_sources(docs_of(rows), [F.col("doc_id")], target_entropy=target, max_repeat=limit).select("row.doc_id", "source", "tokens", "weight", "epoch").collect()
    total = sum(t.values())
    taken = Counter()
    for r in got:
        taken[r.source] += r.tokens
        assert abs(r.weight - want[r.source]) < 1e-6
    for s, w in want.items():
        assert w * total - 60 <= taken[s] <= w * total + 1  # the quota, less than one text unused
    seen = Counter((r.doc_id, r.epoch) for r in got)
    assert max(seen.values()) == 1  # an epoch is a permutation
    for s in want:  # an epoch begins when the one before is complete
        epochs = Counter(r.epoch for r in got if r.source == s)
        size = sum(x[3] == s for x in rows)
        assert all(epochs[e] == size for e in range(max(epochs)))


def test_against_sql_with_small_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 40)
    rows = skewed() + [(None, None, None, None), (5000, "", "en", None), (5001, "z" * 9000, "en", "big")]
    df = docs_of(rows)
    got = mix_sources(df, [F.col("doc_id")]).select("row.doc_id", "source", "tokens", F.round("weight", 6), "epoch", "block", "place").collect()
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    sql = mixing.OP2_SQL.replace(" / 10000)", " / 40)")
    assert sorted(map(tuple, got), key=repr) == sorted((tuple(r) for r in con.sql("SELECT doc_id, source, tokens, weight, epoch, block, place FROM (" + sql + ")").fetchall()), key=repr)


def test_epochs_permute_the_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 20)
    rows = skewed() + [(7000, "many times over", "en", "hot")] * 300 + [(8000 + i, f"other {i}", "en", "hot") for i in range(40)]
    got = mix_sources(docs_of(rows), [F.col("doc_id")], target_entropy=1.0).collect()
    home, orders = {}, {}
    for r in got:
        assert home.setdefault((r.source, r.row.doc_id), r.block) == r.block  # rows never change their block
        orders.setdefault((r.source, r.epoch), set()).add((r.place, r.block))
    for s in {r.source for r in got if r.epoch > 1}:
        first, second = ([b for _, b in sorted(orders[s, e])] for e in (0, 1))
        assert sorted(first) == sorted(second) and (first != second or len(first) < 4)
    for s in {s for s, _ in orders}:  # of the last epoch: whole blocks in its order, then part of one
        e = max(e for x, e in orders if x == s)
        here = Counter(r.block for r in got if r.source == s and r.epoch == e)
        size = Counter(r.block for r in got if r.source == s and r.epoch == 0)
        taken = [b for _, b in sorted(orders[s, e])]
        assert e == 0 or all(here[b] == size[b] for b in taken[:-1])


def test_budget_and_edges(spark, docs_of):
    rows = skewed(90)
    got = mix_sources(docs_of(rows, extra=True), [F.col("doc_id")], budget=200).collect()
    assert sum(r.tokens for r in got) <= 200 and {r.epoch for r in got} <= {0}
    assert mix_sources(docs_of([]), [F.col("doc_id")]).collect() == []
    one = mix_sources(docs_of([(1, "abc", "en", "s")]), [F.col("doc_id")]).collect()
    assert [(r.row.doc_id, r.weight, r.epoch) for r in one] == [(1, 1.0, 0)]
