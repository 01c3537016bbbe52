from __future__ import annotations

import bisect
import random
import zlib

from panelforge.llm.sharding import CapacityTree, best_fit, pack, pack_groups, shard_texts, stretches


def test_tree_finds_the_tightest():
    rng, tree, held = random.Random(5), CapacityTree(), []
    for n in range(2000):
        if held and rng.random() < 0.4:
            tree.delete(held.pop(rng.randrange(len(held))))
        else:
            key = (rng.randrange(100), n)
            tree.insert(key)
            bisect.insort(held, key)
        size = rng.randrange(110)
        at = bisect.bisect_left(held, (size, -1))
        assert tree.tightest(size) == (held[at] if at < len(held) else None)


def test_best_fit_is_best_fit():
    rng = random.Random(2)
    sizes = sorted((rng.randrange(1, 60) for _ in range(300)), reverse=True)
    bins = []
    for s in sizes:  # one at a time
        fits = [(left, b) for b, left in enumerate(bins) if left >= s]
        if fits:
            bins[min(fits)[1]] -= s
        else:
            bins.append(100 - s)
    classes = [(s, sizes.count(s)) for s in sorted(set(sizes), reverse=True)]
    runs = best_fit(classes, 100)
    load = {}
    for s, b, q in runs:
        load[b] = load.get(b, 0) + s * q
    assert len(load) == len(bins) and sorted(load.values()) == sorted(100 - x for x in bins)
    assert best_fit([(150, 1), (50, 2)], 100) == [(150, 0, 1), (50, 1, 2)]


def test_pack_gives_large_groups_their_own_shard():
    runs = pack([(1000, 1), (10, 90)], 4)
    load = {}
    for s, b, q in runs:
        load[b] = load.get(b, 0) + s * q
    assert sorted(load.values()) == [300, 300, 300, 1000]
    assert pack([], 3) == []


def test_shards(spark, docs_of):
    rng = random.Random(4)
    rows = [(i, f"doc {i} " * rng.randrange(1, 60), "en", "s") for i in range(500)]
    rows += [(1000 + i, "copy of one text " * 3, "en", "s") for i in range(200)] + [(None, None, None, None), (5, "", None, None), (5, "", None, None)]
    for extra in (False, True):
        got = shard_texts(docs_of(rows, extra), 8).collect()
        assert len(got) == len(rows)
        size = lambda t: len((t or "").encode()) + 8
        assert sorted((r.size, r.text_crc32) for r in got) == sorted((size(t), zlib.crc32((t or "").encode())) for _, t, _, _ in rows)
        assert len({r.shard for r in got if r.doc_id is not None and r.doc_id >= 1000}) == 1
        load, slots = {}, {}
        for r in got:
            load[r.shard] = load.get(r.shard, 0) + r.size
            slots.setdefault(r.shard, []).append(r.slot)
        assert set(load) == set(range(8)) and max(load.values()) - min(load.values()) < 0.02 * sum(load.values()) / 8 + 60
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert shard_texts(docs_of([]), 4).collect() == []


def test_fixed_capacity(spark, tmp_path):
    runs = best_fit([(300, 5000), (70, 20_000), (9, 40_000)], 1000)
    assert [(s, f + k, e) for s, lo, hi, f, e in stretches(runs) for k in range((hi - lo) // e)] == runs
    assert len(stretches(runs)) < 40 < len(runs)
    spark.createDataFrame([(i, 300 if i % 5 == 0 else 70 if i % 5 == 1 else 9) for i in range(4000)], "name long, bytes long").write.parquet(str(tmp_path / "g"))
    got = pack_groups(spark.read.parquet(str(tmp_path / "g")), "name", "bytes", capacity=1000).collect()
    load: dict = {}
    for r in got:
        load[r.shard] = load.get(r.shard, 0) + (300 if r.name % 5 == 0 else 70 if r.name % 5 == 1 else 9)
    assert sorted(r.name for r in got) == list(range(4000)) and max(load.values()) <= 1000
    assert len(load) == -(-(800 * 370 + 2400 * 9) // 1000) or len(load) <= 1.02 * (800 * 370 + 2400 * 9) / 1000 + 1
