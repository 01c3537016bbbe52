from __future__ import annotations

import random

import corpus_pipeline as cp
from panelforge.llm.jaccard import keep_one
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_planted_cases(spark, docs_of, words, tmp_path):
    rng = random.Random(4)
    leak = words(900_000, 30)
    rows, labels, bad = [], [], {"toxic": set(), "copy": set(), "leak": set()}
    for i in range(240):
        t = words(i * 1000, rng.randrange(20, 80))
        if i % 8 == 1:
            t += " you idiot scum"
            bad["toxic"].add(i)
        elif i % 8 == 2:
            t = rows[-2][1]  # the clean one before the toxic one
            bad["copy"].add(i)
        elif i % 8 == 3:
            t += " " + leak[: len(leak) // 2]
            bad["leak"].add(i)
        rows.append((i, t, "en", f"s{i % 5}"))
        if i % 2 or i % 8 == 4:
            labels.append((i, 1, int(i % 8 == 1)))
    rows += [(500, None, None, None), (501, "", None, "s1")]
    d = str(tmp_path)
    docs_of(rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id int, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    left = {i for i, *_ in rows}
    for (name, stage), gone in zip(cp.STAGES[:3], ("toxic", "copy", "leak"), strict=True):
        stage(spark, docs, d).write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        left -= bad[gone]
        assert docs.columns == COLUMNS
        assert {r.doc_id for r in docs.collect()} == left
    mixed = cp.STAGES[3][1](spark, docs, d)
    assert mixed.columns == COLUMNS and {r.doc_id for r in mixed.collect()} <= left
    final = cp.run(spark, d)
    assert {r.shard for r in final.collect()} <= set(range(cp.SHARDS)) and "slot" in final.columns


def test_one_of_each_group_stays(spark, docs_of, words):
    rows = [(3, words(0, 50), "en", "s"), (2, words(0, 50), "en", "s"), (2, words(0, 50), "en", "s"), (None, words(0, 51), "en", "s"), (9, "", "en", "s"), (9, "", "en", "s")]
    got = keep_one(docs_of(rows), n=5, num=80)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(2, words(0, 50)), (9, ""), (9, "")]


def test_on_empty_tables_and_clashing_columns(spark, docs_of, words, tmp_path):
    for name, rows in (("none", []), ("some", [(i, words(i * 100, 30), "en", "s") for i in range(20)] + [(3, None, None, None), (3, None, None, None)])):
        d = str(tmp_path / name)
        docs_of(rows, extra=True).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([], "item_id int, text string").write.parquet(f"{d}/benchmark.parquet")
        docs = spark.read.parquet(f"{d}/documents.parquet")
        for name_, stage in cp.STAGES[:-1]:
            if rows and name_ != "ngram_jaccard":  # run() shows that one
                assert stage(spark, docs, d).columns == docs.columns
        got = cp.run(spark, d)
        assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("shard", "int"), ("slot", "bigint")]
        ids = [r.doc_id for r in got.collect()]
        assert set(ids) <= {i for i, *_ in rows} and bool(ids) == bool(rows)


def test_query_against_brute_force(spark, docs_of, words, tmp_path):
    """The rows of run(): stages written down anew, the mixing by its own query over what is left."""
    import binascii
    from collections import Counter

    from panelforge.llm.mixing import mix_sources

    rng = random.Random(9)
    leak = words(800_000, 24)
    rows, labels = [], []
    for i in range(150):
        t = words(i * 500, rng.randrange(15, 60))
        t = t + " idiot scum" if i % 5 == 1 else rows[-1][1].replace(" idiot scum", "") + " more" if i % 10 == 2 else t + " " + leak if i % 10 == 3 else t
        rows.append((i, t, "en", f"s{i % 4}"))
        labels.append((i, 1, int(i % 5 == 1)))
    d = str(tmp_path)
    docs_of(rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id int, text string").write.parquet(f"{d}/benchmark.parquet")
    left = [r for r in rows if r[0] % 5 != 1]
    grams = lambda t, n: {tuple(t.split()[i : i + n]) for i in range(len(t.split()) - n + 1)}
    kept: list = []
    for r in left:  # no chains among these rows
        if not any(len(grams(r[1], 5) & grams(k[1], 5)) >= 0.8 * len(grams(r[1], 5) | grams(k[1], 5)) for k in kept):
            kept.append(r)
    kept = [r for r in kept if not grams(r[1], 10) & grams(leak, 10)]
    want = Counter(r.row.doc_id for r in mix_sources(docs_of(kept), [F.col("doc_id")]).collect())
    got = cp.run(spark, d).collect()
    assert Counter(r.doc_id for r in got) == want and sum(want.values()) > 50
    text = {i: t for i, t, *_ in rows}
    assert all(r.size == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == binascii.crc32(text[r.doc_id].encode()) for r in got)
    for s in range(cp.SHARDS):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert all(len({r.shard for r in got if r.doc_id == i}) == 1 for i in want)
