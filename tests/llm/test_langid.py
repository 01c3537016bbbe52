from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from panelforge.llm.langid import ALPHA, BUCKETS, _grams, identify, train

VOCAB = {"aa": "kala mona rite suva".split(), "bb": "zorg wexp quij vlyt".split(), "cc": "ñandú çedê über øre".split()}


def text(rng, lang, n):
    return " ".join(rng.choice(VOCAB[lang]) for _ in range(n))


def test_scores_are_naive_bayes(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, text(rng, "aa" if i % 3 else "bb", 12), "aa" if i % 3 else "bb", "s") for i in range(60)]
    model = train(docs_of(rows))
    counts, docs = {k: Counter() for k in model.langs}, Counter(r[2] for r in rows)
    for _, t, lang, _ in rows:
        for h, _, inside in _grams([t]):
            counts[lang].update(h[inside].tolist())
    probe = "kala wexp 12 -- mona"
    want = []
    for lang in model.langs:
        total = sum(counts[lang].values()) + ALPHA * BUCKETS
        s = math.log(docs[lang] / 60)
        for h, _, inside in _grams([probe]):
            s += sum(math.log((counts[lang][x] + ALPHA) / total) for x in h[inside].tolist())
        want.append(s)
    p = np.exp(np.array(want) - max(want))
    langs, scores = model.predict([probe], [True])
    assert langs[0] == model.langs[int(np.argmax(want))] and abs(scores[0] - (p / p.sum()).max()) < 1e-3


def test_grams_do_not_cross_texts():
    together, apart = _grams(["ab c", "dé"]), [_grams(["ab c"]), _grams(["dé"])]
    for n in range(3):
        h, row, inside = together[n]
        assert [h[inside & (row == k)].tolist() for k in (0, 1)] == [a[n][0][a[n][2]].tolist() for a in apart]


def test_held_out_accuracy_and_odd_rows(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, text(rng, lang, rng.randint(1, 40)), lang, "s") for i, lang in enumerate(rng.choice(list(VOCAB)) for _ in range(600))]
    odd = [(1000, None, "aa", "s"), (1001, "", "aa", "s"), (1002, "12 34 !", None, "s"), (1003, text(rng, "bb", 30_000), None, None), (None, "kala mona", None, None), (1004, "￿ kala\U0001f600", None, None)]
    for extra in (False, True):
        docs = docs_of(rows + odd, extra)
        out = {r.doc_id: r for r in identify(docs, train(docs.where("coalesce(doc_id, 1) % 5 <> 0")), [F.col("doc_id")]).collect()}
        assert len(out) == 606
        held = [i for i, *_ in rows if i % 5 == 0]
        assert sum(out[i].lang_pred == rows[i][2] for i in held) >= 0.97 * len(held)
        assert [out[i].lang_pred for i in (1000, 1001, 1002, 1003, None, 1004)] == ["und", "und", "und", "bb", "aa", "aa"]
        assert all(0 <= r.score <= 1 for r in out.values())


def test_nothing_learned(spark, docs_of):
    docs = docs_of([(1, "kala", None, "s")])
    assert [(r.lang_pred, r.score) for r in identify(docs, train(docs), [F.col("doc_id")]).collect()] == [("und", 0.0)]
    assert identify(docs_of([]), train(docs_of([])), [F.col("doc_id")]).collect() == []
