from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from panelforge.llm import toxicity
from panelforge.llm.toxicity import Model, drop_toxic, score, severity_grade, train

LABELS = "doc_id long, quality int, toxic int"
BAD = ["idiot", "scum", "trash", "moron"]


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"word{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        bad = i % 6 == 0
        if bad:
            for w in rng.sample(BAD, rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), w.upper() if rng.random() < 0.3 else w)
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out(spark, docs_of):
    rows, labels = corpus()
    seen = spark.createDataFrame([x for x in labels if x[0] % 4], LABELS)
    model = train(docs_of(rows), seen, severity_grade())
    odd = [(9000, None, None, None), (9001, "", "en", "s"), (9002, "word1 " * 20_000 + "idiot", "en", "s"), (None, "you scum", "en", "s")]
    out = {r.row.doc_id: r for r in score(docs_of(rows + odd, extra=True), model, [F.col("doc_id")]).collect()}
    assert all(out[i].rejected == bool(toxic) for i, _, toxic in labels)
    assert [out[i].rejected for i in (9000, 9001, 9002, None)] == [False, False, True, True]
    assert all(len(r.p_above) == 1 and abs(r.severity - sum(r.p_above)) < 1e-12 for r in out.values())


def test_ordered_grades():
    rng = np.random.default_rng(3)
    n, weights = 3000, np.array([1.5, 3.0, 0.0, 0.0])
    x = rng.random((n, 4)) < 0.4
    z = x @ weights + rng.logistic(size=n)
    y = (z > 1.0).astype(int) + (z > 3.0) + (z > 5.0)
    rows, feats = np.nonzero(x)
    m = Model(np.arange(4, dtype=np.uint64), 4).fit(rows, feats, y)
    assert np.all(np.diff(m.thresholds) > 0) and np.abs(m.thresholds - [1, 3, 5]).max() < 0.35
    assert np.abs(m.weights - weights).max() < 0.35
    above = m.above(rows, feats, n)
    assert (np.diff(above, axis=1) <= 0).all()  # P(grade > k) falls with k
    assert abs(above.sum(1).mean() - y.mean()) < 0.05  # expected severity


def test_drop_and_edges(spark, docs_of):
    rows, labels = corpus()
    kept = drop_toxic(docs_of(rows), spark.createDataFrame(labels, LABELS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, t in labels if not t]
    for lab in ([], [(1, 1, 0)], [(None, 1, 1), (2, None, None)]):  # fewer than two grades
        assert drop_toxic(docs_of(rows), spark.createDataFrame(lab, LABELS)).count() == len(rows)
    assert drop_toxic(docs_of([]), spark.createDataFrame(labels, LABELS)).collect() == []


def test_labels_of_other_documents_take_none_of_the_bound(spark, docs_of, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_TRAIN", 400)
    rows, labels = corpus()
    others = [(10_000 + i, 1, i % 2) for i in range(20_000)]
    kept = drop_toxic(docs_of(rows), spark.createDataFrame(labels + others, LABELS))
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, t in labels if not t]


def test_three_grades_from_labels(spark, docs_of, tmp_path):
    """Toxic texts with and without quality: order of severities; and the query on the same tables."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(900):
        words = [f"word{rng.randrange(200)}" for _ in range(rng.randrange(5, 40))]
        grade = (0, 0, 0, 1, 2)[i % 5]
        words += ["moron"] if grade == 1 else ["idiot", "scum"] if grade == 2 else []
        rows.append((i, " ".join(words), "en", "s"))
        if i % 2:
            labels.append((i, int(grade < 2), int(grade > 0)))
    odd = [(9000, None, None, None), (9000, None, None, None), (9001, "", "en", "s"), (None, "idiot scum", "en", "s")]
    d = str(tmp_path)
    docs_of(rows + odd).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{d}/labels.parquet")
    got = toxicity.op7_toxicity(spark, d)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("doc_id", "bigint"), ("severity", "double"), ("p_above", "array<double>"), ("rejected", "boolean")]
    assert {r.doc_id: r.rejected for r in got.collect() if r.doc_id is not None and r.doc_id < 900} == {i: i % 5 > 2 for i in range(900)}
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = score(docs, train(docs, spark.read.parquet(f"{d}/labels.parquet"), toxicity.three_grades()), [F.col("doc_id")]).select("row.doc_id", "severity", "p_above", "rejected").collect()
    assert len(got) == len(rows) + len(odd)
    out = {r.doc_id: r for r in got}
    mean = [np.mean([out[i].severity for i in range(900) if (0, 0, 0, 1, 2)[i % 5] == g]) for g in range(3)]
    assert mean[0] < 0.2 < mean[1] < mean[2] and all(out[i].rejected == (i % 5 > 2) for i in range(900))
    assert out[None].rejected and not out[9000].rejected and not out[9001].rejected
    assert all(len(r.p_above) == 2 and r.p_above[0] >= r.p_above[1] and abs(r.severity - sum(r.p_above)) < 1e-12 for r in got)


def test_the_fit_is_a_maximum(spark):
    """No small step from the fitted point raises the penalised likelihood, written down anew."""
    rng = np.random.default_rng(5)
    n, v = 800, 5
    x = (rng.random((n, v)) < 0.4).astype(float)
    y = np.digitize(x @ np.array([2.0, 1.0, 0.5, 1.5, 0.8]) + rng.logistic(size=n), [1.5, 3.5])
    rows, feats = np.nonzero(x)
    m = Model(np.arange(v, dtype=np.uint64), 3).fit(rows, feats, y)

    def goal(w, t):
        above = 1 / (1 + np.exp(t[None, :] - (x @ w)[:, None]))
        p = np.column_stack([1 - above[:, 0], above[:, 0] - above[:, 1], above[:, 1]])[np.arange(n), y]
        return np.log(p).sum() - toxicity.REFIT_PENALTY * w.sum()

    best = goal(m.weights, m.thresholds)
    for _ in range(200):
        dw, dt = rng.normal(size=v) * 0.05, rng.normal(size=2) * 0.05
        assert goal(np.maximum(m.weights + dw, 0), m.thresholds + dt) <= best + 1e-3


def test_bound_holds_for_rows(spark, docs_of, monkeypatch):
    """A labelled id that is repeated with other texts can't pass the bound; equal rows count once."""
    monkeypatch.setattr(toxicity, "MAX_TRAIN", 50)
    rows = [(1, f"you idiot number{i % 300}", "en", "s") for i in range(2000)] + [(2, f"fine word{i}", "en", "s") for i in range(300)]
    seen = []
    fit = Model.fit
    monkeypatch.setattr(Model, "fit", lambda self, r, f, g: (seen.append(len(g)), fit(self, r, f, g))[1])
    train(docs_of(rows), spark.createDataFrame([(1, 1, 1), (2, 1, 0)], LABELS), severity_grade())
    assert max(seen) <= 50


def test_text_ids(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame([(f"d{i}", t) for i, t, *_ in rows], "doc_id string, text string")
    kept = drop_toxic(docs, spark.createDataFrame([(f"d{i}", q, t) for i, q, t in labels], "doc_id string, quality int, toxic int"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(f"d{i}" for i, _, t in labels if not t)
