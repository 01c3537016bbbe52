from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelforge.llm.url_filter import _CODE, ORDER, RULES, SYMBOLS, UrlModel, _count, filter_urls

SCHEMA = "page_id long, url string, html string"


def split_url(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def rule_of(host, path):
    best = None
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best


def test_rules_and_model(spark):
    good = [f"https://www.reading{i}.news.org/en/{i}" for i in range(300)]
    bad = [f"http://casino-win{i}.casino.org/en/{i}" for i in range(120)]
    odd = [None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.COM/en/1?x#y", "http://example.com", "http://example.com?x=/en/", "http://www.example.com/en/", "http://aexample.com/en/", "ftp://x.net/es/", "http://net/fr/q", "http://u.net/de/", "a://b://c/d", "http://É.COM/é\nx", "http://x.org/" + "a" * 20000]
    rows = [(i, u, "") for i, u in enumerate(good + bad + odd + ["http://casin-win7.casin.org/en/7"])] + [(0, good[0], "")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"host": F.lit("clash"), "lm_score": F.lit(1)})
    out = filter_urls(df, RULES, F.when(~F.col("host").contains("casin-"), ~F.col("host").contains("casino"))).collect()
    assert len(out) == len(rows)
    for r in out:
        url = dict((i, u) for i, u, _ in rows)[r.page_id]
        assert (r.host, r.path) == split_url(url)
        rule = rule_of(r.host, r.path)
        assert r.rule == (rule[1] if rule else None)
        if rule:
            assert r.verdict == rule[0]
        elif not r.host and not r.path:
            assert r.verdict == "allow"
    verdict = {r.page_id: r.verdict for r in out}
    assert all(verdict[i] == "allow" for i in range(300)) and all(verdict[i] == "block" for i in range(300, 420))
    assert verdict[len(rows) - 2] == "block"  # unlabelled, and spelt as no label is


def test_one_class_or_nothing(spark):
    df = spark.createDataFrame([(1, "http://a.org/", "")], SCHEMA)
    assert [r.verdict for r in filter_urls(df, [], F.lit(True)).collect()] == ["allow"]
    assert filter_urls(df.limit(0), RULES).collect() == []


def test_contexts_are_exact_at_any_size():
    """Scores equal those of a model by dictionaries, over more contexts than fit any fixed table."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789-./") for _ in range(40)) for _ in range(3000)]
    labels = [i % 2 for i in range(len(texts))]
    counts = [defaultdict(Counter) for _ in range(2)]
    for t, y in zip(texts, labels, strict=True):
        c = [0] * ORDER + [int(_CODE[b]) for b in t.encode()]
        for i in range(ORDER, len(c)):
            for k in range(ORDER + 1):
                counts[y][tuple(c[i - k : i])][c[i]] += 1
    assert sum(len(k) == 4 for k in counts[0]) > 40_000

    def log_p(model, t):
        c, out = [0] * ORDER + [int(_CODE[b]) for b in t.encode()], 0.0
        for i in range(ORDER, len(c)):
            p = 1 / SYMBOLS
            for k in range(ORDER + 1):
                if seen := model.get(tuple(c[i - k : i])):
                    p = (seen[c[i]] + len(seen) * p) / (sum(seen.values()) + len(seen))
            out += math.log(p)
        return out

    cells = pa.Table.from_batches(_count([pa.record_batch([pa.array(texts), pa.array(labels)], names=["t", "label"])]))
    label, cell, n = (cells.column(c).to_numpy() for c in ("label", "cell", "n"))
    model = UrlModel([(cell[label == c], n[label == c]) for c in (0, 1)])
    some = texts[:40] + ["zzzz", "reading.org/x"]
    got = model.score(pa.array(some))
    assert got.tolist() == pytest.approx([(log_p(counts[1], t) - log_p(counts[0], t)) / len(t) for t in some], abs=1e-5)


def test_the_held_out_fold_is_counted_at_the_end(spark):
    """A rejected class whose URLs all fall in the held-out fold still reaches the model."""
    names = spark.range(400).select(F.concat(F.lit("casino"), F.col("id").cast("string"), F.lit(".org/")).alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(5)) == 0)
    bad = [f"http://{r.t}" for r in names.limit(20).collect()]
    rows = [(i, u, "") for i, u in enumerate([f"http://reading{i}.net/" for i in range(100)] + bad)]
    out = filter_urls(spark.createDataFrame(rows, SCHEMA), [], ~F.col("host").contains("casino")).collect()
    assert {r.verdict for r in out if "casino" in r.host} == {"block"} and {r.verdict for r in out if "reading" in r.host} == {"allow"}


def test_rules_are_the_labels_by_default(spark):
    """Unruled URLs that look like allowed (blocked) ones are allowed (blocked); without blocked ones all are allowed."""
    rng = random.Random(8)
    name = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    ruled = [f"http://{name()}.com/de/{i}" for i in range(200)] + [f"http://{name()}.net/{rng.choice(['es', 'fr'])}/{i}" for i in range(200)]
    odd = ["http://abcdef.org/de/7", "http://abcdef.net.org/es/7", "http://bcdefg.org/fr/8"]
    rows = [(i, u, "") for i, u in enumerate(ruled + odd)]
    got = {r.page_id: r for r in filter_urls(spark.createDataFrame(rows, SCHEMA), RULES).collect()}
    assert all((got[i].rule is not None) == (i < 400) for i in got)
    assert [got[400 + i].verdict for i in range(3)] == ["allow", "block", "block"]
    assert {r.verdict for r in filter_urls(spark.createDataFrame(rows[:200] + rows[400:], SCHEMA), RULES).collect()} == {"allow"}


def test_the_query_against_scores_by_dictionaries(spark, tmp_path):
    """Every verdict that no rule gives equals that of an independent model: counts, Witten-Bell, folds and threshold."""
    from panelforge.llm.url_filter import BINS, FOLDS, op1_url_filter

    rng = random.Random(3)
    hosts = [f"{w}.example.{t}" for w in ("news", "shop", "casino", "blog") for t in ("com", "net", "org")]
    rows = [(i, f"https://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randrange(50)}?q={i}", "") for i in range(500)] + [(500, None, None), (501, "x", ""), (7, "http://a.org/", "")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    got = op1_url_filter(spark, str(tmp_path))
    assert [(f.name, f.dataType.simpleString()) for f in got.schema][:5] == [("page_id", "bigint"), ("host", "string"), ("path", "string"), ("rule", "string"), ("verdict", "string")]
    texts = ["".join(split_url(u)) for _, u, _ in rows]
    labels = [None if (r := rule_of(*split_url(u))) is None or not t else r[0] == "allow" for (_, u, _), t in zip(rows, texts, strict=True)]
    folds = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(F.pmod(F.xxhash64("t"), F.lit(FOLDS))).collect()]

    def fit(keep):
        models = [defaultdict(Counter) for _ in range(2)]
        for t, y, f in zip(texts, labels, folds, strict=True):
            if y is not None and keep(f):
                c = [0] * ORDER + [int(_CODE[b]) for b in t.encode()]
                for i in range(ORDER, len(c)):
                    for k in range(ORDER + 1):
                        models[y][tuple(c[i - k : i])][c[i]] += 1
        return models

    def score(models, t):
        c, out = [0] * ORDER + [int(_CODE[b]) for b in t.encode()], 0.0
        for i in range(ORDER, len(c)):
            for sign, model in ((-1, models[0]), (1, models[1])):
                p = 1 / SYMBOLS
                for k in range(ORDER + 1):
                    if seen := model.get(tuple(c[i - k : i])):
                        p = (seen[c[i]] + len(seen) * p) / (sum(seen.values()) + len(seen))
                out += sign * math.log(p)
        return out / max(len(c) - ORDER, 1)

    half, whole = fit(lambda f: f != 0), fit(lambda f: True)
    held = [[round(score(half, t) * 100) for t, y, f in zip(texts, labels, folds, strict=True) if f == 0 and y is c] for c in (False, True)]
    assert all(held)
    cost = [sum(x < b for x in held[1]) / len(held[1]) + sum(x >= b for x in held[0]) / len(held[0]) for b in range(-BINS // 2, BINS // 2 + 2)]
    best = [i for i, x in enumerate(cost) if x <= min(cost) + 1e-12]
    threshold = (best[len(best) // 2] - BINS // 2 - 0.5) / 100
    want = sorted(((i, u, rule_of(*split_url(u))) for i, u, _ in rows), key=repr)
    found = sorted(((r.page_id, next(u for i, u, _ in rows if i == r.page_id and split_url(u) == (r.host, r.path)), r) for r in got.collect()), key=lambda x: repr(x[:2]))
    assert len(found) == len(rows)
    for i, u, r in found:
        rule, t = rule_of(r.host, r.path), r.host + r.path
        x = score(whole, t) if t else 0.0
        assert r.rule == (rule[1] if rule else None) and abs(r.lm_score - x) < 1e-4
        if abs(x - threshold) > 1e-3:
            assert r.verdict == (rule[0] if rule else "allow" if not t or x >= threshold else "block")
    assert len(want) == len(found)
