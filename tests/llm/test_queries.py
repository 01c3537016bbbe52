"""Every opN query on tables with awkward rows: names and types of its columns, and its rows against brute force by the contract's words."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from panelforge.llm.registry import queries
from pyspark.sql import functions as F

QUERY = {int(k.split("_")[0][2:]): f for k, f in queries().items() if re.fullmatch(r"op\d+_.*", k) and not k.endswith("_links")}
TYPES = {
    1: "page_id bigint, host string, path string, rule string, verdict string",
    3: "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    4: "page_id bigint, url string, text string, n_chars bigint",
    5: "doc_id bigint, n_shingles bigint, component_id bigint",
    6: "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    8: "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    9: "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    10: "doc_id bigint, held_out boolean, lang_pred string, score double",
}


def corpus():
    rng = random.Random(12)
    pick = lambda n: " ".join(rng.choice(["Alpha", "beta", "gamma", "DELTA", "éclair", "zeta9", "eta", "théta"]) + str(rng.randrange(60)) for _ in range(n))
    long, passage, leak = pick(3000), pick(50), pick(22)
    texts = [pick(rng.randrange(1, 90)) for _ in range(60)]
    texts += [texts[0], texts[0].upper(), texts[1], texts[2] + " tail", passage, pick(9) + " " + passage, pick(40) + "\t" + passage + "\n" + pick(5), passage + " " + passage]
    texts += [leak, pick(7) + " " + leak.upper().replace(" ", ", "), " ".join(leak.split()[3:14]), "x y z", "x  y z", "one", "One", "", "   ", "12 34 !", None, None, long, long + " end", "日本 語 日本 語"]
    rows = [(i * 3 + 1, t, ["en", "fr", None][i % 3], f"s{i % 4}" if i % 7 else None) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4]]
    items = [("b", leak), ("a", "x y z"), ("c", None), ("d", "  "), ("e", "never seen words " * 9), ("f", "One")]
    return rows, items


@pytest.fixture(scope="module")
def tables(spark, docs_of, tmp_path_factory):
    rows, items = corpus()
    d = str(tmp_path_factory.mktemp("sf"))
    docs_of(rows, extra=True).write.parquet(f"{d}/documents.parquet")
    pages = [(1, "https://www.example.com/en/a?x#y", "<html><body><nav>Menu</nav><article><p>A  b</p><p>c &amp; d</p></article></body></html>"), (2, None, None), (2, None, None), (3, "no scheme", ""), (4, "http://Sub.Host.NET/fr/p", "<p>just text"), (5, "https://other.org/es/", "<p>" + "w " * 30_000 + "</p>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("h")).withColumn("text", F.lit("t")).write.parquet(f"{d}/pages.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(r[0], 1, int(i % 2)) for i, r in enumerate(rows[:40])], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


@pytest.fixture(scope="module")
def no_rows(spark, docs_of, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("none"))
    docs_of([]).write.parquet(f"{d}/documents.parquet")
    for name, schema in (("pages", "page_id long, url string, html string"), ("benchmark", "item_id string, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{d}/{name}.parquet")
    return d


@pytest.mark.parametrize("op", sorted(QUERY))
def test_names_types_and_empty_tables(spark, tables, no_rows, op):
    got = QUERY[op](spark, no_rows)
    types = dict(got.dtypes)
    for column in TYPES.get(op, "doc_id bigint").split(", "):
        name, kind = column.split()
        assert types[name] == kind, (op, name)
    assert got.collect() == []


def result(spark, tables, op):
    names = [c.split()[0] for c in TYPES[op].split(", ")]
    return sorted((tuple(r[c] for c in names) for r in QUERY[op](spark, tables).collect()), key=repr)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_exact_dedup(spark, tables):
    rows, _ = corpus()
    groups: dict = {}
    for i, t, *_ in rows:
        groups.setdefault(lower(t), []).append(i)
    want, seen = [], set()
    for i, t, *_ in rows:
        keep = max(groups[lower(t)])
        kept = i == keep and i not in seen
        seen.add(i)
        want.append((i, keep, len(groups[lower(t)]), kept, sha(lower(t))))
    assert result(spark, tables, 3) == sorted(want, key=repr)


def test_ngram_jaccard(spark, tables):
    rows, _ = corpus()

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        return {tuple(w)} if 0 < len(w) < 3 else {tuple(w[i : i + 3]) for i in range(len(w) - 2)}

    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] == rows[b][0] or (sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])):
                root[find(a)] = find(b)
    least: dict = {}
    for k, r in enumerate(rows):
        least[find(k)] = min(least.get(find(k), r[0]), r[0])
    assert result(spark, tables, 5) == sorted(((r[0], len(sets[k]), least[find(k)]) for k, r in enumerate(rows)), key=repr)


def test_substring_dedup(spark, tables):
    rows, _ = corpus()
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    starts: dict = {}
    for w in words:
        for i in range(len(w) - 34):
            starts[tuple(w[i : i + 35])] = starts.get(tuple(w[i : i + 35]), 0) + 1
    want = []
    for (i, *_), w in zip(rows, words, strict=True):
        gone = {k for s in range(len(w) - 34) if starts[tuple(w[s : s + 35])] > 1 for k in range(s, s + 35)}
        want.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    assert result(spark, tables, 6) == sorted(want, key=repr) and any(0 < x[2] < x[1] for x in want)


def test_decontamination(spark, tables):
    rows, items = corpus()
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows: dict = {}
    for name, t in items:
        w = split(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[s : s + 10]), set()).add(name)
    want = []
    for i, t, *_ in rows:
        w, hit, found = split(t), set(), set()
        for g, names in windows.items():
            for s in range(len(w) - len(g) + 1):
                if tuple(w[s : s + len(g)]) == g:
                    hit |= set(range(s, s + len(g)))
                    found |= names
        want.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    assert result(spark, tables, 8) == sorted(want, key=repr) and sum(x[5] for x in want) > 5


def test_sharding(spark, tables):
    rows, _ = corpus()
    got = result(spark, tables, 9)
    assert sorted(x[:3] for x in got) == sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert {x[3] for x in got} == {"bytes"} and {x[4] for x in got} <= set(range(24)) and {x[6] for x in got} == {None}
    for s in range(24):
        own = sorted(x[5] for x in got if x[4] == s)
        assert own == list(range(len(own)))
    text = {i: t for i, t, *_ in rows}
    homes: dict = {}
    for x in got:
        if text[x[0]]:
            homes.setdefault(text[x[0]], set()).add(x[4])
    assert all(len(h) == 1 for h in homes.values())


def test_language_id(spark, tables):
    rows, _ = corpus()
    text = {i: t for i, t, *_ in rows}
    learned = {r[2] for r in rows if r[2] and zlib.crc32(str(r[0]).encode()) % 5}
    for i, held, lang, score in result(spark, tables, 10):
        assert held == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= score <= 1
        assert lang in learned if any(c.isalpha() for c in text[i] or "") else lang == "und"


def test_urls_and_pages(spark, tables):
    got = {x[0]: x[1:] for x in result(spark, tables, 1)}
    assert got[1][:3] == ("www.example.com", "/en/a", "www.example.com/en/") and got[1][3] == "allow" and got[2][:3] == ("", "", None) == got[3][:3] and got[4] == ("sub.host.net", "/fr/p", "net/fr/", "block")
    pages = result(spark, tables, 4)
    assert len(pages) == 6 and [x[2] for x in pages if x[0] in (1, 2, 3)] == ["A b\n\nc & d", "", "", ""] and all(x[3] == len(x[2]) for x in pages)


def test_mixing_and_toxicity(spark, tables):
    rows, _ = corpus()
    ids = {r[0] for r in rows}
    assert {r.doc_id for r in QUERY[2](spark, tables).collect()} <= ids
    assert sorted(r.doc_id for r in QUERY[7](spark, tables).collect()) == sorted(r[0] for r in rows)
