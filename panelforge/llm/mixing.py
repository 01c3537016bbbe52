"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations.

Token shares p of the sources are raised to an exponent a in [0, 1] and normalised.  The
exponent is the largest whose weights reach the target entropy (a share of the
highest possible one), found by bisection; if some source would then be repeated
more than ``max_repeat`` times, the smallest exponent that keeps the limit is
bisected instead (1 if none does).

A source's weight times the budget is its quota of tokens.  A source's rows are dealt once to
hashed blocks, and every epoch is a permutation of these blocks, by the hash of epoch and block
(``place``); whole epochs are taken while the quota holds them, then the blocks of the next epoch
in its order, then the rows of the block at the border, in hash order, as far as they fit (equal rows together).

Scale: bisection evaluates 15 exponents (4 halvings) in one aggregate over the table of
sources, which is never collected.  Which rows a quota takes is decided row by
row from its source's plan (places before a border block's, and hashes up to a
border hash inside it); to find the border, only keys and sizes of one block of each
source are sorted, equal rows added up before, so no task gathers a source and no text is shuffled.

Tokens of a text are its UTF-8 bytes / ``BYTES_PER_TOKEN``, rounded up, at least 1;
null text counts as empty.  A null source is the source "".  Repeated rows are
rows of their own (equal ones are taken together or not at all); ties of hash are decided by the key of id
and text.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import cut, discard, fitting, table

TARGET_ENTROPY, MAX_REPEAT = 0.95, 4.0
BYTES_PER_TOKEN, BLOCK_ROWS, SEED = 4, 10_000, 17
HALVINGS = 48


def _bisect(good, low: float, high: float, keep_low: bool) -> float:
    """Border of ``good`` between ``low`` and ``high``; ``good(list)`` judges 15 exponents at a time."""
    for _ in range(HALVINGS // 4):
        grid = [low + (high - low) * k / 16 for k in range(17)]
        flags = good(grid[1:16])
        a, z = 0, 16
        while z - a > 1:  # the four halvings that these points decide
            mid = (a + z) // 2
            if flags[mid - 1] == keep_low:
                a = mid
            else:
                z = mid
        low, high = grid[a], grid[z]
    return low if keep_low else high


def exponent(sources: DataFrame, total: int, n_sources: int, budget: int, target_entropy: float, max_repeat: float) -> float:
    """``sources``: column tokens."""
    p = F.col("tokens") / F.lit(float(total))

    def facts(points):
        """(entropy, largest repetition) for each exponent."""
        sums = []
        for k, a in enumerate(points):
            w = F.pow(p, F.lit(a))
            sums += [F.sum(w).alias(f"z{k}"), F.sum(w * F.log(w)).alias(f"e{k}"), F.max(F.pow(p, F.lit(a - 1))).alias(f"r{k}")]
        r = sources.agg(*sums).first()
        return [(math.log(r[f"z{k}"]) - r[f"e{k}"] / r[f"z{k}"], r[f"r{k}"] / r[f"z{k}"] * budget / total) for k in range(len(points))]

    goal = target_entropy * math.log(n_sources)
    (h, repeat), (_, least) = facts([1.0, 1.0])
    a = 1.0 if h >= goal - 1e-12 else _bisect(lambda g: [x >= goal for x, _ in facts(g)], 0.0, 1.0, True)
    repeat = facts([a])[0][1]
    if repeat > max_repeat:
        a = 1.0 if least > max_repeat else _bisect(lambda g: [x <= max_repeat for _, x in facts(g)], a, 1.0, False)
    return a


def _bits(digest: Column) -> Column:
    """The first 32 bits of a digest in hexadecimal."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _key(what: Column, epoch: Column, seed: int) -> Column:
    """32 bits that order a row or a block in an epoch."""
    return _bits(F.md5(F.concat(F.lit(f"{seed}|"), epoch.cast("string"), F.lit("|"), what.cast("string"))))


def mix_sources(docs: DataFrame, keep: list[Column], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", target_entropy: float = TARGET_ENTROPY, max_repeat: float = MAX_REPEAT, budget: int | None = None, seed: int = SEED) -> DataFrame:
    """The mixture, one row for each time that a row of ``docs`` is taken.

    ``row`` (struct of the ``keep`` columns), source, tokens, weight (of the source), epoch, block, place
    (blocks of an epoch follow each other by place and block).
    ``budget``: tokens to take in all; by default as many as there are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(*keep).alias("row"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.greatest(F.ceil(F.octet_length(text) / BYTES_PER_TOKEN), F.lit(1)).cast("long").alias("tokens"),
        F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), text)).alias("tkey"),
    )
    narrow = cut(rows.select("source", "tokens", "tkey"), "tokens")
    sources = cut(narrow.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "sources")
    total, n_sources = sources.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not total:
        total, n_sources = 1, 1
    budget = total if budget is None else budget
    a = exponent(sources, total, n_sources, budget, target_entropy, max_repeat) if n_sources > 1 else 1.0

    z = sources.agg(F.sum(F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a)))).first()[0] or 1.0
    weight = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a)) / F.lit(z)
    quota = F.round(weight * F.lit(float(budget)), 3).cast("decimal(38,3)").cast("long")
    plan = sources.select("source", weight.alias("weight"), F.floor(quota / F.col("tokens")).cast("int").alias("full"), (quota % F.col("tokens")).alias("left"), F.ceil(F.col("rows") / BLOCK_ROWS).cast("long").alias("blocks"))
    plan = first = cut(plan, "plan")

    def planned(df: DataFrame, plan: DataFrame) -> DataFrame:
        dealt = df.join(fitting(plan, n_sources, 200), "source").withColumn("block", _bits(F.col("tkey")) % F.col("blocks"))
        return dealt.withColumn("place", _key(F.col("block"), F.col("full"), seed))

    before = Window.partitionBy("source").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    sums = planned(narrow, plan).groupBy("source", "place", "block").agg(F.sum("tokens").alias("n"), F.first("left").alias("left"))
    sums = sums.select("source", "place", "block", "n", "left", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    border = sums.where("start <= left AND start + n > left").select("source", F.struct("place", "block").alias("border"), (F.col("left") - F.col("start")).alias("rest"))
    plan = plan.join(border, "source", "left")
    at, key = F.struct("place", "block"), _key(F.col("tkey"), F.col("full"), seed)
    edge = planned(narrow, plan).where(at == F.col("border")).groupBy("source", key.alias("key"), "tkey").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    in_order = Window.partitionBy("source").orderBy("key", "tkey").rowsBetween(Window.unboundedPreceding, 0)  # distinct rows of one block of a source
    edge = edge.withColumn("sum", F.sum("tokens").over(in_order)).where("sum <= rest")
    last = edge.groupBy("source").agg(F.max(F.struct("key", "tkey")).alias("last"))
    plan = cut(plan.join(last, "source", "left"), "plan")
    discard(narrow, sources, first)

    in_border = F.struct(key.alias("key"), F.col("tkey").alias("tkey")) <= F.col("last")
    times = F.col("full") + F.when(at < F.col("border"), 1).when(at == F.col("border"), F.coalesce(in_border, F.lit(False)).cast("int")).otherwise(0)
    taken = planned(rows, plan).where(times > 0).select("row", "source", "tokens", "weight", "block", F.explode(F.sequence(F.lit(0), times - 1)).alias("epoch"))
    return taken.select("row", "source", "tokens", "weight", "epoch", "block", _key(F.col("block"), F.col("epoch"), seed).alias("place"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(table(spark, sf_dir, "documents"), [F.col("doc_id")])
    return out.select("row.doc_id", "source", "tokens", F.round("weight", 6).alias("weight"), "epoch", "block", "place")


def _bisect_sql(name: str, low: str, test: str, keep_low: bool) -> str:
    good, bad = ("mid, hi", "lo, mid") if keep_low else ("lo, mid", "mid, hi")
    return f"""{name}(it, lo, hi) AS (
  SELECT 0, {low}, 1.0::DOUBLE UNION ALL
  SELECT it + 1, CASE WHEN {test} THEN {good.split(", ")[0]} ELSE {bad.split(", ")[0]} END, CASE WHEN {test} THEN {good.split(", ")[1]} ELSE {bad.split(", ")[1]} END
  FROM (SELECT it, lo, hi, (lo + hi) / 2 AS mid, sum(pow(p, (lo + hi) / 2)) AS z, sum(pow(p, (lo + hi) / 2) * ln(pow(p, (lo + hi) / 2))) AS e, max(pow(p, (lo + hi) / 2 - 1)) AS r
        FROM {name}, src WHERE it < {HALVINGS} GROUP BY it, lo, hi))"""


OP2_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source, greatest(ceil(strlen(coalesce(text, '')) / {BYTES_PER_TOKEN}), 1)::BIGINT AS tokens,
    md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS tkey FROM documents),
tot AS (SELECT sum(tokens)::DOUBLE AS t, count(DISTINCT source) AS k FROM d),
src AS (SELECT source, sum(tokens)::BIGINT AS n, count(*) AS c, sum(tokens) / any_value(t) AS p FROM d, tot GROUP BY source),
{_bisect_sql("b1", "0.0::DOUBLE", f"ln(z) - e / z >= {TARGET_ENTROPY} * ln((SELECT k FROM tot))", True)},
a1 AS (SELECT CASE WHEN (SELECT -sum(p * ln(p)) FROM src) >= {TARGET_ENTROPY} * ln((SELECT k FROM tot)) - 1e-12 THEN 1.0 ELSE lo END AS a FROM b1 WHERE it = {HALVINGS}),
{_bisect_sql("b2", "(SELECT a FROM a1)", f"r / z <= {MAX_REPEAT}", False)},
a2 AS (SELECT CASE WHEN (SELECT max(pow(p, a - 1)) / sum(pow(p, a)) FROM src) <= {MAX_REPEAT} THEN a ELSE (SELECT hi FROM b2 WHERE it = {HALVINGS}) END AS a FROM a1),
w AS (SELECT source, n, c, pow(p, a) / sum(pow(p, a)) OVER () AS weight FROM src, a2),
plan AS (SELECT source, weight, q // n AS ep, q % n AS rest, ceil(c / {BLOCK_ROWS})::BIGINT AS blocks
         FROM (SELECT *, floor(round(weight * (SELECT t FROM tot), 3))::BIGINT AS q FROM w)),
b AS (SELECT d.*, weight, ep, rest, ('0x' || substr(tkey, 1, 8))::BIGINT % blocks AS block FROM d JOIN plan USING (source)),
s AS (SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY ('0x' || substr(md5('{SEED}|' || ep || '|' || block), 1, 8))::BIGINT, block, ('0x' || substr(md5('{SEED}|' || ep || '|' || tkey), 1, 8))::BIGINT, tkey) AS upto FROM b),
o AS (SELECT *, unnest(generate_series(0, ep - 1 + (upto <= rest)::INT)) AS epoch FROM s)
SELECT doc_id, source, tokens, round(weight, 6) AS weight, epoch::INT AS epoch, block,
       ('0x' || substr(md5('{SEED}|' || epoch || '|' || block), 1, 8))::BIGINT AS place FROM o
"""

QUERIES = {"op2_source_mixing": op2_source_mixing}
ORACLE = {"op2_source_mixing": OP2_SQL}
