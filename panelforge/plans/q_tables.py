"""Queries for sources, projections, joins, set operations and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelforge.functions import keys, nulls
from panelforge.operators import joins, setops
from panelforge.sources import readers, writers

from .fixtures import CAL, DP, FS, IND, UD, calendar, daily_panel, foreign_series, industry, user_days
from .registry import load, query


def r6(c, name):
    return F.round(c, 6).alias(name)


# ---- sources -------------------------------------------------------------------------------------


@query("SELECT l_suppkey, l_shipdate::DATE AS day, l_quantity FROM lineitem WHERE l_shipdate >= '1997-01-01' AND l_shipdate <= '1997-01-31'")
def scan_range(spark, d):
    t = readers.scan(spark, f"{d}/lineitem.parquet", ["l_suppkey", "l_shipdate", "l_quantity"])
    t = readers.scan_range(t, "l_shipdate", dt.datetime(1997, 1, 1), dt.datetime(1997, 1, 31))
    return t.select("l_suppkey", F.to_date("l_shipdate").alias("day"), "l_quantity")


@query("SELECT event_id, user_id, value FROM events WHERE ts::DATE = (SELECT max(ts)::DATE FROM events)")
def scan_latest(spark, d):
    e = load(spark, d, "events").withColumn("day", F.to_date("ts"))
    return readers.latest(e, "day").select("event_id", "user_id", "value")


@query("SELECT user_id, ts, value FROM events")
def scan_unique_keys(spark, d):
    return keys.assert_unique(load(spark, d, "events").select("user_id", "ts", "value"), "user_id", "ts")


@query("SELECT CAST(NULL AS BIGINT) AS entity, CAST(NULL AS DATE) AS date WHERE false")
def scan_missing(spark, d):
    return readers.scan_or_empty(spark, f"{d}/no_such_table.parquet", "entity long, date date")


@query("SELECT DISTINCT trim(p_brand) AS code FROM part ORDER BY code LIMIT 20")
def universe_load(spark, d):
    return readers.universe(load(spark, d, "part"), "p_brand", most=20)


@query("SELECT DISTINCT trim(p_brand) AS code FROM part")
def universe_whole(spark, d):
    return readers.universe(load(spark, d, "part"), "p_brand")


@query(
    """SELECT o_custkey, src, o_orderkey FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY last DESC, CASE src WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END, n DESC, src) AS k FROM
  (SELECT o_custkey, o_orderpriority AS src, o_orderkey, max(o_orderdate) OVER p AS last, count(*) OVER p AS n FROM orders WINDOW p AS (PARTITION BY o_custkey, o_orderpriority))) WHERE k = 1"""
)
def source_arbitration(spark, d):
    o = load(spark, d, "orders").select("o_custkey", F.col("o_orderpriority").alias("src"), "o_orderdate", "o_orderkey")
    return readers.choose_source(o, "o_custkey", "src", "o_orderdate", ["1-URGENT", "2-HIGH"]).select("o_custkey", "src", "o_orderkey")


@query(
    """SELECT entity, date, round(pre_close, 9) AS pre_close, round(close - pre_close, 6) AS change, round((close - pre_close) / pre_close * 100, 6) AS pct_chg, round((high - low) / pre_close * 100, 6) AS swing FROM dp""",
    DP,
)
def price_backfill(spark, d):
    p = daily_panel(spark, d).select("entity", F.col("date").alias("day"), "open", "high", "low", F.col("close").alias("last_price"))
    p = readers.normalize_headers(p, {"date": ["day", "trade_day"], "close": ["settle", "last_price"]})
    out = readers.backfill_price_columns(p, "entity", "date")
    return out.select("entity", "date", F.round("pre_close", 9).alias("pre_close"), *[r6(c, c) for c in ("change", "pct_chg", "swing")])


@query("SELECT p_partkey, (p_size * 100.0)::DOUBLE AS p_size, round(p_retailprice * 1000, 4) AS p_retailprice FROM part")
def unit_scaling(spark, d):
    out = readers.scale(load(spark, d, "part").select("p_partkey", "p_size", "p_retailprice"), {"p_size": 100.0, "p_retailprice": 1000.0, "absent": 1.0})
    return out.select("p_partkey", "p_size", F.round("p_retailprice", 4).alias("p_retailprice"))


# ---- projections ---------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') || CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '.0' ELSE 'x' END AS raw,
  CASE WHEN o_orderkey % 3 < 2 THEN o_orderdate::DATE END AS day FROM orders"""
)
def date_keys(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("t"))
    k = F.col("o_orderkey") % 3
    o = o.withColumn("raw", F.concat("t", F.when(k == 0, "").when(k == 1, ".0").otherwise("x")))
    return o.select("o_orderkey", "raw", F.when(k < 2, keys.parse_trade_date("raw")).alias("day"))


@query(
    """SELECT c_custkey, code, code || CASE WHEN substr(code, 1, 1) IN ('6', '9') THEN '.SH' ELSE '.SZ' END AS norm, substr(code, 5, 2)::INT // 5 AS bucket
  FROM (SELECT c_custkey, lpad(((c_custkey * 7919) % 1000000)::VARCHAR, 6, '0') AS code FROM customer)"""
)
def code_keys(spark, d):
    c = load(spark, d, "customer").select("c_custkey", F.lpad((F.col("c_custkey") * 7919 % 1000000).cast("string"), 6, "0").alias("code"))
    return c.select("c_custkey", "code", keys.normalize_code("code").alias("norm"), keys.bucket_id("code").alias("bucket"))


@query("SELECT c_mktsegment, count(*) FILTER (coalesce(f, 1) = 0) AS strict_rows, count(*) FILTER (coalesce(f, 0) = 0) AS lenient_rows FROM (SELECT c_mktsegment, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS f FROM customer) GROUP BY 1")
def null_flag_filters(spark, d):
    c = load(spark, d, "customer").withColumn("f", F.when(F.col("c_acctbal") < 0, None).when(F.col("c_acctbal") > 5000, 1).otherwise(0))
    return c.groupBy("c_mktsegment").agg(F.count_if(keys.usable("f", False)).alias("strict_rows"), F.count_if(keys.usable("f", True)).alias("lenient_rows"))


@query("SELECT entity, date, round(ret, 6) AS ret FROM (SELECT *, count(*) OVER (PARTITION BY entity) AS n FROM dp WHERE ret IS NOT NULL) WHERE n >= 80", DP)
def min_history(spark, d):
    return keys.min_history(daily_panel(spark, d), "entity", 80, "ret").select("entity", "date", r6("ret", "ret"))


@query("SELECT entity, date, round(amount, 4) AS amount FROM dp WHERE entity NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)", DP)
def denylist(spark, d):
    bad = load(spark, d, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("entity"))
    return keys.denylist(daily_panel(spark, d), bad, "entity").select("entity", "date", F.round("amount", 4).alias("amount"))


@query("SELECT DISTINCT o_custkey + c_nationkey AS c_custkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_custkey + c_nationkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def denylist_stale(spark, d):
    c, o = load(spark, d, "customer", "orders")
    listed = o.join(c, c["c_custkey"] == o["o_custkey"]).select((F.col("o_custkey") + F.col("c_nationkey")).alias("c_custkey"))
    return keys.stale_entries(c.where("c_acctbal > 0"), listed, "c_custkey")


@query("SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'mid' ELSE 'large' END AS band, p_size % 7 = 0 AS lucky, CAST(NULL AS DOUBLE) AS score FROM part")
def case_labels(spark, d):
    p = keys.ensure_columns(load(spark, d, "part"), score="double")
    band = F.when(F.col("p_size") <= 10, "small").when(F.col("p_size") <= 30, "mid").otherwise("large")
    return p.select("p_partkey", band.alias("band"), (F.col("p_size") % 7 == 0).alias("lucky"), "score")


@query(
    """SELECT entity, date, round(amount / (CASE WHEN n_error <> 0 THEN n_error END + 1e-9), 4) AS div_a, round(CASE WHEN abs(n_error) > 1e-12 THEN amount / n_error END, 6) AS div_b,
  round(vol / greatest(abs(n_purchase), 1e-9), 4) AS cv, CASE WHEN n_error = 0 THEN NULL ELSE greatest(n_error - 1, 0) END::BIGINT AS nmax FROM ud""",
    UD,
)
def division_rules(spark, d):
    u = user_days(spark, d)
    err = F.col("n_error").cast("double")
    nmax = nulls.null_max(F.when(F.col("n_error") != 0, F.col("n_error") - 1), 0)
    return u.select("entity", "date", F.round(nulls.safe_div_eps("amount", err), 4).alias("div_a"), r6(nulls.safe_div_guard("amount", err), "div_b"), F.round(nulls.cv_ratio(F.col("vol"), F.col("n_purchase").cast("double")), 4).alias("cv"), nmax.cast("long").alias("nmax"))


# ---- joins ---------------------------------------------------------------------------------------

_SB = "sb AS (SELECT o_custkey AS k, max(o_totalprice) AS acct, count(*) AS n FROM orders GROUP BY 1), sa AS (SELECT c_custkey AS k, c_acctbal AS acct, c_mktsegment AS seg FROM customer)"


@query("SELECT b.k, sa.acct, sa.seg, sb.n FROM (SELECT c_custkey AS k FROM customer) b LEFT JOIN sa ON sa.k = b.k LEFT JOIN sb ON sb.k = b.k", _SB)
def star_join_first_wins(spark, d):
    c = load(spark, d, "customer")
    sa = c.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("acct"), F.col("c_mktsegment").alias("seg"))
    sb = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("acct"), F.count(F.lit(1)).alias("n"))
    return joins.star_join(sa.select("k"), [sa, sb], ["k"])


@query("SELECT dp.entity, dp.date, round(dp.close, 9) AS close, round(o.close, 9) AS close_auction_o, round(o.vol, 6) AS vol_auction_o FROM dp LEFT JOIN (SELECT * FROM dp WHERE vol > 150) o USING (entity, date)", DP)
def auction_join(spark, d):
    p = daily_panel(spark, d)
    out = joins.renamed_join(p.select("entity", "date", "close"), p.where("vol > 150"), ["entity", "date"], "_auction_o", ["close", "vol"])
    return out.select("entity", "date", F.round("close", 9).alias("close"), F.round("close_auction_o", 9).alias("close_auction_o"), r6("vol_auction_o", "vol_auction_o"))


@query("SELECT entity, date, vol, e.vol AS vol_limit, coalesce(e.n_error, 0) AS n_error, e.last_type FROM (SELECT entity, date, vol FROM ud) b LEFT JOIN (SELECT * FROM ud WHERE n_error > 0) e USING (entity, date)".replace("date, vol, e.vol", "date, b.vol, e.vol"), UD)
def limit_join(spark, d):
    u = user_days(spark, d)
    out = joins.renamed_join(u.select("entity", "date", "vol"), u.where("n_error > 0"), ["entity", "date"], "_limit", ["vol", "n_error", "last_type"], only_clashes=True)
    return out.select("entity", "date", "vol", "vol_limit", F.coalesce("n_error", F.lit(0)).alias("n_error"), "last_type")


@query(
    """SELECT dp.entity, dp.date, round(dp.close, 9) AS close, round(s.vol, 6) AS vol FROM dp LEFT JOIN s ON s.entity = dp.entity AND s.date = dp.date
  WHERE dp.date <= (SELECT min(m) FROM (SELECT max(date) AS m FROM s GROUP BY entity))""",
    DP, "s AS (SELECT entity, date, vol * 2 AS vol FROM dp WHERE date >= '1998-01-01')",
)
def patch_join(spark, d):
    p = daily_panel(spark, d)
    late = p.where(F.col("date") >= "1998-01-01").select("entity", "date", (F.col("vol") * 2).alias("vol"))
    out = joins.patch_join(p.select("entity", "date", "close", "vol"), late, ["entity", "date"], until="date", entity="entity")
    return out.select("entity", "date", F.round("close", 9).alias("close"), r6("vol", "vol"))


_MAP = [(g, a, b, f"L{i}", i) for i, (g, a, b) in enumerate([(g, y, z) for g in range(0, 25, 2) for y, z in (("1995-01-01", "1997-06-01"), ("1997-01-01", "1999-12-01"), ("2000-03-01", "2001-12-31"))])]
_MAP_SQL = "m AS (SELECT * FROM (VALUES " + ", ".join(f"({g}, DATE '{a}', DATE '{b}', '{x}', {i})" for g, a, b, x, i in _MAP) + ") t(grp, s, e, label, seq))"


@query("SELECT entity, date, label FROM (SELECT dp.entity, dp.date, label, row_number() OVER (PARTITION BY dp.entity, dp.date ORDER BY seq DESC) AS k FROM dp LEFT JOIN ind USING (entity) LEFT JOIN m ON m.grp = ind.grp AND dp.date BETWEEN s AND e) WHERE k = 1", DP, IND, _MAP_SQL)
def interval_join(spark, d):
    mapping = spark.createDataFrame(_MAP, "grp int, s string, e string, label string, seq int").withColumns({"s": F.to_date("s"), "e": F.to_date("e")})
    own = industry(spark, d).join(F.broadcast(mapping), "grp").select("entity", "s", "e", "label", "seq")  # a literal table
    return joins.interval_join(daily_panel(spark, d).select("entity", "date"), own, "entity", "date", "s", "e", "seq")


_ALIGN = """al AS (SELECT cal.date, last_value(v IGNORE NULLS) OVER (ORDER BY cal.date) AS v, (SELECT min(date) FROM fs) AS f FROM cal LEFT JOIN (SELECT date, lag(total, 1) OVER (ORDER BY date) AS v FROM fs) x USING (date))"""


@query("SELECT date, round(v, 4) AS total FROM al WHERE date >= greatest(f, DATE '1996-01-01')", FS, CAL, _ALIGN)
def ffill_align(spark, d):
    out = joins.shift_align(calendar(spark, d), foreign_series(spark, d), "date", ["total"], 1, dt.date(1996, 1, 1))
    return out.select("date", F.round("total", 4).alias("total"))


@query("SELECT date, CASE WHEN date >= f THEN round(v, 4) END AS total FROM al", FS, CAL, _ALIGN)
def ffill_align_keep_early(spark, d):
    out = joins.shift_align(calendar(spark, d), foreign_series(spark, d), "date", ["total"], 1, keep_early=True)
    return out.select("date", F.round("total", 4).alias("total"))


@query(
    """SELECT e.event_id, p.value AS last_purchase FROM events e ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts WHERE e.event_type = 'view'"""
)
def asof_join(spark, d):
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value")
    left, right = e.where("event_type = 'view'").select("event_id", "user_id", "ts"), e.where("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("last_purchase"))
    return joins.asof_join(left, right, ["user_id"], "ts", ["last_purchase"]).select("event_id", "last_purchase")


@query("SELECT entity, date, round(ret - r, 6) AS rel FROM dp LEFT JOIN (SELECT date, avg(ret) AS r FROM dp GROUP BY date) USING (date)", DP)
def broadcast_series(spark, d):
    p = daily_panel(spark, d)
    index = p.groupBy("date").agg(F.avg("ret").alias("r"))
    return p.join(F.broadcast(index), "date", "left").select("entity", "date", r6(F.col("ret") - F.col("r"), "rel"))  # one row a date


# ---- set operations ------------------------------------------------------------------------------

_OLD = "o1 AS (SELECT o_orderkey, o_custkey, round(o_totalprice, 4) AS price, o_orderstatus AS st FROM orders WHERE o_orderdate < '1998-01-01')"
_NEW = "o2 AS (SELECT o_orderkey, o_custkey, round(o_totalprice * CASE WHEN o_orderkey % 2 = 0 THEN 1.5 ELSE 1 END, 4) AS price, 'N' AS st FROM orders WHERE o_orderdate >= '1997-01-01')"


def _two_versions(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    old = o.where(F.col("o_orderdate") < "1998-01-01").select("o_orderkey", "o_custkey", F.round("o_totalprice", 4).alias("price"), F.col("o_orderstatus").alias("st"))
    factor = F.when(F.col("o_orderkey") % 2 == 0, 1.5).otherwise(1.0)
    new = o.where(F.col("o_orderdate") >= "1997-01-01").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * factor, 4).alias("price"), F.lit("N").alias("st"))
    return old, new


@query("SELECT * FROM o2 UNION ALL SELECT * FROM o1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o2)", _OLD, _NEW)
def upsert_keep_last(spark, d):
    old, new = _two_versions(spark, d)
    return setops.upsert(old, new, ["o_orderkey"], "price")


@query(
    """SELECT count(*) FILTER (o1.o_orderkey IS NULL) AS n_new, count(*) FILTER (o1.o_orderkey IS NOT NULL AND abs(o1.price - o2.price) > greatest(greatest(abs(o1.price), abs(o2.price)) * 1e-10, 1e-8)) AS n_changed,
  count(*) FILTER (o1.o_orderkey IS NOT NULL AND abs(o1.price - o2.price) <= greatest(greatest(abs(o1.price), abs(o2.price)) * 1e-10, 1e-8)) AS n_same FROM o2 LEFT JOIN o1 USING (o_orderkey)""",
    _OLD, _NEW,
)
def upsert_change_counts(spark, d):
    old, new = _two_versions(spark, d)
    return setops.change_counts(old.drop("st"), new.drop("st"), ["o_orderkey"])


@query("SELECT coalesce(o1.o_orderkey, o2.o_orderkey) AS o_orderkey, o1.o_custkey, CASE WHEN o2.o_orderkey IS NOT NULL THEN o2.price ELSE o1.price END AS price, o1.st FROM o1 FULL JOIN o2 ON o1.o_orderkey = o2.o_orderkey", _OLD, _NEW)
def partial_upsert(spark, d):
    old, new = _two_versions(spark, d)
    return setops.partial_upsert(old, new, ["o_orderkey"], ["price"])


_RW = "n AS (SELECT * FROM ud WHERE entity % 2 = 0 AND date >= '2024-01-20')"


@query("SELECT entity, date, vol FROM ud WHERE NOT (date BETWEEN '2024-01-20' AND '2024-01-30' AND entity IN (SELECT entity FROM n)) UNION ALL SELECT entity, date, vol * 10 FROM n WHERE date BETWEEN '2024-01-20' AND '2024-01-30'", UD, _RW)
def replace_where(spark, d):
    u = user_days(spark, d).select("entity", "date", "vol")
    new = u.where((F.col("entity") % 2 == 0) & (F.col("date") >= "2024-01-20")).withColumn("vol", F.col("vol") * 10)
    return setops.replace_where(u, new, "entity", "date", dt.date(2024, 1, 20), dt.date(2024, 1, 30))


@query("SELECT entity, date, vol FROM ud WHERE NOT date BETWEEN '2024-01-20' AND '2024-01-30' OR entity IN (SELECT entity FROM n)", UD, _RW)
def prune_window(spark, d):
    u = user_days(spark, d).select("entity", "date", "vol")
    new = u.where((F.col("entity") % 2 == 0) & (F.col("date") >= "2024-01-20"))
    return setops.prune_absent(u, new, "entity", "date", dt.date(2024, 1, 20), dt.date(2024, 1, 30))


@query("SELECT count(*) FILTER (o1.o_orderkey IS NOT NULL AND o2.o_orderkey IS NOT NULL) AS n_overlap, count(*) FILTER (o2.o_orderkey IS NULL) AS n_old_only, count(*) FILTER (o1.o_orderkey IS NULL) AS n_new_only FROM o1 FULL JOIN o2 ON o1.o_orderkey = o2.o_orderkey", _OLD, _NEW)
def merge_overlap_counts(spark, d):
    return setops.merge_overlap(*_two_versions(spark, d), ["o_orderkey"])


@query("SELECT entity, count(*) AS n_rows, max(date) AS last_date, count(*) >= 5 AND max(date) = DATE '2024-01-30' AS covered FROM ud WHERE date BETWEEN '2024-01-20' AND '2024-01-30' GROUP BY entity", UD)
def covers_window(spark, d):
    return setops.covers_window(user_days(spark, d), "entity", "date", dt.date(2024, 1, 20), dt.date(2024, 1, 30), 5)


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def dedup_keep_last(spark, d):
    return setops.keep_last(load(spark, d, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k = 1")
def dedup_keep_first(spark, d):
    return setops.keep_first(load(spark, d, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal, NULL::VARCHAR AS extra FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier")
def union_relaxed(spark, d):
    c, s = load(spark, d, "customer", "supplier")
    a = c.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    b = s.select(F.col("s_suppkey").cast("int").alias("k"), F.col("s_acctbal").alias("bal"), F.col("s_name").alias("name"), F.lit("supplier").alias("extra"))
    return setops.union_relaxed(a, b)


@query("SELECT 'both' AS part, count(*) AS n FROM (SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer) UNION ALL SELECT 'customer_only', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)")
def key_set_ops(spark, d):
    o, c = load(spark, d, "orders").select(F.col("o_custkey").alias("k")), load(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return count(o.intersect(c), "both").union(count(c.subtract(o), "customer_only"))


@query("SELECT o_custkey, o_orderkey, o_orderpriority FROM orders ORDER BY o_orderpriority ASC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50")
def mixed_order(spark, d):
    o = load(spark, d, "orders").orderBy(F.col("o_orderpriority").asc_nulls_last(), F.col("o_totalprice").desc_nulls_last(), "o_orderkey").limit(50)
    return o.select("o_custkey", "o_orderkey", "o_orderpriority")


@query("SELECT o_custkey, o_orderkey, o_orderpriority FROM orders ORDER BY o_orderpriority ASC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey")
def mixed_order_whole(spark, d):
    o = load(spark, d, "orders").orderBy(F.col("o_orderpriority").asc_nulls_last(), F.col("o_totalprice").desc_nulls_last(), "o_orderkey")
    return o.select("o_custkey", "o_orderkey", "o_orderpriority")


# ---- sinks and reports ---------------------------------------------------------------------------


@query("SELECT entity, date, row_number() OVER (ORDER BY date, entity) - 1 AS sample_id FROM dp", DP)
def row_index(spark, d):
    return writers.row_index(daily_panel(spark, d).select("entity", "date"), "date", "entity").select("entity", "date", F.col("sample_id").cast("long").alias("sample_id"))


@query("SELECT entity, count(*) AS n_rows, min(date) AS date_min, max(date) AS date_max, count(DISTINCT date) AS n_dates, 'ok' AS status FROM dp GROUP BY entity", DP)
def coverage_report(spark, d):
    return writers.coverage(daily_panel(spark, d), "entity", "date")


@query("SELECT date, count(*) AS rows, count(*) FILTER (n_error > 0) AS with_error, count(*) FILTER (n_error > 0 AND n_purchase > 0) AS with_both, count(*) FILTER (vol >= 5) AS busy FROM ud GROUP BY date", UD)
def context_counters(spark, d):
    c = {"with_error": F.col("n_error") > 0, "with_both": (F.col("n_error") > 0) & (F.col("n_purchase") > 0), "busy": F.col("vol") >= 5}
    return writers.context(user_days(spark, d), "date", c)


@query(
    "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}', '{t}', '{r}')" for i, (n, t, r) in enumerate([("entity", "bigint", "key"), ("date", "date", "key"), ("amount", "double", "numeric"), ("vol", "bigint", "numeric"), ("n_error", "bigint", "numeric"), ("n_purchase", "bigint", "numeric"), ("last_type", "string", "categorical")])) + ") t(position, \"column\", type, role)"
)
def feature_dictionary(spark, d):
    return writers.feature_dictionary(user_days(spark, d), keys=("entity", "date"))


@query("SELECT (substr(code, 5, 2)::INT // 5) AS bucket, count(*) AS n_rows, count(DISTINCT code) AS n_codes FROM (SELECT lpad(((c_custkey * 7919) % 1000000)::VARCHAR, 6, '0') AS code FROM customer) GROUP BY 1")
def bucket_counts(spark, d):
    c = load(spark, d, "customer").select(F.lpad((F.col("c_custkey") * 7919 % 1000000).cast("string"), 6, "0").alias("code"))
    return c.groupBy(keys.bucket_id("code").alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("code").alias("n_codes"))
