"""Adapters that read the driver's tables as panels, bars, calendars and signals, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .registry import load

TIE = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]


def daily_panel(spark: SparkSession, d: str) -> DataFrame:
    """Supplier x month: entity, date, open, high, low, close, vol, amount, cap, pre_close, ret."""
    t = load(spark, d, "lineitem").select("l_suppkey", *TIE, "l_discount")
    px = 1000 + F.col("l_extendedprice") / F.col("l_quantity") / 20
    t = t.select(F.col("l_suppkey").alias("entity"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("date"), px.alias("px"), F.struct(*TIE).alias("tie"), "l_quantity", "l_extendedprice", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    g = t.groupBy("entity", "date").agg(
        F.min_by("px", "tie").alias("open"), F.max("px").alias("high"), F.min("px").alias("low"), F.max_by("px", "tie").alias("close"),
        F.sum("l_quantity").alias("vol"), F.sum("l_extendedprice").alias("amount"), F.sum("net").alias("cap"),
    )
    w = Window.partitionBy("entity").orderBy("date")
    return g.withColumn("pre_close", F.lag("close").over(w)).withColumn("ret", F.col("close") / F.col("pre_close") - 1)


DP = """dp0 AS (SELECT l_suppkey AS entity, date_trunc('month', l_shipdate)::DATE AS date, 1000 + l_extendedprice / l_quantity / 20 AS px, * FROM lineitem),
dp1 AS (SELECT entity, date, first(px ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS open, max(px) AS high, min(px) AS low,
  last(px ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS close, sum(l_quantity) AS vol, sum(l_extendedprice) AS amount,
  sum(l_extendedprice * (1 - l_discount)) AS cap FROM dp0 GROUP BY entity, date),
dp AS (SELECT *, lag(close) OVER (PARTITION BY entity ORDER BY date) AS pre_close, close / lag(close) OVER (PARTITION BY entity ORDER BY date) - 1 AS ret FROM dp1)"""


def ew_index(spark: SparkSession, d: str) -> DataFrame:
    """date, r: mean return of a month's suppliers."""
    return daily_panel(spark, d).groupBy("date").agg(F.avg("ret").alias("r"))


EW = "ew AS (SELECT date, avg(ret) AS r FROM dp GROUP BY date)"


def intraday_bars(spark: SparkSession, d: str) -> DataFrame:
    """Event type x day: entity, day, pos, n, ts, hm, open, high, low, close, vol, amount; a bar an event.

    ``pos`` is the order of the bars, and the only one to sort by: missing ids come last, rows of equal time and id go by file and place in it, however the files are split.
    """
    e = load(spark, d, "events").select("event_id", "ts", "event_type", "value", "props", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    w = Window.partitionBy("event_type", F.to_date("ts")).orderBy("ts", F.asc_nulls_last("event_id"), "_file", "_row")
    day = Window.partitionBy("entity", "day")
    b = e.select(
        F.col("event_type").alias("entity"), F.to_date("ts").alias("day"), "ts", "event_id", F.date_format("ts", "HH:mm").alias("hm"), F.col("value").alias("close"),
        F.coalesce(F.lag("value").over(w), F.col("value")).alias("open"), (F.get_json_object("props", "$.k").cast("double") + 1).alias("vol"), (F.row_number().over(w) - 1).alias("pos"),
    )
    return b.select("*", F.greatest("open", "close").alias("high"), F.least("open", "close").alias("low"), (F.col("close") * F.col("vol")).alias("amount"), F.count(F.lit(1)).over(day).alias("n"))


BARS = """bar0 AS (SELECT event_type AS entity, ts::DATE AS day, ts, event_id, strftime(ts, '%H:%M') AS hm, value AS close,
  coalesce(lag(value) OVER w, value) AS open, (props->>'$.k')::DOUBLE + 1 AS vol, row_number() OVER w - 1 AS pos
  FROM events WINDOW w AS (PARTITION BY event_type, ts::DATE ORDER BY ts, event_id)),
bars AS (SELECT *, greatest(open, close) AS high, least(open, close) AS low, close * vol AS amount, count(*) OVER (PARTITION BY entity, day) AS n FROM bar0)"""


def user_days(spark: SparkSession, d: str) -> DataFrame:
    """User x day: entity, date, amount, vol, n_error, n_purchase, last_type."""
    e = load(spark, d, "events")
    return e.groupBy(F.col("user_id").alias("entity"), F.to_date("ts").alias("date")).agg(
        F.sum("value").alias("amount"), F.count(F.lit(1)).alias("vol"), F.count_if(F.col("event_type") == "error").alias("n_error"),
        F.count_if(F.col("event_type") == "purchase").alias("n_purchase"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"),
    )


UD = """ud AS (SELECT user_id AS entity, ts::DATE AS date, sum(value) AS amount, count(*) AS vol, count(*) FILTER (event_type = 'error') AS n_error,
  count(*) FILTER (event_type = 'purchase') AS n_purchase, last(event_type ORDER BY ts, event_id) AS last_type FROM events GROUP BY 1, 2)"""


def foreign_series(spark: SparkSession, d: str) -> DataFrame:
    """Daily order totals: date, total, n."""
    return load(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n"))


FS = "fs AS (SELECT o_orderdate::DATE AS date, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY 1)"


def calendar(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()


CAL = "cal AS (SELECT DISTINCT l_shipdate::DATE AS date FROM lineitem)"


def industry(spark: SparkSession, d: str) -> DataFrame:
    """entity, grp: nation of a supplier."""
    return load(spark, d, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_nationkey").alias("grp"))


IND = "ind AS (SELECT s_suppkey AS entity, s_nationkey AS grp FROM supplier)"


#: Five small trees over (ret, vol, amount) that stand for seeds of a model: (feature, threshold, left, right), a leaf is a number.
TREES = [
    ("ret", 0.0, ("vol", 150.0, 0.42, 0.47), ("amount", 200000.0, 0.55, 0.51)),
    ("ret", 0.01, ("amount", 150000.0, 0.40, 0.46), ("vol", 180.0, 0.56, 0.53)),
    ("vol", 160.0, ("ret", -0.005, 0.41, 0.54), ("ret", 0.008, 0.48, 0.57)),
    ("amount", 220000.0, ("ret", 0.004, 0.43, 0.58), ("ret", -0.01, 0.44, 0.52)),
    ("ret", -0.008, ("vol", 120.0, 0.39, 0.45), ("ret", 0.012, 0.49, 0.59)),
]


def tree_sql(t) -> str:
    return repr(t) if not isinstance(t, tuple) else f"CASE WHEN ({t[0]})::FLOAT::DOUBLE <= {t[1]}::DOUBLE THEN {tree_sql(t[2])} ELSE {tree_sql(t[3])} END"


SC = "sc AS (SELECT entity, date, ret, vol, amount, close, " + ", ".join(f"({tree_sql(t)})::DOUBLE AS pred_{i}" for i, t in enumerate(TREES)) + " FROM dp WHERE ret IS NOT NULL)"
