"""Queries that write to the shared folder, read back, and show what came."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelforge.functions import keys
from panelforge.operators import evaluate as ev
from panelforge.operators import orders as od
from panelforge.operators import scoring as sco
from panelforge.sources import readers, writers

from .fixtures import DP, EW, SC, daily_panel
from .q_signals import EN, OS, SG, SIM, CUT, GAIN, HORIZON, sheet
from .registry import load, query

_CODE = "lpad(((c_custkey * 7919) % 1000000)::VARCHAR, 6, '0')"


def r6(c, name=None):
    return F.round(c, 6).alias(name or c)


def coded(spark, d):
    """Customers under six-digit codes: code, c_custkey, c_mktsegment, c_acctbal."""
    code = F.lpad((F.col("c_custkey") * 7919 % 1000000).cast("string"), 6, "0")
    return load(spark, d, "customer").select(code.alias("code"), "c_custkey", "c_mktsegment", "c_acctbal")


@query(f"SELECT {_CODE} AS code, c_mktsegment AS segment, CASE WHEN c_custkey % 3 > 0 THEN round(c_acctbal, 2) END AS balance, CAST(NULL AS DOUBLE) AS absent FROM customer")
def csv_round_trip(spark, d):
    """CSV written, found by its suffix, read as text and typed: keys stay text, literals for missing become null."""
    t = coded(spark, d)
    text = F.when(F.col("c_custkey") % 3 == 0, F.element_at(F.array(*[F.lit(x) for x in ("NA", "nan", "None", "N/A")]), (F.col("c_custkey") % 4 + 1).cast("int"))).otherwise(F.col("c_acctbal").cast("string"))
    path = writers.work_folder(spark, "customers") + ".csv"
    writers.write_csv(t.select("code", F.col("c_mktsegment").alias("segment"), text.alias("balance")), path)
    out = readers.typed_csv(readers.read_any(spark, path), ["code", "segment"], ["balance", "absent"])
    return out.withColumn("balance", F.round("balance", 2))


@query(f"SELECT codec, {_CODE} AS code, round(c_acctbal, 2) AS c_acctbal FROM customer, (SELECT unnest(['zstd', 'snappy', 'lz4', 'none']) AS codec)")
def codec_round_trip(spark, d):
    t, path = coded(spark, d).select("code", "c_acctbal"), writers.work_folder(spark, "codecs")
    for codec in writers.CODECS:
        writers.write_parquet(t, f"{path}/{codec}", codec)
    return ev.union_all(*[readers.read_any(spark, f"{path}/{codec}").select(F.lit(codec).alias("codec"), "code", F.round("c_acctbal", 2).alias("c_acctbal")) for codec in writers.CODECS])


@query("SELECT date AS trade_date, entity, round(CASE WHEN date = '1995-03-01' THEN -amount ELSE amount END, 4) AS amount FROM dp WHERE date BETWEEN '1995-01-01' AND '1995-06-01'", DP)
def day_folders(spark, d):
    """Written by date, one day replaced, a range read back."""
    p = daily_panel(spark, d).select(F.col("date").alias("trade_date"), "entity", "amount")
    path = writers.work_folder(spark, "days")
    writers.write_by_date(p, path)
    writers.write_by_date(p.where("trade_date = '1995-03-01'").withColumn("amount", -F.col("amount")), path)
    return readers.day_partitions(spark, path, dt.date(1995, 1, 1), dt.date(1995, 6, 1)).select("trade_date", "entity", F.round("amount", 4).alias("amount"))


@query(f"SELECT ts_code, substr(ts_code, 5, 2)::INT // 5 AS bucket_id, round(c_acctbal, 2) AS c_acctbal FROM (SELECT {_CODE} AS ts_code, c_acctbal FROM customer)")
def bucket_folders(spark, d):
    """Written by bucket of the code, sorted inside, read back."""
    t, path = coded(spark, d).withColumnRenamed("code", "ts_code"), writers.work_folder(spark, "buckets")
    writers.write_buckets(t, path, order=("ts_code",))
    return readers.bucketed(spark, path).select("ts_code", "bucket_id", F.round("c_acctbal", 2).alias("c_acctbal"))


def _named_files(spark, path, parts):
    """One file for each (name, frame) below ``path``/in."""
    fs = spark._jvm.org.apache.hadoop.fs
    files = fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(fs.Path(f"{path}/in"))
    for name, df in parts:
        writers.write_parquet(df.coalesce(1), f"{path}/tmp")
        made = max(files.listStatus(fs.Path(f"{path}/tmp")), key=lambda s: s.getLen()).getPath()
        files.rename(made, fs.Path(f"{path}/in/{name}.parquet"))
    return f"{path}/in/*.parquet"


@query("SELECT code || CASE WHEN substr(code, 1, 1) IN ('6', '9') THEN '.SH' ELSE '.SZ' END AS ts_code, n_name FROM (SELECT lpad(((n_nationkey * 104729) % 1000000)::VARCHAR, 6, '0') AS code, n_name FROM nation)")
def files_by_entity(spark, d):
    """One file an entity, whose code is in the file's name."""
    n = load(spark, d, "nation").select("n_nationkey", "n_name")
    parts = [(f"{k * 104729 % 1000000:06d}", n.where(F.col("n_nationkey") == k).select("n_name")) for k in range(25)]
    return readers.entity_files(spark, _named_files(spark, writers.work_folder(spark, "entities"), parts)).select("ts_code", "n_name")


@query("SELECT date_trunc('year', date)::DATE AS file_date, entity, date, round(ret, 6) AS ret FROM dp WHERE ret IS NOT NULL AND date_trunc('year', date) BETWEEN '1994-01-01' AND '1997-01-01'", DP)
def files_by_date(spark, d):
    """One file a year, its first day in the name; a range of names is read."""
    path = writers.work_folder(spark, "signals")
    writers.write_parquet(daily_panel(spark, d).where("ret IS NOT NULL").select("date", "entity", "ret"), f"{path}/all")
    p = readers.scan(spark, f"{path}/all")
    years = [r[0] for r in p.select(F.year("date")).distinct().collect()]
    parts = [(f"signals_{y}0101", p.where(F.year("date") == y)) for y in years]
    out = readers.dated_files(spark.read.parquet(_named_files(spark, path, parts)), dt.date(1994, 1, 1), dt.date(1997, 1, 1))
    return out.select("file_date", "entity", "date", r6("ret"))


@query("SELECT 'day' AS part, strftime(date, '%Y%m%d') AS date, count(*) AS n, count(*) FILTER (ret > 0) AS up FROM dp WHERE ret IS NOT NULL GROUP BY date UNION ALL SELECT 'latest', strftime(max(date), '%Y%m%d'), count(*), count(*) FILTER (ret > 0) FROM dp WHERE ret IS NOT NULL AND date = (SELECT max(date) FROM dp WHERE ret IS NOT NULL) UNION ALL SELECT 'context', strftime(date, '%Y%m%d'), count(*), count(*) FILTER (ret > 0) FROM dp WHERE ret IS NOT NULL GROUP BY date", DP)
def signal_files(spark, d):
    """CSV by date, the last date again, and a JSON context row a date."""
    p, path = daily_panel(spark, d).where("ret IS NOT NULL").select("date", "entity", "ret"), writers.work_folder(spark, "output")
    writers.write_signals(p, path, "date", {"up": F.col("ret") > 0})
    up = F.count_if(F.col("ret").cast("double") > 0).alias("up")
    days = spark.read.option("header", True).csv(f"{path}/by_date").groupBy(F.lit("day").alias("part"), F.col("_d").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"), up)
    last = spark.read.option("header", True).csv(f"{path}/latest").groupBy(F.lit("latest").alias("part"), F.date_format("date", "yyyyMMdd").alias("date")).agg(F.count(F.lit(1)).alias("n"), up)
    context = spark.read.json(f"{path}/context").select(F.lit("context").alias("part"), F.date_format("date", "yyyyMMdd").alias("date"), F.col("rows").alias("n"), "up")
    return ev.union_all(days, last, context)


@query("SELECT 1 AS k, 'nationkey' AS a, 'n_name,n_regionkey' AS b UNION ALL SELECT 2, 'p_size', 'p_partkey,p_name,p_brand'")
def existing_columns(spark, d):
    n = load(spark, d, "nation").withColumnRenamed("n_nationkey", "nationkey").select("n_name", "n_regionkey", "nationkey")
    p = load(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    found = [(1, keys.existing(n, ["absent", "nationkey"], ("n_",)), 1), (2, keys.existing(p, ["p_size", "gone"], ("p_",)), 1)]
    return spark.createDataFrame([(k, ",".join(c[:m]), ",".join(c[m:])) for k, c, m in found], "k int, a string, b string")


@query("SELECT o_orderkey, o_custkey, round(o_totalprice::FLOAT, 1) AS price, k1, k2, k3 FROM orders, (SELECT CASE WHEN max(o_orderkey) < 128 THEN 'tinyint' WHEN max(o_orderkey) < 32768 THEN 'smallint' WHEN max(o_orderkey) < 2147483648 THEN 'int' ELSE 'bigint' END AS k1, CASE WHEN max(o_custkey) < 128 THEN 'tinyint' WHEN max(o_custkey) < 32768 THEN 'smallint' WHEN max(o_custkey) < 2147483648 THEN 'int' ELSE 'bigint' END AS k2, 'float' AS k3 FROM orders)")
def compact_types(spark, d):
    out = keys.compact_types(load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))
    kind = {f.name: f.dataType.simpleString() for f in out.schema}
    return out.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_custkey").cast("long").alias("o_custkey"), F.round("o_totalprice", 1).alias("price"), F.lit(kind["o_orderkey"]).alias("k1"), F.lit(kind["o_custkey"]).alias("k2"), F.lit(kind["o_totalprice"]).alias("k3"))


@query("SELECT sg.date AS trade_date, sg.entity AS ts_code, round(ret, 6) AS ret, exit_reason FROM sg LEFT JOIN au ON au.entity = sg.entity AND au.date = sg.date AND sg.entity % 3 > 0", DP, EW, SC, EN, SG, SIM)
def signals_to_targets(spark, d):
    from .q_signals import audited, signals

    s = signals(spark, d).select(F.col("entity").alias("ts_code"), F.col("date").alias("trade_date"))
    t = audited(spark, d).where("entity % 3 > 0").select(F.col("entity").alias("ts_code"), F.col("date").alias("trade_date"), "ret", "exit_reason")
    return ev.join_targets(s, t).select("trade_date", "ts_code", r6("ret"), "exit_reason")


MODEL = """tree
version=v4
feature_names=ret vol amount

Tree=0
num_leaves=3
num_cat=0
split_feature=0 1
threshold=0.01 40.5
decision_type=10 8
left_child=-1 -2
right_child=1 -3
leaf_value=0.25 -0.5 0.75


Tree=1
num_leaves=3
num_cat=0
split_feature=2 0
threshold=90000.5 -0.02
decision_type=2 6
left_child=1 -1
right_child=-2 -3
leaf_value=0.125 -0.25 0.5


end of trees
"""
_MT = """mt AS (SELECT entity, date, ret::FLOAT::DOUBLE AS ret, (CASE WHEN entity % 4 > 0 THEN vol END)::FLOAT::DOUBLE AS vol, (CASE WHEN entity % 5 > 0 THEN amount END)::FLOAT::DOUBLE AS amount FROM dp),
ms AS (SELECT entity, date, CASE WHEN ret IS NULL OR ret <= 0.01 THEN 0.25 WHEN vol IS NOT NULL AND vol <= 40.5 THEN -0.5 ELSE 0.75 END + CASE WHEN coalesce(amount, 0) <= 90000.5 THEN
  CASE WHEN CASE WHEN abs(coalesce(ret, 0)) <= 1e-35 THEN true ELSE ret <= -0.02 END THEN 0.125 ELSE 0.5 END ELSE -0.25 END AS s FROM mt)"""


def _scored(spark, d):
    p = daily_panel(spark, d).select("entity", "date", "ret", F.when(F.col("entity") % 4 > 0, F.col("vol")).alias("vol"), F.when(F.col("entity") % 5 > 0, F.col("amount")).alias("amount"))
    return sco.feature_matrix(p, ["ret", "vol", "amount"])


def _bundle(spark):
    path = writers.work_folder(spark, "model")
    for name, text in (("model.txt", MODEL), ("meta.json", '{"features": ["ret", "vol", "amount"]}')):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
        out.write(bytearray(text.encode()))
        out.close()
    return path


@query("SELECT entity, date, round(1 / (1 + exp(-s::DOUBLE)), 6) AS prob FROM ms", DP, _MT)
def tree_scores_missing(spark, d):
    """A bundle read from a folder; splits that send missing values the default way, or take them for 0."""
    return sco.predict(_scored(spark, d), sco.read_bundle(spark, _bundle(spark)), "prob").select("entity", "date", r6("prob"))


@query("SELECT entity, date, round(1 / (1 + exp(-s::DOUBLE)), 6) AS prob FROM ms", DP, _MT)
def tree_columns_missing(spark, d):
    """The same trees as Columns."""
    trees, _ = sco.parse_text_model(MODEL)
    return _scored(spark, d).select("entity", "date", r6(sco.ensemble_column(trees), "prob"))


@query(f"SELECT 'model.txt' AS name, {len(MODEL)}::BIGINT AS size, sha256('{MODEL}') AS sha256")
def model_digest(spark, d):
    return sco.file_digests(spark, f"{_bundle(spark)}/model.txt")


@query(
    f"""SELECT day AS model, '[' || day || ']' || chr(10) || string_agg(entity || ' | ' || CASE WHEN expire <= 0 THEN 'EXPIRE TODAY' ELSE 'Exp ' || expire END || chr(10) || 'Buy ' || format('{{:,.3f}}', buy) || ' | + ' || format('{{:,.3f}}', gp) || ' | - ' || CASE WHEN cp = -1 THEN 'OPEN' ELSE format('{{:,.3f}}', cp) END, chr(10) ORDER BY entity) AS text
  FROM (SELECT entity, day, round(buy, 0) AS buy, round(buy * (1 + bench + {GAIN}), 0) AS gp, CASE WHEN day = 2 AND coalesce(first_close / buy - 1 - bench <= {CUT}, false) THEN -1 ELSE round(buy * (1 + bench + ({CUT})), 0) END AS cp, ({HORIZON} - holding_days)::INT AS expire, date FROM os0) WHERE date = (SELECT max(date) FROM os0) GROUP BY day""",
    DP, EW, SC, EN, SG, SIM, OS,
)
def push_message(spark, d):
    """The text of the last date's positions, prices to whole units."""
    s = sheet(spark, d)
    s = s.join(F.broadcast(s.agg(F.max("date").alias("date"))), "date")  # one row
    s = s.withColumns({"buy": F.round("buy", 0), "gain_price": F.round("gain_price", 0), "cut_price": F.round("cut_price", 0), "priority": F.lit(None).cast("int"), "expire": F.col("expire").cast("int")})
    return od.message(s, model="day").select(F.col("day").cast("long").alias("model"), "text")
