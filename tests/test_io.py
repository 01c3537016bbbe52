"""Readers, writers and the streaming extension."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelforge.sources import readers, writers
from panelforge.streaming import bars

from .conftest import rows


@pytest.fixture
def panel(spark):
    return spark.createDataFrame([(f"6000{i:02d}.SH", dt.date(2024, 1, 1 + d), float(i + d)) for i in range(12) for d in range(4)], "ts_code string, trade_date date, x double")


def test_day_partitions_prune(spark, panel, tmp_path):
    path = str(tmp_path / "days")
    writers.write_by_date(panel, path)
    writers.write_by_date(panel.where("trade_date = '2024-01-02'").withColumn("x", F.lit(-1.0)), path)  # replaces that day only
    df = readers.day_partitions(spark, path, dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert df.count() == 24 and df.where("x = -1").count() == 12
    assert len(df.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(trade_date" in df._jdf.queryExecution().executedPlan().toString()


def test_buckets_prune(spark, panel, tmp_path):
    path = str(tmp_path / "buckets")
    writers.write_buckets(panel, path, order=("ts_code", "trade_date"))
    df = readers.bucketed(spark, path, ["600001.SH", "600011.SH"])
    assert rows(df.select("ts_code").distinct()) == [("600001.SH",), ("600011.SH",)]
    assert readers.bucketed(spark, path).count() == panel.count()


def test_csv(spark, tmp_path):
    utf, gb = tmp_path / "a.csv", tmp_path / "b.csv"
    utf.write_bytes("﻿code,名称,v\n600000,甲,1.5\n600001,NA,x\n600002,,nan\n".encode())
    gb.write_bytes("code,名称\n600000,甲\n".encode("gb18030"))
    df = readers.read_any(spark, str(utf))
    assert df.columns == ["code", "名称", "v"]
    assert rows(readers.typed_csv(df, ["code", "名称"], ["v", "w"])) == [("600000", "甲", 1.5, None), ("600001", None, None, None), ("600002", None, None, None)]
    assert rows(readers.read_any(spark, str(gb))) == [("600000", "甲")]


def test_files_by_name(spark, panel, tmp_path):
    for code in ("600001", "000002"):
        panel.limit(2).select("trade_date", "x").coalesce(1).write.parquet(str(tmp_path / "in" / f"{code}.parquet"))
    assert readers.scan_or_empty(spark, str(tmp_path / "none"), "k int").count() == 0
    assert readers.first_source(spark, [str(tmp_path / "none"), str(tmp_path / "in" / "600001.parquet")], "k int").count() == 2
    for d in ("20240101", "20240105"):
        (tmp_path / f"signals_{d}.csv").write_text("k\n1\n")
    df = spark.read.option("header", True).csv(str(tmp_path / "*.csv"))
    assert rows(readers.dated_files(df, dt.date(2024, 1, 2)).select("file_date")) == [(dt.date(2024, 1, 5),)]
    csv = spark.read.option("header", True).csv(str(tmp_path / "signals_20240101.csv"))
    assert csv.count() == 1


def test_codecs_and_reports(spark, panel, tmp_path):
    for codec in writers.CODECS:
        writers.write_parquet(panel, str(tmp_path / codec), codec)
        assert readers.scan(spark, str(tmp_path / codec), ["x"]).count() == panel.count()
    with pytest.raises(ValueError, match="codec"):
        writers.write_parquet(panel, str(tmp_path / "bad"), "zip")
    with pytest.raises(ValueError, match="missing"):
        readers.scan(spark, str(tmp_path / "zstd"), ["nope"])
    writers.write_signals(panel, str(tmp_path / "signals"), "trade_date", {"big": F.col("x") > 5})
    assert spark.read.option("header", True).csv(str(tmp_path / "signals/latest")).count() == 12
    assert spark.read.json(str(tmp_path / "signals/context")).count() == 4
    writers.write_run_summary(panel, str(tmp_path / "run"), rows=48)
    assert spark.read.text(str(tmp_path / "run")).first()[0] == '{"rows": 48}'
    bad = panel.withColumn("err", F.when(F.col("x") < 1, "low"))
    assert {r.status for r in writers.coverage(bad, "ts_code", "trade_date", "err").collect()} == {"ok", "error"}
    assert [r.sample_id for r in writers.row_index(panel, "trade_date", "ts_code").orderBy("trade_date", "ts_code").collect()] == list(range(48))
    assert readers.latest(panel, "trade_date").count() == 12 and readers.universe(panel, "ts_code", most=3).count() == 3


def test_stream_of_bars(spark, tmp_path):
    t = dt.datetime(2024, 1, 1, 9, 30)
    ticks = [("a", i, t + dt.timedelta(seconds=20 * i), float(i), 1.0) for i in range(9)] + [("a", 0, t, 0.0, 1.0), ("b", 100, t, 5.0, 2.0), ("a", 200, t + dt.timedelta(hours=1), 1.0, 1.0)]
    schema = "entity string, tick_id long, ts timestamp, price double, vol double"
    spark.createDataFrame(ticks, schema).coalesce(1).write.parquet(str(tmp_path / "ticks"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "ticks"))
    q = bars.minute_bars(stream).writeStream.outputMode("append").format("memory").queryName("bars_out").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.processAllAvailable()
    q.stop()
    got = rows(spark.table("bars_out").select("entity", "open", "high", "low", "close", "vol"))
    assert got == [("a", 0.0, 2.0, 0.0, 2.0, 3.0), ("a", 3.0, 5.0, 3.0, 5.0, 3.0), ("a", 6.0, 8.0, 6.0, 8.0, 3.0), ("b", 5.0, 5.0, 5.0, 5.0, 2.0)]


def test_stream_upsert(spark, tmp_path):
    schema = "k long, v double, seq long"
    for n, part in enumerate(([(1, 1.0, 1), (2, 2.0, 1)], [(2, 5.0, 2), (2, 4.0, 1), (3, 3.0, 2)])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        q = bars.upsert_stream(stream, str(tmp_path / "out"), ["k"], "seq", str(tmp_path / "cp"))
        q.awaitTermination(60)
        assert n >= 0
    assert rows(bars.current(spark, str(tmp_path / "out")).select("k", "v")) == [(1, 1.0), (2, 5.0), (3, 3.0)]
