"""Missing values, divisions, keys and types."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelforge.functions import keys, nulls


def one(spark, **cols):
    r = spark.range(1).select(*[v.alias(k) for k, v in cols.items()]).first()
    return r[0] if len(cols) == 1 else tuple(r)


L = F.lit


def null():
    return F.lit(None).cast("double")


def test_nan_and_infinity_become_null(spark):
    assert one(spark, a=nulls.finite(L(math.nan)), b=nulls.finite(L(math.inf)), c=nulls.finite(L(-math.inf)), d=nulls.finite(L(1.5)), e=nulls.finite(null())) == (None, None, None, 1.5, None)
    assert one(spark, a=nulls.to_number(L("x")), b=nulls.to_number(L(" 2.5")), c=nulls.to_number(L("NaN"))) == (None, 2.5, None)


def test_three_divisions(spark):
    assert one(spark, a=nulls.safe_div_eps(L(1.0), L(0.0)), b=nulls.safe_div_eps(L(1.0), null()), c=nulls.safe_div_eps(L(1.0), L(1.0))) == (None, None, 1 / (1 + 1e-9))
    assert one(spark, a=nulls.safe_div_eps(L(1.0), L(-1e-9)))  is None  # the added eps hits zero
    assert one(spark, a=nulls.safe_div_guard(L(1.0), L(1e-13)), b=nulls.safe_div_guard(L(1.0), L(2.0))) == (None, 0.5)
    assert one(spark, a=nulls.cv_ratio(L(1.0), L(0.0)), b=nulls.cv_ratio(L(1.0), L(-2.0))) == (pytest.approx(1e9), 0.5)


def test_bounds_keep_null(spark):
    assert one(spark, a=nulls.null_max(null(), 0.0), b=nulls.null_max(L(-1.0), 0.0), c=nulls.null_min(null(), 0.0), d=nulls.clip(L(9.0), 0.0, 2.0)) == (None, 0.0, None, 2.0)


def test_comparison_with_missing_is_false(spark):
    assert one(spark, a=nulls.is_true(null() > 1), b=nulls.is_true(L(2.0) > 1)) == (False, True)
    assert one(spark, a=nulls.log_nonzero(L(0.0)), b=nulls.log_nonzero(L(-1.0)), c=nulls.log_nonzero(L(1.0))) == (None, None, 0.0)


@pytest.mark.parametrize(("raw", "day"), [("20260717", dt.date(2026, 7, 17)), ("20260717.0", dt.date(2026, 7, 17)), ("2026-07-17", dt.date(2026, 7, 17)), (" 2026/07/17 ", dt.date(2026, 7, 17)), ("2026071", None), ("20261301", None), ("", None), (None, None), ("abc", None)])
def test_dates(spark, raw, day):
    assert one(spark, a=keys.parse_trade_date(L(raw).cast("string"))) == day


def test_codes(spark):
    assert one(spark, a=keys.normalize_code(L("600000")), b=keys.normalize_code(L("900001")), c=keys.normalize_code(L("500001")), d=keys.normalize_code(L(" 000001.sz "))) == ("600000.SH", "900001.SH", "500001.SZ", "000001.SZ")
    assert one(spark, a=keys.normalize_code(L("500001"), panel=True), b=keys.normalize_code(L("1"), panel=True), c=keys.normalize_code(L("1"))) == ("500001.SH", "000001.SZ", "1")
    assert one(spark, a=keys.bucket_id(L("600099.SH")), b=keys.bucket_id(L("000001")), c=keys.bucket_id(L("600099.SH"), 10)) == (19, 0, 9)


def test_contracts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError, match="missing columns"):
        keys.require_columns(df, "k", "x")
    with pytest.raises(Exception, match="duplicate key"):
        keys.assert_unique(df, "k").collect()
    assert keys.assert_unique(df, "k", "v").count() == 2
    assert keys.duplicates(df, "k").collect()[0].n_rows == 2
    assert keys.ensure_columns(df, z="double", v="int").dtypes == [("k", "int"), ("v", "string"), ("z", "double")]
    assert keys.existing(df, ["x", "v"], ("k",)) == ["v", "k"]


def test_flags_are_asymmetric(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "f int")
    assert [r.f for r in df.where(keys.usable("f", False)).collect()] == [0]
    assert sorted([r.f for r in df.where(keys.usable("f", True)).collect()], key=str) == [0, None]


def test_compact(spark):
    df = spark.createDataFrame([(1, 300, 1 << 40, 0.5), (None, -5, 0, None)], "a long, b long, c long, d double")
    assert dict(keys.compact_types(df).dtypes) == {"a": "tinyint", "b": "smallint", "c": "bigint", "d": "float"}
