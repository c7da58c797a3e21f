"""Scalar rules that are easy to get wrong."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from nudgelab.functions import scalars as S


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_elapsed_days_are_floored(spark):
    late, early = ts("2024-01-06 10:00:00"), ts("2024-01-01 23:00:00")
    assert one(spark, S.floor_days(early, late), S.floor_days(late, early)) == (4, -5)
    assert one(spark, S.floor_days(early, early + F.expr("INTERVAL '3' DAY"))) == (3,)


def test_division_guard(spark):
    a, zero, null = F.lit(3.0), F.lit(0.0), F.lit(None).cast("double")
    assert one(
        spark,
        S.guarded_div(a, zero),
        S.guarded_div(a, F.lit(2.0)),
        S.guarded_div(null, F.lit(2.0)),
        S.guarded_div(a, null),
    ) == (0.0, 1.5, None, None)


def test_lower_clip_keeps_null(spark):
    assert one(
        spark, S.at_least(F.lit(0), 1), S.at_least(F.lit(5), 1),
        S.at_least(F.lit(None).cast("int"), 1),
    ) == (1, 5, None)


def test_lenient_and_strict_dates(spark):
    assert one(spark, S.lenient_timestamp(F.lit("not a date"))) == (None,)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, S.strict_timestamp(F.lit("not a date")))


def test_quarters(spark):
    day = ts("2018-11-30 00:00:00")
    assert one(spark, S.quarter_label(day), S.quarter_index(day)) == ("2018Q4", 2018 * 4 + 4)
    assert one(spark, S.quarter_label(F.lit(None).cast("timestamp_ntz"))) == (None,)


def test_sanitize(spark):
    rows = [(1, float("inf"), 0.1234565, None), (2, float("-inf"), 0.1234575, 7)]
    df = spark.createDataFrame(rows, "k long, a double, `b.c` double, n long")
    out = {r["k"]: r for r in S.sanitize_numerics(df, exclude=("k",)).collect()}
    assert (out[1]["a"], out[2]["a"]) == (1e9, -1e9)
    assert (out[1]["b.c"], out[2]["b.c"]) == (0.123456, 0.123458)
    assert out[1]["n"] is None
    filled = S.sanitize_numerics(df, exclude=("k",), na_fill=0.0).where("k = 1").first()
    assert filled["n"] == 0


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "x")], "a double, b string")
    assert S.drop_nan(df).first()["a"] is None


def test_sums_keep_small_and_large_values(spark):
    df = spark.createDataFrame([(0.00004, 1e15, None)] * 10_000, "a double, b double, c double")
    row = df.repartition(7).agg(*[S.total(F.col(c)).alias(c) for c in "abc"])
    out = S.sanitize_numerics(row).first()
    assert out["a"] == 0.4 and out["c"] == 0.0 and row.first()["b"] == 1e19
    wild = spark.createDataFrame([(float("inf"),), (1.0,)], "a double")
    assert wild.agg(S.total(F.col("a"))).first()[0] == float("inf")
