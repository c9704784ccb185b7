"""Row expressions: nulls, zero denominators, flags."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import (
    blank_when, code_value, flag, gated, member_flag, one_hot, positive_part, ratio, row_mean, row_std, without_nan,
)


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expr).first()[0]


def test_nan_becomes_null_only_in_float_columns(spark, rows):
    df = spark.createDataFrame([(1, float("nan"), "a"), (2, 1.5, None)], "k long, x double, s string")
    assert rows(without_nan(df)) == [(1, None, "a"), (2, 1.5, None)]


def test_sentinel(spark):
    assert one(spark, blank_when("x", 365243), x=365243.0) is None
    assert one(spark, blank_when("x", 365243), x=1.0) == 1.0


@pytest.mark.parametrize("a, b, want", [(1.0, 4.0, 0.25), (1.0, 0.0, None), (0.0, 0.0, None), (None, 2.0, None), (2.0, None, None)])
def test_ratio(spark, a, b, want):
    assert one(spark, ratio("a", "b"), a=a, b=b) == want


@pytest.mark.parametrize("values, mean, std", [
    ((None, None, None), None, None),
    ((0.2, None, None), 0.2, None),
    ((0.2, 0.4, None), 0.3, math.sqrt(0.02)),
    ((1.0, 2.0, 3.0), 2.0, 1.0),
])
def test_row_statistics_skip_nulls(spark, values, mean, std):
    named = dict(zip("abc", values))
    got_mean, got_std = one(spark, row_mean("abc"), **named), one(spark, row_std("abc"), **named)
    assert got_mean == (None if mean is None else pytest.approx(mean))
    assert got_std == (None if std is None else pytest.approx(std))


@pytest.mark.parametrize("x, want", [(3.0, 3.0), (-3.0, 0.0), (None, 0.0)])
def test_positive_part(spark, x, want):
    assert one(spark, positive_part("x"), x=x) == want


def test_flags_are_zero_when_undecidable(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    got = rows(df.select("v", flag(F.col("v") == "a").alias("f"), member_flag("v", ["a", "b"]).alias("m")))
    assert got == [("a", 1, 1), ("b", 0, 1), (None, 0, 0)]


def test_one_hot_is_all_zero_for_null(spark, rows):
    df = spark.createDataFrame([("x",), ("y y",), (None,)], "v string")
    hot = one_hot("v", ["x", "y y"], "v")
    assert list(hot) == ["v_x", "v_y y"]
    assert rows(df.select("v", *[c.alias(n) for n, c in hot.items()])) == [("x", 1, 0), ("y y", 0, 1), (None, 0, 0)]


def test_code_value(spark, rows):
    df = spark.createDataFrame([("C",), ("5",), ("?",), (None,)], "s string")
    got = rows(df.select("s", code_value("s", {"C": 0, "5": 135}).alias("d")))
    assert got == [("5", 135), ("?", None), ("C", 0), (None, None)]


def test_gate(spark, rows):
    df = spark.createDataFrame([(5.0, True), (5.0, False), (5.0, None), (None, True)], "x double, g boolean")
    closed, opened = gated("x", F.col("g"))
    got = rows(df.select("x", "g", closed.alias("c"), opened.alias("o")))
    assert set(got) == {(5.0, True, 0.0, 5.0), (5.0, False, 5.0, 0.0), (5.0, None, 5.0, 0.0), (None, True, None, None)}
