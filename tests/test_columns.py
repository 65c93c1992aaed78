"""Column expressions and their special cases."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import columns as fx
from riskloom.functions.names import tidy_columns, tidy_name
from riskloom.functions.structs import numeric_fields
from riskloom.operators.metrics import metric_rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1.0, 0.0, None, 3.0), (None, None, None, -2.0), (4.0, 2.0, 6.0, 0.5)], "a double, b double, c double, d double")


def one(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_ratio_with_zero_bottom_is_huge_not_null(df):
    got = one(df, fx.ratio("a", "b"))
    assert got[0] == pytest.approx(1e9) and got[1] is None and got[2] == pytest.approx(2)


def test_clips_keep_nulls(df):
    assert one(df, fx.floor_at("c", 0.0)) == [None, None, 6.0]
    assert one(df, fx.between_zero_one("d")) == [1.0, 0.0, 0.5]
    assert one(df, fx.between_zero_one("c")) == [None, None, 1.0]


def test_row_statistics_skip_nulls(df):
    cols = ["a", "b", "c"]
    assert one(df, fx.row_sum(cols)) == [1.0, 0.0, 12.0]
    assert one(df, fx.row_mean(cols)) == [0.5, None, 4.0]
    assert one(df, fx.row_min(cols)) == [0.0, None, 2.0]
    assert one(df, fx.row_range(cols)) == [1.0, None, 4.0]
    assert one(df, fx.row_product(cols)) == [None, None, 48.0]
    std = one(df, fx.row_std(cols))
    assert std[0] == pytest.approx(0.5) and std[1] is None and std[2] == pytest.approx(math.sqrt(8 / 3))


def test_placeholder_and_lenient_cast(spark):
    df = spark.createDataFrame([("3",), ("x",), (None,)], "s string")
    assert one(df, fx.row_sum(["s"])) == [3.0, 0.0, 0.0]
    assert one(df, fx.blank_value("s", "x")) == ["3", None, None]


def test_invalid_numbers(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.5,)], "v double")
    kind = df.schema["v"].dataType
    assert one(df, fx.is_invalid_number("v", kind)) == [True, True, True, False, False]
    assert one(df, fx.finite_or("v", kind)) == [0.0, 0.0, 0.0, 0.0, 2.5]


def test_decisions_differ_on_the_cut(spark):
    df = spark.createDataFrame([(0.5,), (0.6,)], "p double")
    assert one(df, fx.strictly_above("p", F.lit(0.5))) == [0, 1]
    assert one(df, fx.at_or_above("p", F.lit(0.5))) == [1, 1]


def test_names(spark):
    assert tidy_name("Secondary / secondary special") == "Secondary_secondary_special"
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `__c` int")
    assert tidy_columns(df).columns == ["a_b", "c"]
    with pytest.raises(ValueError, match="collide"):
        tidy_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a/b` int"))


def test_numeric_fields(spark):
    report = metric_rows(spark, {"ranking": {"roc_auc": 0.8, "rows": 3}, "name": "model", "flag": True, "none": None})
    assert [tuple(r) for r in report.collect()] == [("ranking.roc_auc", 0.8), ("ranking.rows", 3.0)]
    df = spark.createDataFrame([(1, (2.0, (3, "x")))], "k int, r struct<a: double, b: struct<c: int, d: string>>")
    assert {(r.metric, r.value) for r in numeric_fields(df, "k").collect()} == {("r.a", 2.0), ("r.b.c", 3.0)}
