import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from yearling.functions import metrics
from yearling.functions.dates import nth_weekday, observed_shift
from yearling.functions.numeric import (
    growth,
    lenient_double,
    lenient_long,
    nan_to_null,
    percent,
    strict_total,
)


@pytest.mark.parametrize(
    "text, number, whole",
    [
        ("12", 12.0, 12),
        (" 12 ", 12.0, 12),
        ("-7", -7.0, -7),
        ("12.0", 12.0, 12),
        ("1e3", 1000.0, 1000),
        ("12.5", 12.5, None),
        (".5", 0.5, None),
        ("", None, None),
        ("nan", None, None),
        ("n/a", None, None),
        ("12d", None, None),
        ("0x1p3", None, None),
        ("1e300", 1e300, None),
        ("inf", float("inf"), None),
        (None, None, None),
    ],
)
def test_lenient_casts(spark, text, number, whole):
    df = spark.createDataFrame([(text,)], "c string")
    row = df.selectExpr(f"{lenient_double('c')} as d", f"{lenient_long('c')} as w").first()
    assert (row.d, row.w) == (number, whole)


@pytest.mark.parametrize("bad", ["x", "", "1.5", None])
def test_strict_total_fails_on_a_bad_cell(spark, bad):
    df = spark.createDataFrame([("1", bad)], "a string, b string")
    with pytest.raises(Exception, match="not whole numbers"):
        df.selectExpr(f"{strict_total('t', ['a', 'b'])} as t").collect()


def test_strict_total_adds(spark):
    df = spark.createDataFrame([("1", " 41")], "a string, b string")
    assert df.selectExpr(f"{strict_total('t', ['a', 'b'])} as t").first().t == 42


def test_ratios_by_zero_are_missing(spark):
    df = spark.createDataFrame([(1, 0)], "a bigint, b bigint")
    row = df.selectExpr(f"{percent('a', 'b')} as p", f"{growth('a', 'b')} as g").first()
    assert row.p is None and row.g is None
    assert spark.range(1).selectExpr(f"{nan_to_null('double(\"NaN\")')} as n").first().n is None


def _score(spark, pairs):
    df = spark.createDataFrame(pairs, "y double, p double")
    wanted = [metrics.mae("y", "p"), metrics.rmse("y", "p"), metrics.r2("y", "p")]
    return tuple(df.selectExpr(*wanted).first()), df


def test_metrics_equal_the_evaluator(spark):
    found, df = _score(spark, [(1.0, 1.5), (2.0, 1.0), (4.0, 4.5), (-3.0, 0.0)])
    for value, name in zip(found, ("mae", "rmse", "r2")):
        expected = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name)
        assert value == pytest.approx(expected.evaluate(df))


def test_r2_edges(spark):
    assert _score(spark, [(1.0, 2.0)])[0][2] is None
    assert _score(spark, [(1.0, 1.0), (1.0, 1.0)])[0][2] == 1.0
    assert _score(spark, [(1.0, 1.0), (1.0, 2.0)])[0][2] == 0.0


@pytest.mark.parametrize(
    "expr, expected",
    [
        (nth_weekday("2024", 1, 0, 3), "2024-01-15"),
        (nth_weekday("2024", 5, 0, -1), "2024-05-27"),
        (nth_weekday("2021", 5, 0, -1), "2021-05-31"),
        (nth_weekday("2024", 11, 3, 4), "2024-11-28"),
        (nth_weekday("2025", 9, 0, 1), "2025-09-01"),
        (observed_shift("date'2021-07-04'"), "2021-07-05"),
        (observed_shift("date'2021-12-25'"), "2021-12-24"),
        (observed_shift("date'2024-07-04'"), None),
    ],
)
def test_date_rules(spark, expr, expected):
    assert spark.range(1).select(F.expr(f"string({expr}) as d")).first().d == expected
