import numpy as np
import pytest

from yearling.operators import evaluation as ev
from yearling.operators.quantile import exact_median
from yearling.spec import PanelSpec

SPEC = PanelSpec()


def groups():
    rng = np.random.default_rng(11)
    return {
        "odd": rng.normal(size=501).tolist(),
        "even": rng.lognormal(sigma=8, size=500).tolist(),
        "ties": rng.integers(-2, 3, size=300).astype(float).tolist(),
        "close": (1.0 + rng.random(400) * 1e-12).tolist(),
        "one": [3.5],
        "two": [-1.0, 4.0],
        "zeros": [0.0, -0.0, 0.0, 1.0],
        "wide": [-1e300, -1e-300, 0.0, 1e-300, 1e300, float("inf")],
    }


def test_exact_median_equals_numpy(spark):
    data = groups()
    df = spark.createDataFrame(
        [(g, v) for g, values in data.items() for v in [*values, None, float("nan")]],
        "g string, v double",
    )
    found = {r.g: r.m for r in exact_median(df, ["g"], "v", "m").collect()}
    assert found == {g: float(np.median(values)) for g, values in data.items()}


def scored(spark, rows_):
    df = spark.createDataFrame(
        rows_,
        "test_year int, location_id string, county_name string, feature_year int,"
        " population bigint, future_growth_1yr double, predicted_growth double",
    )
    return ev.with_errors(df, SPEC, "predicted_growth")


def test_errors(spark):
    row = scored(spark, [(1, "a", "A", 1, 200, 0.1, 0.05)]).first()
    assert row.actual_population == pytest.approx(220)
    assert row.predicted_population == pytest.approx(210)
    assert row.population_error == pytest.approx(-10)
    assert row.absolute_population_error == pytest.approx(10)
    assert row.absolute_percentage_error == pytest.approx(10 / 220 * 100)
    assert row.population_error_pct == pytest.approx(-10 / 220 * 100)
    assert row.prediction_error == pytest.approx(-0.05)


def test_vanished_population_has_no_percentage(spark):
    row = scored(spark, [(1, "a", "A", 1, 200, -1.0, 0.0)]).first()
    assert row.absolute_percentage_error is None and row.population_error_pct is None


def test_error_summary_ties_go_to_the_first_name(spark):
    df = scored(
        spark,
        [
            (1, "c", "C", 1, 100, 0.0, 0.5),
            (1, "b", "B", 1, 100, 0.0, 0.5),
            (1, "e", "E", 1, 100, 0.0, -0.5),
            (1, "d", "D", 1, 100, 0.0, -0.5),
        ],
    )
    row = ev.error_summary(df, SPEC).first()
    assert (row.largest_over_label, row.largest_under_label) == ("B", "D")
    assert (row.rows_evaluated, row.max_absolute_error) == (4, 50.0)
    assert row.median_absolute_pct_error == 50.0


def test_persistence_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows_ = [
        (f"l{i}", f"L{i}", y, int(rng.integers(50, 100)), float(a), float(b))
        for i in range(20)
        for y, a, b in zip(range(2015, 2020), rng.normal(size=5), rng.normal(size=5))
    ]
    rows_.append(("x", "X", 2018, 10, None, 0.1))
    panel = spark.createDataFrame(
        rows_,
        "location_id string, county_name string, feature_year int, population bigint,"
        " historical_growth_1yr double, future_growth_1yr double",
    )
    found = {r.test_year: r for r in ev.persistence_metrics(panel, SPEC, [2015, 2017, 2018]).collect()}
    assert set(found) == {2017, 2018}
    for t, r in found.items():
        test = np.array([(p, a, b) for _, _, y, p, a, b in rows_ if y == t and a is not None])
        p, a, b = test.T
        assert r.training_rows == 20 * (t - 2015) and r.test_rows == 20
        assert r.growth_mae == pytest.approx(np.abs(a - b).mean())
        assert r.growth_rmse == pytest.approx(np.sqrt(((a - b) ** 2).mean()))
        assert r.growth_r2 == pytest.approx(1 - ((a - b) ** 2).sum() / ((b - b.mean()) ** 2).sum())
        assert r.population_mae == pytest.approx(np.abs(p * (a - b)).mean())
        assert r.population_mape == pytest.approx((np.abs((a - b) / (1 + b)) * 100).mean())


def test_averages_are_means_of_folds(spark):
    folds = spark.createDataFrame(
        [(2001, 10, 5, 1.0, 1.0, None, 4.0, 1.0), (2002, 15, 1, 3.0, 2.0, 0.5, 8.0, 3.0)],
        "test_year int, training_rows bigint, test_rows bigint, growth_mae double,"
        " growth_rmse double, growth_r2 double, population_mae double, population_mape double",
    )
    row = ev.fold_averages(folds).first()
    assert (row.first_test_year, row.last_test_year, row.years_evaluated) == (2001, 2002, 2)
    assert (row.total_training_rows, row.total_test_rows) == (25, 6)
    assert (row.avg_growth_mae, row.avg_growth_r2, row.avg_population_mae) == (2.0, 0.5, 6.0)


def test_comparison_is_wide(spark):
    rows_ = [(2001, 10, 5, m, v, v, v, v, v) for m, v in (("p", 1.0), ("f", 2.0))]
    folds = spark.createDataFrame(
        rows_,
        "test_year int, training_rows bigint, test_rows bigint, model_name string,"
        " growth_mae double, growth_rmse double, growth_r2 double, population_mae double,"
        " population_mape double",
    )
    wide = ev.comparison(folds, {"p": "baseline", "f": "rf"})
    assert wide.columns == [
        "test_year", "training_rows", "test_rows", "baseline_mae", "rf_mae", "baseline_rmse",
        "rf_rmse", "baseline_r2", "rf_r2", "baseline_population_mae", "rf_population_mae",
        "baseline_mape", "rf_mape",
    ]
    row = ev.comparison_averages(wide).first()
    assert (row.avg_baseline_mae, row.avg_rf_mape, row.years_evaluated) == (1.0, 2.0, 1)
