import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from yearling.functions.names import quoted
from yearling.operators import evaluation as ev
from yearling.operators import models
from yearling.plans import forecast
from yearling.spec import PanelSpec

SPEC = PanelSpec(features=("a", "b", "c"))
FEW = models.ForestParams(trees=24, max_depth=6)


def data(kind, n=60, seed=4):
    """Rows of (id, name, year, population, past, a, b, c, target)."""
    rng = np.random.default_rng(seed)
    a, b = rng.normal(1e5, 2e4, n), rng.normal(0, 0.01, n)
    c = {"free": rng.normal(5, 1, n), "collinear": 100 - a / 1e3, "constant": np.full(n, 3.0)}
    c = c.get(kind, rng.normal(5, 1, n))
    y = 2e-6 * a - 3 * b + 0.1 * c + 0.7
    if kind != "exact":
        y = y + rng.normal(0, 0.05, n)
    if kind == "step":
        y = np.where(c > 5, 1.0, -1.0)
    years = 2000 + np.arange(n) % 5
    return [
        (f"l{i}", f"L{i}", int(years[i]), 1000 + i, float(b[i]), float(a[i]), float(b[i]),
         float(c[i]), float(y[i]))
        for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(
        rows,
        "location_id string, county_name string, feature_year int, population bigint,"
        " historical_growth_1yr double, a double, b double, c double, future_growth_1yr double",
    )


def least_squares(rows, test):
    """Smallest-norm solution on centred rows, as plain numpy."""
    x = np.array([r[5:8] for r in rows if r[2] < test])
    y = np.array([r[8] for r in rows if r[2] < test])
    beta = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=1e-11)[0]
    return y.mean() - x.mean(0) @ beta, beta


@pytest.mark.parametrize("kind", ["free", "collinear", "constant", "exact"])
def test_linear_equals_least_squares(spark, kind):
    rows = data(kind)
    scored = models.linear_rolling(frame(spark, rows), SPEC, [2000, 2002, 2004]).collect()
    assert {r.test_year for r in scored} == {2002, 2004}
    assert len(scored) == 24
    for r in scored:
        intercept, beta = least_squares(rows, r.test_year)
        expected = intercept + np.array([r.a, r.b, r.c]) @ beta
        assert r.predicted_growth == pytest.approx(expected, rel=1e-6, abs=1e-8)


def test_exact_line_is_recovered(spark):
    fit = models.fit_linear(frame(spark, data("exact")), SPEC, [2004])[0]
    assert fit.coefficients == pytest.approx([2e-6, -3, 0.1], rel=1e-6)
    assert fit.intercept == pytest.approx(0.7, rel=1e-5)


def test_linear_equals_the_library_estimator(spark):
    df = frame(spark, data("free"))
    fit = models.fit_linear(df, SPEC, [2003])[0]
    train = VectorAssembler(inputCols=["a", "b", "c"], outputCol="x").transform(
        df.filter("feature_year < 2003")
    )
    known = LinearRegression(
        featuresCol="x", labelCol="future_growth_1yr", solver="normal", regParam=0.0
    ).fit(train)
    assert fit.coefficients == pytest.approx(list(known.coefficients), rel=1e-6)


def test_linear_without_training_rows(spark):
    assert models.fit_linear(frame(spark, data("free")), SPEC, [1999]) == []


def test_linear_validation_report(spark):
    found = forecast.linear_validation(frame(spark, data("exact")), SPEC, [2000, 2003]).collect()
    assert [(r.test_year, r.training_rows, r.test_rows) for r in found] == [(2003, 36, 12)]
    assert found[0].growth_mae == pytest.approx(0, abs=1e-9)


def test_forest_split(spark):
    rows = data("step", n=400)
    forest, scored = forecast.forest_split(frame(spark, rows), SPEC, 2003, 2004, FEW)
    assert forest.trees == 24
    assert sum(forest.importances) == pytest.approx(1.0)
    top = models.feature_importance(forest, SPEC, spark, top=2).collect()
    assert len(top) == 2 and top[0].feature == "c"
    found = scored.collect()
    assert len(found) == 80
    error = np.mean([(r.predicted_growth - r.future_growth_1yr) ** 2 for r in found])
    assert error < 0.2 * np.var([r.future_growth_1yr for r in found])


def test_forest_is_repeatable(spark):
    train = frame(spark, data("free")).coalesce(1)
    once, again = models.fit_forests([(train, 60), (train, 60)], SPEC, FEW)
    guess = [
        [r.predicted_growth for r in models.predict_forest(f, train, SPEC).orderBy("location_id").collect()]
        for f in (once, again)
    ]
    assert guess[0] == guess[1]


def test_forest_does_not_depend_on_how_rows_lie(spark):
    """As after a read by another number of cores: other partitions, another order."""
    rows = data("free", n=300)
    frames = [frame(spark, rows).coalesce(1), frame(spark, rows[::-1]).repartition(7)]
    forests = models.fit_forests([(f, 300) for f in frames], SPEC, FEW)
    # The first line names the object.
    trees = [f.model.toDebugString.split("\n", 1)[1] for f in forests]
    assert trees[0] == trees[1]
    assert forests[0].nodes == forests[1].nodes


def test_rolling_comparison(spark):
    wide = forecast.rolling_comparison(
        frame(spark, data("step", n=200)), SPEC, [2000, 2002, 2004], FEW
    ).orderBy("test_year")
    found = wide.collect()
    assert [(r.test_year, r.training_rows, r.test_rows) for r in found] == [
        (2002, 80, 40),
        (2004, 160, 40),
    ]
    assert all(r.rf_mae < r.baseline_mae for r in found)


def test_guards(spark):
    df = frame(spark, data("free"))
    with pytest.raises(ValueError, match="missing required columns"):
        forecast.model_table(df.drop("a"), SPEC)
    with pytest.raises(ValueError, match="training set"):
        forecast.forest_split(df, SPEC, 1990, 2004, FEW)
    with pytest.raises(ValueError, match="test set"):
        forecast.forest_split(df, SPEC, 2003, 2010, FEW)
    with pytest.raises(ValueError, match="no fold"):
        forecast.rolling_comparison(df, SPEC, [2000], FEW)


def wide_panel(spark, n):
    """Rows that a tree could split to the last: every target differs."""
    return spark.range(n).selectExpr(
        "string(id) as location_id",
        "string(id) as county_name",
        "int(2000 + id % 5) as feature_year",
        "bigint(1000) as population",
        "0.0D as historical_growth_1yr",
        "hash(id) % 100003 / 7.0D as a",
        "hash(id, 1) % 100003 / 7.0D as b",
        "hash(id, 2) % 100003 / 7.0D as c",
        "double(hash(id, 3)) / 1e9 as future_growth_1yr",
    )


def test_model_size_does_not_grow_with_the_rows(spark):
    params = models.ForestParams(trees=8, tree_rows=300)
    sizes = (4_000, 40_000)
    forests = models.fit_forests([(wide_panel(spark, n), n) for n in sizes], SPEC, params)
    nodes = [f.nodes for f in forests]
    assert max(nodes) < 1.1 * min(nodes)
    assert max(nodes) <= 2 * params.trees * params.tree_rows * 1.1
    # Under the default, a training set that a tree can hold is drawn from in full.
    assert models._drawn(wide_panel(spark, 10), 4096, ["location_id"], models.ForestParams())[2] == 1.0


def test_rows_to_draw_from_are_bounded(spark):
    params = models.ForestParams(trees=10, tree_rows=100)
    by = ["location_id", "feature_year"]
    pool, rows, share = models._drawn(wide_panel(spark, 20_000), 20_000, by, params)
    assert (rows, share) == (1000, 0.1)
    assert 800 < pool.count() < 1200
    again = models._drawn(wide_panel(spark, 20_000).repartition(5), 20_000, by, params)[0]
    assert sorted(r.location_id for r in pool.collect()) == sorted(
        r.location_id for r in again.collect()
    )


def test_too_large_a_forest_is_refused(spark):
    with pytest.raises(ValueError, match="over model_mb = 512"):
        models.ForestParams(trees=300, tree_rows=100_000)
    assert models.ForestParams(tree_rows=100_000, min_rows=50).tree_rows == 100_000
    rows = wide_panel(spark, 500)
    params = models.ForestParams(trees=100, tree_rows=500, model_mb=20)
    forest = models.fit_forests([(rows, 500)], SPEC, params)[0]
    # What a node takes in memory is within what is reckoned for it.
    size = spark._jvm.org.apache.spark.util.SizeEstimator.estimate(forest.model._java_obj)
    assert size <= forest.nodes * models._NODE_BYTES * 1.2, (size, forest.nodes)
    small = models.Forest(forest.model, 1)
    with pytest.raises(ValueError, match="is over 1 MB"):
        models.predict_forest(small, rows, SPEC)


ODD = PanelSpec(
    key="the place",
    label="it's `named`",
    time="a year",
    value="how many",
    past="was %",
    target="to be",
    features=("my x", "d.o.t", "select"),
)


@pytest.fixture
def odd_panel(spark):
    names = [ODD.key, ODD.label, ODD.time, ODD.value, ODD.past, *ODD.features, ODD.target]
    return frame(spark, data("free", n=100)).toDF(*names), frame(spark, data("free", n=100))


def numbers(df):
    return [
        tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in sorted(df.collect())
    ]


def test_any_column_names(spark, odd_panel):
    odd, plain = odd_panel
    tests = [2002, 2004]
    for work in (
        lambda df, s: forecast.linear_validation(df, s, tests).drop("first_training_year"),
        lambda df, s: forecast.rolling_comparison(df, s, tests, FEW),
        lambda df, s: ev.persistence_metrics(df, s, tests),
        lambda df, s: ev.error_summary(
            ev.persistence_rows(df, s).selectExpr("*", f"int({quoted(s.time)}) as test_year"), s
        ),
        lambda df, s: forecast.forest_split(df, s, 2003, 2004, FEW)[1].select(
            "predicted_growth", "population_error"
        ),
    ):
        assert numbers(work(odd, ODD)) == numbers(work(plain, SPEC))


def test_listings(spark):
    df = frame(spark, data("step", n=200))
    wide = forecast.rolling_comparison(df, SPEC, [2002, 2004], FEW)
    lines = ev.comparison_lines(wide, ["baseline", "rf"]).orderBy("test_year", "ordinal").collect()
    assert [(r.test_year, r.ordinal) for r in lines] == [
        (t, i) for t in (2002, 2004) for i in (1, 2, 3, 4)
    ]
    row = wide.orderBy("test_year").first()
    assert lines[0].line == (
        f"baseline growth mae={row.baseline_mae:.6f} rmse={row.baseline_rmse:.6f} "
        f"r2={row.baseline_r2:.6f}"
    )
    assert lines[3].line == f"rf population mae={row.rf_population_mae:.0f} mape={row.rf_mape:.2f}%"
    means = ev.summary_lines(ev.persistence_metrics(df, SPEC, [2002, 2004])).collect()
    assert [r.ordinal for r in means] == list(range(1, 8))
    assert means[0].line == "test years 2002-2004" and means[1].line == "years evaluated 2"
