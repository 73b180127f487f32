import random

import pytest

from yearling.functions.names import quoted
from yearling.functions.names import text as text_literal
from yearling.operators import folds as folds_module
from yearling.operators.folds import (
    earlier_totals,
    every_fold,
    expanding_folds,
    fold_counts,
    fold_rows,
)
from yearling.operators.joins import last_per_key, lookup_join, unmatched
from yearling.operators.panel import (
    complete_rows,
    create_growth_view,
    known_target,
    require_columns,
    require_rows,
    time_split,
    with_growth,
)
from yearling.sources.tables import append, create_table
from yearling.spec import PanelSpec

SPEC = PanelSpec()


def test_lookup_join_takes_the_last_and_drops_the_rest(spark, rows):
    main = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, m int")
    lookup = spark.createDataFrame(
        [("a", 0, "old"), ("a", 5, "new"), ("b", 1, "only"), ("z", 1, "none")],
        "k string, position bigint, v string",
    )
    joined = lookup_join(main, lookup, ["k"], "position")
    assert rows(joined) == [("a", 1, "new"), ("b", 2, "only")]
    assert rows(unmatched(main, lookup, ["k"])) == [("c", 3)]


def test_one_per_key_is_cut_before_the_shuffle(spark, plan):
    lookup = spark.range(1000).selectExpr("id % 2 as k", "id as position", "id as v")
    assert plan(last_per_key(lookup, ["k"], "position")).count("WindowGroupLimit") == 2


@pytest.fixture
def large_joins(spark):
    """No broadcast, and a skew limit that small test data passes."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("join", ["lookup", "unmatched"])
def test_a_hot_main_key_is_split(spark, large_joins, plan, join):
    # Key 0 holds a third of the main rows.
    main = spark.range(0, 120_000, 1, 8).selectExpr("if(id % 3 = 0, 0, id) as k", "uuid() as m")
    lookup = spark.range(1000).selectExpr("id as k", "id as position", "id as v")
    if join == "lookup":
        joined, expected = lookup_join(main, lookup, ["k"], "position"), 40_000 + 666
    else:
        joined, expected = unmatched(main, lookup.filter("k > 0"), ["k"]), 120_000 - 666
    counted = joined.selectExpr("k", "m")
    assert len(counted.toPandas()) == expected
    assert "skew=true" in plan(counted)


def panel(spark, rows_):
    return spark.createDataFrame(
        rows_, "location_id string, county_name string, feature_year int, population bigint"
    )


def test_growth_ends_gaps_and_zeros(spark, rows):
    df = panel(
        spark,
        [
            ("a", "A", 2000, 100),
            ("a", "A", 2001, 110),
            ("a", "A", 2003, 120),
            ("b", "B", 2000, 0),
            ("b", "B", 2001, 5),
        ],
    )
    found = rows(with_growth(df, SPEC), "location_id", "feature_year", SPEC.past, SPEC.target)
    assert found == [
        ("a", 2000, None, 110 / 100 - 1),
        ("a", 2001, 110 / 100 - 1, None),
        ("a", 2003, None, None),
        ("b", 2000, None, None),
        ("b", 2001, None, None),
    ]


def test_growth_does_not_depend_on_the_span(spark, rows):
    rng = random.Random(5)
    data = [
        (k, k, y, rng.randint(1, 50)) for k in "abc" for y in range(-20, 40) if rng.random() < 0.8
    ]
    df = panel(spark, data)
    wide = rows(with_growth(df, SPEC, span=1024))
    assert rows(with_growth(df, SPEC, span=1)) == wide
    assert rows(with_growth(df, SPEC, span=7)) == wide
    assert len(wide) == len(data)


def test_complete_rows_drop_null_and_nan(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (None, 1.0), (float("nan"), 1.0), (1.0, None)],
        "x double, future_growth_1yr double",
    )
    assert complete_rows(df, ["x", SPEC.target]).count() == 1
    assert known_target(df, SPEC).count() == 3


def test_time_split(spark, rows):
    df = spark.range(2020, 2026).selectExpr("int(id) as y")
    assert rows(time_split(df, "y", 2022, 2023)) == [
        (2020, "train"),
        (2021, "train"),
        (2022, "train"),
        (2023, "test"),
    ]


def test_guards(spark):
    df = spark.range(0)
    with pytest.raises(ValueError, match="missing required columns: \\['x'\\]"):
        require_columns(df, ["id", "x"])
    with pytest.raises(ValueError, match="nothing: no rows"):
        require_rows(df, "nothing")
    assert require_rows(require_columns(spark.range(1), ["id"]), "x").count() == 1


def test_folds_equal_brute_force(spark):
    rng = random.Random(3)
    years = [rng.choice([2000, 2001, 2002, 2004, 2005]) for _ in range(200)]
    df = spark.createDataFrame([(y,) for y in years], "y int")
    tests = [2000, 2001, 2003, 2005]
    found = {r.test_year: r for r in expanding_folds(df, "y", tests).collect()}
    # 2000 has no earlier row, 2003 no row of its own.
    assert set(found) == {2001, 2005}
    for t, r in found.items():
        past = [y for y in years if y < t]
        assert (r.training_rows, r.test_rows) == (len(past), years.count(t))
        assert (r.first_training_year, r.last_training_year) == (min(past), max(past))


def test_fold_rows_never_train_on_the_test_year(spark, plan):
    df = spark.range(2000, 2006).selectExpr("int(id) as y")
    folds = fold_rows(df, "y", [2003, 2005])
    assert folds.filter("role = 'train' and y >= test_year").count() == 0
    assert folds.filter("role = 'test' and y <> test_year").count() == 0
    assert folds.count() == 4 + 6
    assert "Join" not in plan(folds)


def test_building_a_join_runs_nothing(spark):
    main = spark.range(100).selectExpr("id % 10 as k", "id as v")
    lookup = spark.range(50).selectExpr("id % 7 as k", "id as at", "id * 2 as w")
    spark.sparkContext.setJobGroup("building", "no job is expected")
    found = lookup_join(main, lookup, ["k"], "at")
    missing = unmatched(main, lookup, ["k"])
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    spark.sparkContext.setJobGroup("running", "")
    assert (found.count(), missing.count()) == (70, 30)


def test_fold_counts_with_odd_names(spark, plan):
    df = spark.range(60).selectExpr("id % 4 as `it's a key`", "int(2000 + id % 6) as `my time`")
    found = fold_counts(df, "it's a key", "my time", [2002, 2005])
    rows = [(r["it's a key"], r["my time"]) for r in df.collect()]
    expected = {
        (k, t): (
            sum(1 for a, b in rows if a == k and b < t),
            sum(1 for a, b in rows if a == k and b == t),
        )
        for k in range(4)
        for t in (2002, 2005)
    }
    assert {
        (r["it's a key"], r.test_year): (r.training_rows, r.test_rows) for r in found.collect()
    } == {key: n for key, n in expected.items() if any(n)}
    # The repetition follows the first aggregate, so it is of counts.
    text = plan(found)
    assert text.index("Generate explode") < text.rindex("HashAggregate")


def test_quoted_names_and_texts(spark):
    odd = "o'neil `x` \\ \"y\""
    df = spark.createDataFrame([(1,)], "v int").withColumnRenamed("v", odd)
    row = df.selectExpr(f"{quoted(odd)} as v", f"{text_literal(odd)} as t").first()
    assert (row.v, row.t) == (1, odd)


def test_many_folds_equal_few(spark, monkeypatch):
    """Ten thousand daily folds: one row each, as the repetition gives them."""
    days = spark.range(10_000).selectExpr("int(id + id div 7) as d", "id % 5 as n", "id * 2 as m")
    found = every_fold(days, "d", "n", carry=["m"])
    expected, before, first, last = [], 0, None, None
    for r in sorted(days.collect()):
        if before and r.n:
            expected.append((r.d, before, r.n, first, last, r.m))
        before, first, last = before + r.n, r.d if first is None else first, r.d
    assert sorted(map(tuple, found.collect())) == expected
    tests = list(range(0, 400, 3))
    rows = days.filter("d < 400 and n > 0").selectExpr("d", "explode(sequence(1, n)) as x")
    scanned = sorted(expanding_folds(rows, "d", tests).collect())
    monkeypatch.setattr(folds_module, "FEW", 1000)
    repeated = expanding_folds(rows, "d", tests)
    assert scanned == sorted(repeated.collect())
    assert scanned[0].asDict().keys() == repeated.first().asDict().keys()


@pytest.mark.parametrize("span", [1, 3, 1024])
def test_earlier_totals_do_not_depend_on_the_span(spark, rows, span):
    df = spark.createDataFrame(
        [(3, 1, 1.5), (-9, 2, 0.5), (4, None, 2.0), (100, 5, None), (None, 9, 9.0)],
        "`my time` int, `the n` bigint, x double",
    )
    found = earlier_totals(df, "my time", ["the n", "x"], span)
    assert rows(found, "my time", "before_the n", "before_x", "first_before", "last_before") == [
        (-9, 0, 0.0, None, None),
        (100, 3, 4.0, -9, 4),
        (3, 2, 0.5, -9, -9),
        (4, 3, 2.0, -9, 3),
    ]


def test_daily_scan_reads_dates_and_sorts_no_day_alone(spark, plan):
    days = spark.sql(
        "select explode(sequence(date '2000-01-01', date '2009-12-31')) as day, 2L as n"
    )
    found = every_fold(days, "day", "n", fold="test_day")
    assert found.count() == 3652
    last = found.orderBy("test_day", ascending=False).first()
    assert (last.training_rows, str(last.last_training_year)) == (2 * 3652, "2009-12-30")
    # The one window over everything sees a row for each span.
    assert "Window" in plan(found) and "cartesian" not in plan(found).lower()


@pytest.fixture
def growth_table(spark, tmp_path):
    data = [(f"p{i % 5}", 2000 + i // 5, f"P{i % 5}", 50 + i * i % 31) for i in range(60) if i % 7]
    df = spark.createDataFrame(
        data, "location_id string, feature_year int, county_name string, population bigint"
    )
    create_table(
        spark, "growth_rows", df.schema, ["location_id", "feature_year"], ["feature_year"],
        str(tmp_path / "rows"),
    )
    append(df, "growth_rows")
    create_growth_view(spark, "growth_seen", "growth_rows", SPEC)
    yield df
    spark.sql("DROP VIEW growth_seen")
    spark.sql("DROP TABLE growth_rows")


def test_growth_view_equals_the_window(spark, rows, growth_table):
    names = ["location_id", "feature_year", "population", SPEC.past, SPEC.target]
    seen = spark.sql("select * from growth_seen")
    assert rows(seen, *names) == rows(with_growth(growth_table, SPEC), *names)
    assert spark.catalog.tableExists("growth_seen")
    # New rows are seen at once.
    more = growth_table.limit(1).selectExpr(
        "'new' as location_id", "feature_year", "county_name", "population"
    )
    append(more, "growth_rows")
    assert spark.table("growth_seen").filter("location_id = 'new'").count() == 1


def test_growth_view_reads_the_years_asked_for(spark, growth_table):
    asked = spark.sql("select * from growth_seen where feature_year = 2005")
    text = asked._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("= 2005" in line for line in scans)
    assert len(asked.inputFiles()) <= 3 * spark.table("growth_rows").rdd.getNumPartitions()
    assert {r.feature_year for r in asked.collect()} == {2005}


def test_growth_view_of_other_names(spark, tmp_path):
    df = spark.createDataFrame([("a", 2000, 10), ("a", 2001, 15)], "k string, `the year` bigint, population bigint")
    create_table(spark, "other_rows", df.schema, path=str(tmp_path / "o"))
    append(df, "other_rows")
    create_growth_view(
        spark, "other_seen", "other_rows", SPEC, key="upper(k)", time="int(`the year`)"
    )
    found = spark.sql("select location_id, feature_year, historical_growth_1yr from other_seen")
    assert sorted(map(tuple, found.collect()), key=str) == [("A", 2000, None), ("A", 2001, 0.5)]
    with pytest.raises(ValueError, match="already"):
        create_growth_view(spark, "again", "other_seen", SPEC, key="k")
    spark.sql("DROP VIEW other_seen")
    spark.sql("DROP TABLE other_rows")
