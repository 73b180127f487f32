"""Every operator as a query over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearling.functions import metrics
from yearling.functions.numeric import lenient_double, lenient_long, percent, strict, strict_total
from yearling.operators import calendar, models, quality, runs
from yearling.operators import evaluation as ev
from yearling.operators.folds import every_fold, expanding_folds, fold_counts
from yearling.operators.joins import lookup_join, unmatched
from yearling.operators.load import insert_skip_existing, table_profile
from yearling.operators.panel import (
    complete_rows,
    create_growth_view,
    known_target,
    time_split,
)
from yearling.operators.quantile import exact_median
from yearling.plans import county, forecast
from yearling.plans.county_documents import county_counts, main_documents, mobility_documents
from yearling.plans.order_activity import (
    PRIORITIES,
    SPEC,
    STATUSES,
    TEST_YEARS,
    cents,
    customer_counts,
    customer_panel,
    place_panel,
    table,
    yearly_orders,
)
from yearling.schemas import ACTUAL_VS_PREDICTED, COUNTY_YEAR
from yearling.sources.matrix import parse_matrix, read_documents, unpack, unpack_lines
from yearling.sources.staging import fresh_path, staged
from yearling.sources.tables import append, create_table, create_table_like, update_by_key

FOREST = models.ForestParams()


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Double columns rounded, as their sums depend on the order of rows."""
    return df.selectExpr(
        *[f"round({n}, {digits}) as {n}" if kind == "double" else n for n, kind in df.dtypes]
    )


# --- panel and folds -----------------------------------------------------------


def rolling_persistence_eval(spark: SparkSession, sf: str) -> DataFrame:
    panel = place_panel(spark, sf, by_segment=False)
    return rounded(ev.persistence_metrics(panel, SPEC, TEST_YEARS)).orderBy("test_year")


def customer_persistence_eval(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.persistence_metrics(customer_panel(spark, sf), SPEC, TEST_YEARS))


def panel_growth(spark: SparkSession, sf: str) -> DataFrame:
    return customer_panel(spark, sf).select(*SPEC.persistence_columns)


def complete_panel_rows(spark: SparkSession, sf: str) -> DataFrame:
    known = known_target(place_panel(spark, sf).select(*SPEC.model_columns), SPEC)
    return rounded(complete_rows(known, [*SPEC.features, SPEC.target]))


def _customer_complete(spark: SparkSession, sf: str) -> DataFrame:
    wanted = customer_panel(spark, sf).select(*SPEC.persistence_columns)
    return complete_rows(wanted, [SPEC.past, SPEC.target])


def expanding_fold_counts(spark: SparkSession, sf: str) -> DataFrame:
    return expanding_folds(_customer_complete(spark, sf), SPEC.time, TEST_YEARS)


def fold_membership(spark: SparkSession, sf: str) -> DataFrame:
    return fold_counts(_customer_complete(spark, sf), "location_id", SPEC.time, TEST_YEARS)


def daily_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Every day with orders as a fold of its own, trained on all days before it."""
    daily = _orders_by_day(spark, sf)
    return every_fold(daily, "order_date", "orders", fold="test_day").withColumnsRenamed(
        {"first_training_year": "first_training_day", "last_training_year": "last_training_day"}
    )


def customer_time_split(spark: SparkSession, sf: str) -> DataFrame:
    split = time_split(_customer_complete(spark, sf), SPEC.time, 1998, 1999)
    return split.select("location_id", "feature_year", "role")


# --- metrics and summaries -----------------------------------------------------


def _customer_scored(spark: SparkSession, sf: str) -> DataFrame:
    return ev.persistence_rows(customer_panel(spark, sf), SPEC)


def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [
        "count(*) as n_rows",
        f"{metrics.mae(SPEC.target, SPEC.past)} as mae",
        f"{metrics.rmse(SPEC.target, SPEC.past)} as rmse",
        f"{metrics.r2(SPEC.target, SPEC.past)} as r2",
    ]
    found = (
        place_panel(spark, sf)
        .select(*SPEC.persistence_columns)
        .na.drop(subset=[SPEC.past, SPEC.target])
        .groupBy("location_id", "county_name")
        .agg(*[F.expr(w) for w in wanted])
    )
    return rounded(found)


def population_errors(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [
        "actual_population",
        "predicted_population",
        "population_error",
        "absolute_population_error",
        "absolute_percentage_error",
        "population_error_pct",
        "prediction_error",
    ]
    return rounded(
        _customer_scored(spark, sf).select("location_id", "feature_year", *wanted)
    )


def error_summary(spark: SparkSession, sf: str) -> DataFrame:
    scored = ev.persistence_rows(place_panel(spark, sf), SPEC)
    tests = scored.filter(F.col(SPEC.time).isin(TEST_YEARS)).selectExpr(
        "*", f"{SPEC.time} as test_year"
    )
    return rounded(ev.error_summary(staged(tests, "scored"), SPEC))


def median_price(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return exact_median(lines, ["l_returnflag"], "l_extendedprice", "median_price")


def fold_averages(spark: SparkSession, sf: str) -> DataFrame:
    folds = ev.persistence_metrics(place_panel(spark, sf), SPEC, TEST_YEARS)
    return rounded(ev.fold_averages(folds))


def fold_lines(spark: SparkSession, sf: str) -> DataFrame:
    folds = ev.persistence_metrics(place_panel(spark, sf, by_segment=False), SPEC, TEST_YEARS)
    return ev.fold_lines(folds).select("test_year", "line").orderBy("test_year")


def target_range(spark: SparkSession, sf: str) -> DataFrame:
    return customer_panel(spark, sf).selectExpr(
        "count(*) as panel_rows",
        f"min({SPEC.time}) as first_year",
        f"max({SPEC.time}) as last_year",
        f"min({SPEC.target}) as lowest_target",
        f"max({SPEC.target}) as highest_target",
    )


# --- sources and features ------------------------------------------------------


def _customer_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Header-and-rows texts of at most 100 customers each, with odd rows.

    `V` is a header twice; every tenth row is short and every tenth cell null.
    """
    cells = f"""array(c_name, 'first', if(c_custkey % 10 = 5, null, c_mktsegment),
                      string({cents('c_acctbal')}))"""
    short = f"if(c_custkey % 10 = 3, slice({cells}, 1, 2), {cells})"
    rows = "transform(array_sort(collect_list(_row)), r -> r.cells)"
    header = "array(array('NAME', 'V', 'SEGMENT', 'V'))"
    return (
        table(spark, sf, "customer")
        .selectExpr("c_custkey div 100 as year", f"struct(c_custkey, {short} as cells) as _row")
        .groupBy("year")
        .agg(F.expr(f"to_json(concat({header}, {rows})) as value"))
        .selectExpr("value", "year", "'07' as state")
    )


_CUSTOMER_CELLS = {"name": "NAME", "segment": "SEGMENT", "balance": "V"}


def matrix_unpack(spark: SparkSession, sf: str) -> DataFrame:
    return unpack(
        _customer_documents(spark, sf),
        parse_matrix("value"),
        _CUSTOMER_CELLS,
        keep=["year"],
        strict=False,
    )


def matrix_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Land a file per year and state, then read all of them at once."""
    path = fresh_path(spark, "documents")
    main_documents(county_counts(spark, sf)).write.partitionBy("year", "state").text(path)
    return unpack(
        read_documents(spark, path),
        parse_matrix("value"),
        county.MAIN_CELLS,
        keep=["year", "state"],
    ).drop("position")


def matrix_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The same files with a row per line, read in splits."""
    path = fresh_path(spark, "document-lines")
    spread = r"regexp_replace(value, r'\],\[', '],\n[') as value"
    documents = main_documents(county_counts(spark, sf)).selectExpr(spread, "year", "state")
    documents.write.partitionBy("year", "state").text(path)
    return unpack_lines(spark, path, county.MAIN_CELLS).drop("position")


def _dirty_cells(spark: SparkSession, sf: str) -> DataFrame:
    cell = """case event_id % 8 when 0 then k when 1 then '' when 2 then 'nan'
                 when 3 then event_type when 4 then concat(k, 'd') when 5 then concat(' ', k, ' ')
                 when 6 then concat(k, '.5') end as cell"""
    return (
        table(spark, sf, "events")
        .selectExpr("event_id", "event_type", r"regexp_extract(props, r'(\d+)', 1) as k")
        .selectExpr("event_id", cell)
    )


def coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _dirty_cells(spark, sf).selectExpr(
        "event_id", f"{lenient_double('cell')} as number", f"{lenient_long('cell')} as whole"
    )


def strict_sums(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    texts = table(spark, sf, "lineitem").selectExpr(
        *keys,
        "string(l_partkey) as a",
        "string(l_suppkey) as b",
        "concat(' ', string(l_orderkey)) as c",
    )
    return texts.selectExpr(
        *keys,
        f"{strict_total('added', ['a', 'b', 'c'])} as added",
        f"{strict('difference', '{0} - {1}', ['a', 'b'])} as difference",
    )


def ratio_features(spark: SparkSession, sf: str) -> DataFrame:
    return customer_counts(spark, sf).selectExpr(
        "location_id",
        "feature_year",
        f"{percent('n_open', 'population')} as pct_open",
        f"{percent('n_finished', 'n_urgent')} as finished_per_urgent",
        f"{percent('n_low', 'n_low + n_high')} as pct_low_of_both",
    )


def _user_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "user_id as o_custkey", "event_id", "event_type", "value"
    )


def lookup_join_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return lookup_join(orders, _user_events(spark, sf), ["o_custkey"], "event_id")


def unmatched_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return unmatched(orders, _user_events(spark, sf), ["o_custkey"])


def ranked_by_rate(spark: SparkSession, sf: str) -> DataFrame:
    rate = f"{percent('n_finished', 'n_urgent')} as rate"
    return (
        customer_counts(spark, sf)
        .selectExpr("county_name", "feature_year", "population", "n_finished", rate)
        .orderBy(F.desc_nulls_last("rate"), "county_name", "feature_year")
    )


def county_records(spark: SparkSession, sf: str) -> DataFrame:
    counted = county_counts(spark, sf)
    return county.county_records(main_documents(counted), mobility_documents(counted))


# --- quality -------------------------------------------------------------------


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """The checks of every landed year; one landed by the main source alone has no records."""
    counted = county_counts(spark, sf)
    main, mobility = main_documents(counted), mobility_documents(counted)
    mobility = mobility.filter("year <> 2000")
    records = staged(county.county_records(main, mobility), "county-records")
    return county.check(records, county.landed_years(main, mobility), expected_rows=25)


def dq_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return quality.verdict(dq_report(spark, sf))


def unmatched_counties(spark: SparkSession, sf: str) -> DataFrame:
    counted = county_counts(spark, sf)
    return county.unmatched_counties(main_documents(counted), mobility_documents(counted))


def county_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Load the years in turn, twice: the checks stop both runs at the first bad year."""
    counted = county_counts(spark, sf)
    main, mobility = main_documents(counted), mobility_documents(counted)
    records = staged(county.county_records(main, mobility), "county-records")
    name, path = _scratch_table(spark, "county_year")
    create_table(spark, name, COUNTY_YEAR, key=county.KEY, partition_by=["year"], path=path)
    for _ in range(2):
        try:
            county.backfill(records, name, county.landed_years(main, mobility), expected_rows=25)
        except ValueError as problem:
            if "data quality failed" not in str(problem):
                raise
    return spark.table(name)


def _broken_main(documents: DataFrame) -> DataFrame:
    """The document of 1997 cut off, that of 1999 without a wanted header, that of 2000 empty."""
    broken = """case year when 1997 then left(value, length(value) - 9)
        when 1999 then replace(value, 'B01001_003E', 'B01001_003X') when 2000 then '[]'
        else value end as value"""
    return documents.selectExpr(broken, "year", "state")


def _broken_sources(spark: SparkSession, sf: str) -> tuple[county.CountySources, DataFrame]:
    counted = county_counts(spark, sf)
    main, mobility = _broken_main(main_documents(counted)), mobility_documents(counted)
    found = county.county_sources(main, mobility)
    return found, county.landed_years(main, mobility)


def county_backfill_broken(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of three years cannot be read: the years before the first are loaded."""
    sources, landed = _broken_sources(spark, sf)
    records = staged(sources.records, "county-records")
    name, path = _scratch_table(spark, "county_year")
    create_table(spark, name, COUNTY_YEAR, key=county.KEY, partition_by=["year"], path=path)
    for _ in range(2):
        try:
            county.backfill(records, name, landed, None, sources.problems)
        except county.BackfillStopped as stopped:
            if "1997: source main of ST: not JSON" not in str(stopped):
                raise
    return spark.table(name)


def dq_verdict_broken(spark: SparkSession, sf: str) -> DataFrame:
    """What fails of each year, documents that cannot be read among it."""
    sources, landed = _broken_sources(spark, sf)
    records = staged(sources.records, "county-records")
    return quality.verdict(county.check(records, landed, None, sources.problems))


def dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").selectExpr(
        "year(l_shipdate) as ship_year", "l_orderkey", "l_linenumber"
    )
    return quality.duplicate_counts(lines, "ship_year", ["l_orderkey", "l_linenumber"])


def _row_checks(df: DataFrame, batch: str, checks: list[quality.RowCheck]) -> DataFrame:
    return quality.row_check_counts(df, batch, checks)


def dq_missing(spark: SparkSession, sf: str) -> DataFrame:
    checks = [quality.not_missing(c) for c in (*SPEC.persistence_columns,)]
    return _row_checks(customer_panel(spark, sf), "feature_year", checks)


def dq_ranges(spark: SparkSession, sf: str) -> DataFrame:
    shares = ratio_features(spark, sf)
    names = ("pct_open", "finished_per_urgent", "pct_low_of_both")
    return _row_checks(shares, "feature_year", [quality.percentage(c) for c in names])


def dq_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    statuses = [f"n_{s}" for s in STATUSES]
    priorities = [f"n_{p}" for p in PRIORITIES]
    checks = [
        quality.reconcile("statuses", statuses, "population"),
        quality.reconcile("priorities_without_low", priorities[:-1], "population"),
        quality.rederived("partial_again", "population - n_open", "n_partial"),
    ]
    return _row_checks(customer_counts(spark, sf), "feature_year", checks)


def dq_bounds(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        quality.positive("n_urgent"),
        quality.parts_within("within_open", ["n_urgent", "n_high"], "n_open"),
        quality.chain("urgent_chain", ["n_urgent", "n_finished", "population"]),
    ]
    return _row_checks(customer_counts(spark, sf), "feature_year", checks)


# --- load and registry ---------------------------------------------------------


def _shipped(spark: SparkSession, sf: str) -> DataFrame:
    """Line rows whose key repeats, and is partly missing for single items."""
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "if(l_quantity > 1, l_linenumber, null) as l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "year(l_shipdate) as ship_year",
    )


def _scratch_table(spark: SparkSession, name: str) -> tuple[str, str]:
    path = fresh_path(spark, name)
    return path.rsplit("/", 1)[1].replace("-", "_"), path


def insert_skip(spark: SparkSession, sf: str) -> DataFrame:
    """Load years to 1998, then years from 1997 again with all later ones."""
    lines = _shipped(spark, sf)
    name, path = _scratch_table(spark, "shipped")
    key = ["ship_year", "l_orderkey", "l_linenumber"]
    create_table_like(lines, name, key=key, partition_by=["ship_year"], path=path)
    insert_skip_existing(lines.filter("ship_year <= 1998"), name, lines.columns)
    insert_skip_existing(lines.filter("ship_year >= 1997"), name, lines.columns)
    return spark.table(name)


def load_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows read, inserted and skipped by the second of two overlapping loads, per year."""
    lines = _shipped(spark, sf)
    name, path = _scratch_table(spark, "shipped")
    key = ["ship_year", "l_orderkey", "l_linenumber"]
    create_table_like(lines, name, key=key, partition_by=["ship_year"], path=path)
    insert_skip_existing(lines.filter("ship_year <= 1998"), name, lines.columns)
    # A row per year.
    years = [r.ship_year for r in lines.select("ship_year").distinct().collect()]
    again = lines.filter("ship_year >= 1997")
    return insert_skip_existing(again, name, lines.columns, count_by=("ship_year", years))


def append_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Three appends to a table with a key; the second repeats a year and is refused."""
    orders = yearly_orders(spark, sf).select("o_orderkey", "o_totalprice", "feature_year")
    name, path = _scratch_table(spark, "keyed_orders")
    key = ["feature_year", "o_orderkey"]
    create_table(spark, name, orders.schema, key=key, partition_by=["feature_year"], path=path)
    append(orders.filter("feature_year <= 1997"), name)
    try:
        append(orders.filter("feature_year between 1997 and 1998"), name)
    except ValueError as refused:
        if "not single" not in str(refused):
            raise
    append(orders.filter("feature_year > 1997"), name)
    return spark.table(name)


def append_batches(spark: SparkSession, sf: str) -> DataFrame:
    orders = yearly_orders(spark, sf).select(
        "o_orderkey", "o_custkey", "o_totalprice", "feature_year"
    )
    name, path = _scratch_table(spark, "orders_by_year")
    create_table(spark, name, orders.schema, partition_by=["feature_year"], path=path)
    append(orders.filter("feature_year <= 1997"), name)
    append(orders.filter("feature_year > 1997"), name)
    return spark.table(name)


def profile(spark: SparkSession, sf: str) -> DataFrame:
    def one(name: str) -> DataFrame:
        return table_profile(table(spark, sf, name)).selectExpr("*", f"'{name}' as table_name")

    return one("orders").unionByName(one("lineitem")).unionByName(one("events"))


def run_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Record two runs; return the second run's metrics beside its run row."""
    registry = runs.Registry(spark, fresh_path(spark, "registry"))
    panel = staged(place_panel(spark, sf).select(*SPEC.persistence_columns), "panel")
    forecast.run_persistence(panel, SPEC, TEST_YEARS[:2], registry)
    forecast.run_persistence(panel, SPEC, TEST_YEARS, registry)
    latest = runs.current_run_id(registry.runs(), forecast.PERSISTENCE)
    counts = {"training_rows": "run_training_rows", "test_rows": "run_test_rows"}
    run = registry.runs().join(latest, "run_id").drop("model_name").withColumnsRenamed(counts)
    return rounded(registry.metrics().join(run, "run_id"))


def recorded_predictions(spark: SparkSession, sf: str) -> DataFrame:
    registry = runs.Registry(spark, fresh_path(spark, "registry"))
    panel = staged(place_panel(spark, sf).select(*SPEC.persistence_columns), "panel")
    forecast.run_persistence(panel, SPEC, TEST_YEARS, registry)
    return rounded(registry.predictions())


def run_counts_update(spark: SparkSession, sf: str) -> DataFrame:
    """A run row of each order year, with the counts of one year set afterwards."""
    years = yearly_orders(spark, sf).groupBy("feature_year").agg(F.expr("count(*) as test_rows"))
    recorded = years.selectExpr(
        "bigint(feature_year) as run_id", "bigint(null) as training_rows", "test_rows"
    )
    return runs.with_run_counts(recorded, 1998, training_rows=10, test_rows=20)


def stored_run_update(spark: SparkSession, sf: str) -> DataFrame:
    """The same update of a stored table, of which one partition is rewritten; done twice."""
    years = yearly_orders(spark, sf).groupBy("feature_year").agg(F.expr("count(*) as test_rows"))
    recorded = years.selectExpr(
        "bigint(null) as training_rows", "test_rows", "bigint(feature_year) as run_id"
    )
    name, path = _scratch_table(spark, "run_rows")
    key = ["run_id"]
    create_table(spark, name, recorded.schema, key=key, partition_by=key, path=path)
    append(recorded, name)
    change = spark.table(name).filter("run_id = 1998").selectExpr(
        "run_id", "bigint(10) as training_rows", "bigint(20) as test_rows"
    )
    for _ in range(2):
        update_by_key(change, name)
    return spark.table(name)


def concurrent_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two writers record a run each at the same time; the counts of the second are set."""
    registry = runs.Registry(spark, fresh_path(spark, "registry"))
    panel = staged(place_panel(spark, sf).select(*SPEC.persistence_columns), "panel")

    @inheritable_thread_target(spark)
    def record(_: int) -> int:
        return forecast.run_persistence(panel, SPEC, TEST_YEARS, registry)

    with ThreadPoolExecutor(2) as pool:
        ids = sorted(pool.map(record, range(2)))
    registry.set_counts(ids[-1], 1, 2)
    runs_row = registry.runs().select(
        "run_id", F.col("training_rows").alias("run_training_rows"), "test_start_year"
    )
    return rounded(registry.metrics().join(runs_row, "run_id"))


def growth_view(spark: SparkSession, sf: str) -> DataFrame:
    """Growth read by SQL from a view of the stored panel, two years of it."""
    panel = place_panel(spark, sf, by_segment=False).select(
        "location_id", "county_name", "population", "feature_year"
    )
    name, path = _scratch_table(spark, "place_years")
    key = ["feature_year", "location_id"]
    create_table(spark, name, panel.schema, key=key, partition_by=["feature_year"], path=path)
    append(panel, name)
    create_growth_view(spark, f"{name}_growth", name, SPEC)
    return spark.sql(f"select * from {name}_growth where feature_year between 1997 and 1998")


# --- calendar ------------------------------------------------------------------


def _dated_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr("o_orderkey", "date(o_orderdate) as order_date")


def _orders_by_day(spark: SparkSession, sf: str) -> DataFrame:
    days = _dated_orders(spark, sf).groupBy("order_date")
    return days.agg(F.expr("count(*) as orders"))


def _order_holidays(spark: SparkSession, sf: str) -> DataFrame:
    span = _dated_orders(spark, sf).selectExpr(
        "explode(sequence(year(min(order_date)), year(max(order_date)))) as year"
    )
    return calendar.federal_holidays(span)


def holiday_table(spark: SparkSession, sf: str) -> DataFrame:
    daily = _orders_by_day(spark, sf).withColumnRenamed("order_date", "holiday_date")
    return _order_holidays(spark, sf).join(daily, "holiday_date", "left")


def holidays_by_country(spark: SparkSession, sf: str) -> DataFrame:
    """Twenty years from the first order on, a country after the other."""
    span = _dated_orders(spark, sf).selectExpr(
        "explode(sequence(year(min(order_date)), year(min(order_date)) + 19)) as year"
    )
    found = [
        calendar.public_holidays(span, c).selectExpr(f"'{c}' as country", "*")
        for c in ("AT", "DE", "FR", "GB")
    ]
    return reduce(DataFrame.unionByName, found)


def business_days(spark: SparkSession, sf: str) -> DataFrame:
    daily = _orders_by_day(spark, sf)
    return calendar.with_business_day(daily, "order_date", _order_holidays(spark, sf))


def business_day_gate(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.business_day_gate(
        _dated_orders(spark, sf), "order_date", _order_holidays(spark, sf)
    )


# --- models --------------------------------------------------------------------


def linear_two_features(spark: SparkSession, sf: str) -> DataFrame:
    spec = SPEC.with_features("historical_growth_1yr", "avg_price")
    found = forecast.linear_validation(place_panel(spark, sf), spec, TEST_YEARS)
    return rounded(found.drop("first_training_year", "last_training_year"))


def linear_customers(spark: SparkSession, sf: str) -> DataFrame:
    spec = SPEC.with_features("historical_growth_1yr", "population")
    found = forecast.linear_validation(customer_panel(spark, sf), spec, TEST_YEARS)
    return rounded(found.drop("first_training_year", "last_training_year"))


def linear_rolling(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(forecast.linear_validation(place_panel(spark, sf), SPEC, TEST_YEARS))


def forest_single_split(spark: SparkSession, sf: str) -> DataFrame:
    _, scored = forecast.forest_split(place_panel(spark, sf), SPEC, 1998, 1999, FOREST)
    named = scored.withColumnRenamed("predicted_growth", "predicted_growth_1yr")
    return named.select(*ACTUAL_VS_PREDICTED)


def forest_error_summary(spark: SparkSession, sf: str) -> DataFrame:
    _, scored = forecast.forest_split(place_panel(spark, sf), SPEC, 1998, 1999, FOREST)
    return ev.error_summary(staged(scored, "scored"), SPEC)


def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    forest, _ = forecast.forest_split(place_panel(spark, sf), SPEC, 1998, 1999, FOREST)
    return models.feature_importance(forest, SPEC, spark, top=15)


def forest_rolling(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.rolling_comparison(place_panel(spark, sf), SPEC, TEST_YEARS, FOREST)


def forest_facts(spark: SparkSession, sf: str) -> DataFrame:
    """What holds of any forest of means, by fold: a forecast lies within the training
    targets, and the importances are shares of one."""
    ready = forecast.model_table(place_panel(spark, sf), SPEC)
    sizes = {r.test_year: r.training_rows for r in
             expanding_folds(ready, SPEC.time, TEST_YEARS).collect()}
    sets = [(ready.filter(f"{SPEC.time} < {t}"), n) for t, n in sorted(sizes.items())]
    found = []
    for (train, _), test_year, forest in zip(
        sets, sorted(sizes), models.fit_forests(sets, SPEC, FOREST)
    ):
        shares = forest.importances
        low, high = train.agg(F.min(SPEC.target), F.max(SPEC.target)).first()
        test = ready.filter(f"{SPEC.time} = {test_year}")
        inside = F.col("predicted_growth").between(low - 1e-12, high + 1e-12)
        found.append(
            models.predict_forest(forest, test, SPEC).groupBy("test_year").agg(
                F.count("*").alias("test_rows"),
                F.count_if(inside).alias("within"),
                F.lit(forest.trees).alias("trees"),
                F.lit(abs(sum(shares) - 1) < 1e-9 and min(shares) >= 0).alias("shares_of_one"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return ev.comparison_averages(forest_rolling(spark, sf))


def _known_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The place panel with growth that follows from one feature: every tree splits there,
    once, and both its leaves are pure. So all a forest gives is known."""
    odd = "population % 2 = 1"
    return place_panel(spark, sf).selectExpr(
        "location_id",
        "county_name",
        "feature_year",
        "population",
        f"double(if({odd}, 1, 0)) as is_odd",
        "pct_weekend",
        SPEC.past,
        f"if({SPEC.target} is null, null, if({odd}, 0.25D, -0.125D)) as {SPEC.target}",
    )


KNOWN = SPEC.with_features("pct_weekend", SPEC.past, "is_odd")


def forest_known_split(spark: SparkSession, sf: str) -> DataFrame:
    _, scored = forecast.forest_split(_known_panel(spark, sf), KNOWN, 1998, 1999, FOREST)
    named = scored.withColumnRenamed("predicted_growth", "predicted_growth_1yr")
    return rounded(named.select(*ACTUAL_VS_PREDICTED))


def forest_known_importance(spark: SparkSession, sf: str) -> DataFrame:
    forest, _ = forecast.forest_split(_known_panel(spark, sf), KNOWN, 1998, 1999, FOREST)
    ranked = models.feature_importance(forest, KNOWN, spark, top=15)
    return models.importance_lines(ranked)


def comparison_known(spark: SparkSession, sf: str) -> DataFrame:
    """Persistence beside a forest that is known, averaged over the folds."""
    wide = forecast.rolling_comparison(_known_panel(spark, sf), KNOWN, TEST_YEARS, FOREST)
    return rounded(ev.comparison_averages(wide))


def comparison_lines(spark: SparkSession, sf: str) -> DataFrame:
    wide = forecast.rolling_comparison(_known_panel(spark, sf), KNOWN, TEST_YEARS, FOREST)
    return ev.comparison_lines(wide, ["baseline", "rf"])


def summary_lines(spark: SparkSession, sf: str) -> DataFrame:
    panel = place_panel(spark, sf, by_segment=False)
    return ev.summary_lines(ev.persistence_metrics(panel, SPEC, TEST_YEARS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rolling_persistence_eval": rolling_persistence_eval,
    "customer_persistence_eval": customer_persistence_eval,
    "panel_growth": panel_growth,
    "complete_rows": complete_panel_rows,
    "expanding_folds": expanding_fold_counts,
    "fold_membership": fold_membership,
    "daily_folds": daily_folds,
    "time_split": customer_time_split,
    "regression_metrics": regression_metrics,
    "population_errors": population_errors,
    "error_summary": error_summary,
    "median_price": median_price,
    "fold_averages": fold_averages,
    "fold_lines": fold_lines,
    "summary_lines": summary_lines,
    "target_range": target_range,
    "matrix_unpack": matrix_unpack,
    "matrix_scan": matrix_scan,
    "matrix_lines": matrix_lines,
    "coerce_numeric": coerce_numeric,
    "strict_sums": strict_sums,
    "ratio_features": ratio_features,
    "lookup_join_last_wins": lookup_join_last_wins,
    "unmatched_rows": unmatched_rows,
    "ranked_by_rate": ranked_by_rate,
    "county_records": county_records,
    "unmatched_counties": unmatched_counties,
    "county_backfill": county_backfill,
    "county_backfill_broken": county_backfill_broken,
    "dq_report": dq_report,
    "dq_verdict_broken": dq_verdict_broken,
    "dq_verdict": dq_verdict,
    "dq_duplicates": dq_duplicates,
    "dq_missing": dq_missing,
    "dq_ranges": dq_ranges,
    "dq_reconcile": dq_reconcile,
    "dq_bounds": dq_bounds,
    "insert_skip_existing": insert_skip,
    "load_counts": load_counts,
    "append_batches": append_batches,
    "append_keyed": append_keyed,
    "table_profile": profile,
    "run_registry": run_registry,
    "recorded_predictions": recorded_predictions,
    "run_counts_update": run_counts_update,
    "stored_run_update": stored_run_update,
    "concurrent_runs": concurrent_runs,
    "growth_view": growth_view,
    "holiday_table": holiday_table,
    "holidays_by_country": holidays_by_country,
    "business_days": business_days,
    "business_day_gate": business_day_gate,
    "linear_two_features": linear_two_features,
    "linear_customers": linear_customers,
    "linear_rolling": linear_rolling,
    "forest_single_split": forest_single_split,
    "forest_error_summary": forest_error_summary,
    "feature_importance": feature_importance,
    "forest_rolling": forest_rolling,
    "forest_facts": forest_facts,
    "model_comparison": model_comparison,
    "forest_known_split": forest_known_split,
    "forest_known_importance": forest_known_importance,
    "comparison_known": comparison_known,
    "comparison_lines": comparison_lines,
}
