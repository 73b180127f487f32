"""Every query against DuckDB on the small tables, and the shape of key plans."""

import importlib.util
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle_sql_texts import ORACLE
from yearling.plans import queries as q
from yearling.plans.order_activity import customer_panel, place_panel, placed_orders

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DATA = "/root/testdata/sf0.001"
TABLES = ("nation", "customer", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def _entry():
    spec = importlib.util.spec_from_file_location("entry", f"{ROOT}/__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


ENTRY = _entry()
ROWS_ONLY = {
    "forest_single_split": None,
    "forest_error_summary": 1,
    "feature_importance": 15,
    "forest_rolling": 3,
    "model_comparison": 1,
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}") + 0.0
    return value


def _sorted(rows, names, columns):
    picked = [tuple(_plain(r[names.index(c)]) for c in columns) for r in rows]
    return sorted(picked, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_every_query_has_sql_or_a_reason():
    assert set(q.QUERIES) == set(ORACLE) | set(ROWS_ONLY)
    assert set(q.QUERIES) <= set(ENTRY.queries()) and set(ORACLE) <= set(ENTRY.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    found = ENTRY.queries()[name](spark, DATA)
    expected = duck.execute(ORACLE[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(found.columns)
    columns = sorted(names)
    rows = [tuple(r) for r in found.collect()]
    assert rows
    assert _sorted(rows, found.columns, columns) == _sorted(expected.fetchall(), names, columns)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_model_query_runs(spark, monkeypatch, name):
    monkeypatch.setattr(q, "FOREST", q.models.ForestParams(trees=4, max_depth=4))
    rows = ENTRY.queries()[name](spark, DATA).count()
    assert rows == ROWS_ONLY[name] if ROWS_ONLY[name] else rows > 0


def test_ranked_by_rate_is_ordered(spark):
    rates = [r.rate for r in q.ranked_by_rate(spark, DATA).collect()]
    known = [r for r in rates if r is not None]
    assert known == sorted(known, reverse=True)
    assert rates[len(known):] == [None] * (len(rates) - len(known))


def test_entry(spark):
    assert ENTRY.entry(spark).count() == 3


def test_only_needed_columns_are_read(spark, plan):
    text = plan(placed_orders(spark, DATA).groupBy("n_name").count())
    read = [line.split("ReadSchema: ")[1] for line in text.splitlines() if "orders.parquet" in line]
    # One scan for the last year that is over, one for the orders.
    assert set(read) == {
        "struct<o_orderdate:timestamp_ntz>",
        "struct<o_custkey:bigint,o_orderdate:timestamp_ntz>",
    }


def test_a_hot_customer_is_split(spark, plan, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    # A third of the orders belong to one customer.
    orders = spark.read.parquet(f"{DATA.replace('0.001', '0.1')}/orders.parquet")
    hot = "if(o_orderkey % 3 = 0, bigint(5), o_custkey % 150) as o_custkey"
    others = [c for c in orders.columns if c != "o_custkey"]
    orders.repartition(8).selectExpr(*others, hot).write.parquet(f"{tmp_path}/orders.parquet")
    for name in ("customer", "nation"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        panel = place_panel(spark, str(tmp_path))
        found = panel.collect()
        last = orders.selectExpr("date_trunc('year', max(o_orderdate) + interval 1 day)").first()[0]
        assert sum(r.population for r in found) == orders.filter(F.col("o_orderdate") < last).count()
        assert "skew=true" in plan(panel)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_growth_takes_one_shuffle_after_the_counts(spark, plan):
    assert plan(customer_panel(spark, DATA)).count("Exchange hashpartitioning") == 2


def test_no_cartesian_or_nested_loop_join(spark, plan):
    for name in ("rolling_persistence_eval", "expanding_folds", "fold_membership", "panel_growth"):
        text = plan(ENTRY.queries()[name](spark, DATA))
        assert "NestedLoop" not in text and "Cartesian" not in text
