"""Stand-in panels: yearly order activity per place, from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearling.functions.numeric import percent
from yearling.operators.panel import with_growth
from yearling.spec import PanelSpec

TEST_YEARS = [1997, 1998, 1999]
STATUSES = {"finished": "F", "open": "O", "partial": "P"}
PRIORITIES = {
    "urgent": "1-URGENT",
    "high": "2-HIGH",
    "medium": "3-MEDIUM",
    "unspecified": "4-NOT SPECIFIED",
    "low": "5-LOW",
}

SPEC = PanelSpec(
    features=(
        "population",
        "historical_growth_1yr",
        "avg_price",
        "avg_balance",
        "min_price",
        "max_price",
        *[f"pct_{s}" for s in STATUSES],
        *[f"pct_{p}" for p in PRIORITIES],
        "pct_weekend",
        "pct_first_half",
        "pct_large",
        "pct_negative_balance",
    )
)


# Declared, so that opening a table does not start a job to read file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: str) -> str:
    """Whole cents: their sums do not depend on the order of rows."""
    return f"bigint(round({amount} * 100))"


def yearly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("*", "year(o_orderdate) as feature_year")


def complete_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the years that are over by the last order: a panel's last year must be
    a whole one. A subquery, so that nothing runs before the query does."""
    last = table(spark, sf_dir, "orders").selectExpr(
        "date_trunc('year', max(o_orderdate) + interval 1 day) as open_year"
    )
    orders = yearly_orders(spark, sf_dir)
    return orders.where(F.col("o_orderdate") < last.scalar().cast("timestamp_ntz"))


def placed_orders(spark: SparkSession, sf_dir: str, whole_years: bool = True) -> DataFrame:
    """Orders with their customer and nation, prices and balances in cents.

    Spark broadcasts a side it knows to be small; otherwise it shuffles on the
    customer key, and a customer with very many orders is split by AQE.
    """
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    orders = (complete_years if whole_years else yearly_orders)(spark, sf_dir)
    return (
        orders.join(customer, "o_custkey")
        .join(nation, "c_nationkey")
        .selectExpr("*", f"{cents('o_totalprice')} as _price", f"{cents('c_acctbal')} as _balance")
    )


def place_panel(spark: SparkSession, sf_dir: str, by_segment: bool = True) -> DataFrame:
    """Panel by nation, or nation and market segment, with all model features."""
    place, label = "lpad(string(c_nationkey), 2, '0')", "n_name"
    if by_segment:
        place = f"concat({place}, '-', c_mktsegment)"
        label = f"concat({label}, ' ', c_mktsegment)"
    shares = {n: f"o_orderstatus = '{v}'" for n, v in STATUSES.items()}
    shares |= {n: f"o_orderpriority = '{v}'" for n, v in PRIORITIES.items()}
    shares |= {
        "weekend": "weekday(o_orderdate) >= 5",
        "first_half": "month(o_orderdate) <= 6",
        "large": "_price > 25000000",
        "negative_balance": "c_acctbal < 0",
    }
    wanted = [
        "count(*) as population",
        "sum(_price) as _prices",
        "sum(_balance) as _balances",
        "min(_price) as _low",
        "max(_price) as _high",
        *[f"count_if({c}) as _n_{n}" for n, c in shares.items()],
    ]
    panel = (
        placed_orders(spark, sf_dir)
        .groupBy(
            F.expr(f"{place} as location_id"), F.expr(f"{label} as county_name"), "feature_year"
        )
        .agg(*[F.expr(w) for w in wanted])
        .selectExpr(
            "location_id",
            "county_name",
            "feature_year",
            "population",
            "try_divide(_prices, population) / 100 as avg_price",
            "try_divide(_balances, population) / 100 as avg_balance",
            "_low / 100 as min_price",
            "_high / 100 as max_price",
            *[f"{percent(f'_n_{n}', 'population')} as pct_{n}" for n in shares],
        )
    )
    return with_growth(panel, SPEC)


def customer_counts(
    spark: SparkSession, sf_dir: str, whole_years: bool = False
) -> DataFrame:
    """Orders per customer and year, with parts by status and by priority.

    Counts merge in each task before the shuffle, so a customer with most of the
    orders sends one row per task and year.
    """
    parts = {n: f"o_orderstatus = '{v}'" for n, v in STATUSES.items()}
    parts |= {n: f"o_orderpriority = '{v}'" for n, v in PRIORITIES.items()}
    wanted = ["count(*) as population", *[f"count_if({c}) as n_{n}" for n, c in parts.items()]]
    orders = (complete_years if whole_years else yearly_orders)(spark, sf_dir)
    return (
        orders.groupBy("o_custkey", "feature_year")
        .agg(*[F.expr(w) for w in wanted])
        .selectExpr(
            "string(o_custkey) as location_id",
            "concat('Customer ', string(o_custkey)) as county_name",
            "feature_year",
            "population",
            *[f"n_{n}" for n in parts],
        )
    )


def customer_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_growth(customer_counts(spark, sf_dir, whole_years=True), SPEC)
