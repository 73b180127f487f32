"""Source documents made from order activity, one per year, for the county plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearling.plans.order_activity import PRIORITIES, STATUSES, placed_orders
from yearling.sources.staging import staged

_COUNTY = "lpad(string(c_nationkey), 3, '0')"


def county_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation and year: at most a few hundred, whatever the orders.

    Stored, so that the documents made of it do not each read the orders again.
    """
    counts = {
        **{f"m{m}": f"month(o_orderdate) = {m}" for m in range(1, 9)},
        **{f"d{d}": f"day(o_orderdate) = {d}" for d in range(1, 13)},
        **{f"w{w}": f"weekday(o_orderdate) = {w}" for w in range(4)},
        **{n: f"o_orderstatus = '{v}'" for n, v in STATUSES.items()},
        **{n: f"o_orderpriority = '{v}'" for n, v in PRIORITIES.items()},
        "small": "_price < 5000000",
        "working": "_price >= 10000000",
        "idle": "_price >= 40000000",
    }
    wanted = [
        "count(*) as total",
        "sum(_price) as spent",
        *[f"count_if({c}) as {n}" for n, c in counts.items()],
    ]
    counted = (
        placed_orders(spark, sf_dir, whole_years=False)
        .groupBy(F.expr("bigint(feature_year) as year"), "c_nationkey", "n_name")
        .agg(*[F.expr(w) for w in wanted])
    )
    return staged(counted, "county-counts")


def _document(counted: DataFrame, cells: dict[str, str], twice: str) -> DataFrame:
    """One JSON text per year; a year has one row per nation, twice at most."""
    row = ", ".join(f"string({c})" for c in cells.values())
    header = ", ".join(f"'{name}'" for name in cells)
    rows = "transform(array_sort(collect_list(_row)), r -> r.cells)"
    return (
        counted.selectExpr("*", f"explode(if({twice}, array(0, 1), array(1))) as copy")
        .selectExpr("year", f"struct(c_nationkey, copy, array({row}) as cells) as _row")
        .groupBy("year")
        .agg(F.expr(f"to_json(concat(array(array({header})), {rows})) as value"))
        .selectExpr("value", "year", "'ST' as state")
    )


def main_documents(counted: DataFrame) -> DataFrame:
    """Nation 5 appears twice in 1998; nation 3 of 1997 has no rent figure."""
    no_rent = "(c_nationkey = 3 and year = 1997)"
    # The survey variables of the main source.
    cells = {
        "NAME": "n_name",
        "B01001_001E": "total",
        "B01002_001E": "concat(string(total % 70), '.5')",
        "B01001_003E": "m1",
        "B01001_004E": "m2",
        "B01001_005E": "m3",
        "B01001_006E": "m4",
        "B01001_020E": "d1",
        "B01001_021E": "d2",
        "B01001_022E": "d3",
        "B01001_023E": "d4",
        "B01001_024E": "d5",
        "B01001_025E": "d6",
        "B01001_027E": "m5",
        "B01001_028E": "m6",
        "B01001_029E": "m7",
        "B01001_030E": "m8",
        "B01001_044E": "d7",
        "B01001_045E": "d8",
        "B01001_046E": "d9",
        "B01001_047E": "d10",
        "B01001_048E": "d11",
        "B01001_049E": "d12",
        "B02001_002E": "finished",
        "B02001_003E": "open",
        "B03003_003E": "partial",
        "B15003_001E": "total",
        "B15003_022E": "urgent",
        "B15003_023E": "high",
        "B15003_024E": "medium",
        "B15003_025E": "unspecified",
        "B19013_001E": "floor(spent / 100)",
        "B17001_001E": "total",
        "B17001_002E": "small",
        "B23025_001E": "total",
        "B23025_003E": "working",
        "B23025_005E": "idle",
        "B25001_001E": "total",
        "B25002_001E": "total",
        "B25002_003E": "finished",
        "B25003_001E": f"if({no_rent}, open, open + partial)",
        "B25003_002E": "open",
        "B25010_001E": "'2.25'",
        "B25064_001E": f"if({no_rent}, null, total * 3)",
        "B25077_001E": "'n/a'",
        "B05001_001E": "total",
        "B05001_002E": "total - partial",
        "state": "'07'",
        "county": _COUNTY,
    }
    return _document(counted, cells, "c_nationkey = 5 and year = 1998")


def mobility_documents(counted: DataFrame) -> DataFrame:
    """Nation 7 is missing in 1996; nation 2 of 1999 has an old row before the good one."""
    # The variables of the second source.
    cells = {
        "NAME": "n_name",
        "B07001_001E": "if(copy = 0, 'stale', string(total))",
        "B07001_033E": "w0",
        "B07001_049E": "w1",
        "B07001_065E": "w2",
        "B07001_081E": "w3",
        "state": "'07'",
        "county": _COUNTY,
    }
    kept = counted.filter("not (c_nationkey = 7 and year = 1996)")
    return _document(kept, cells, "c_nationkey = 2 and year = 1999")
