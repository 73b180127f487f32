"""Keyed lookup joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearling.functions.names import quoted


def one_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in `order`; NULL keys count as equal.

    `row_number() = 1` lets Spark keep one row per key in every task before the
    shuffle, so a key holding most of the rows costs no more than any other.
    """
    window = f"partition by {', '.join(map(quoted, key))} order by {', '.join(order)}"
    numbered = df.selectExpr("*", f"row_number() over ({window}) as _n")
    return numbered.filter("_n = 1").drop("_n")


def last_per_key(df: DataFrame, key: list[str], position: str) -> DataFrame:
    return one_per_key(df, key, [f"{quoted(position)} desc nulls last"])


def lookup_join(
    main: DataFrame, lookup: DataFrame, key: list[str], position: str
) -> DataFrame:
    """Inner join with the last lookup row of each key; other rows are dropped.

    Nothing runs until the result does. The join is on the key as one value, which no
    earlier step is laid out by: so both sides come from plain shuffles, and AQE can
    split a key that holds many of the main rows. It cannot when a side still carries
    the window.
    """
    whole = F.struct(*map(quoted, key))
    known = lookup.filter(" and ".join(f"{quoted(k)} is not null" for k in key))
    single = last_per_key(known, key, position).drop(position)
    right = single.withColumn("_key", whole).drop(*key)
    joined = main.withColumn("_key", whole).join(right, "_key").drop("_key")
    others = [c for c in main.columns if c not in key]
    added = [c for c in right.columns if c != "_key"]
    return joined.select(*map(quoted, [*key, *others, *added]))


def unmatched(main: DataFrame, lookup: DataFrame, key: list[str]) -> DataFrame:
    """The rows `lookup_join` drops."""
    return main.join(lookup.select(*map(quoted, key)), key, "left_anti")
