"""Idempotent loading into catalog tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from yearling.functions.names import quoted, text
from yearling.operators.joins import one_per_key
from yearling.sources.staging import staged
from yearling.sources.tables import add_rows, partition_columns, storage_type, table_key


def rows_to_insert(
    batch: DataFrame, target: DataFrame, key: list[str], order: list[str]
) -> DataFrame:
    """The batch rows an insert that skips existing keys would add.

    First row per key in `order`, unless the target has the key. A key with a NULL
    part equals no other key, so such rows all pass, without a shuffle.
    """
    known = " and ".join(f"{quoted(k)} is not null" for k in key)
    order = [quoted(c) for c in [c for c in order if c not in key] or key]
    fresh = one_per_key(batch.filter(known), key, order).join(
        target.select(*map(quoted, key)), key, "left_anti"
    )
    return fresh.unionByName(batch.filter(f"not ({known})"))


def insert_skip_existing(
    batch: DataFrame,
    name: str,
    order: list[str],
    key: list[str] | None = None,
    count_by: tuple[str, list] | None = None,
) -> DataFrame | None:
    """Append the rows whose key the table lacks. One writer at a time.

    `order` says which of equal keys comes first. Running it twice, or again after
    a lost job, adds nothing new. The batch is stored first, so it is computed once. The
    scan of the table reads key columns only; its partitions are joined with those of
    the batch, which Spark prunes by when it runs.

    With `count_by`, a column and its listed values, returns a row per value: (value,
    `read`, `inserted`, `skipped`). They are counted by the writes themselves.
    """
    spark = batch.sparkSession
    read, inserted = Observation(), Observation()
    if count_by:
        batch = batch.observe(read, *_counts(*count_by))
    batch = staged(batch, "batch")
    if batch.isEmpty():
        raise ValueError("cannot insert an empty frame")
    key = key or table_key(spark, name)
    if not key:
        raise ValueError(f"table {name} has no key")
    target = spark.table(name)
    parts = [c for c in partition_columns(spark, name) if c in key]
    # Sorting starts with the key's first column: better not a partition column.
    key = [k for k in key if k not in parts] + parts
    if parts:
        target = target.join(batch.select(*parts).distinct(), parts, "left_semi")
    fresh = rows_to_insert(batch, target, key, order)
    if count_by:
        fresh = fresh.observe(inserted, *_counts(*count_by))
    add_rows(fresh, name)
    return _load_counts(spark, count_by, _told(read), _told(inserted)) if count_by else None


def _counts(column: str, values: list) -> list[Column]:
    """One sum per listed value: a batch value each, so a handful."""
    return [F.count_if(F.col(quoted(column)) == v).alias(f"n{i}") for i, v in enumerate(values)]


def _told(observation: Observation) -> dict:
    """The metrics of a finished write, none if Spark found it to be empty.

    `Observation.get` fails on the latter, so its JVM side is asked.
    """
    return dict(observation._jo.getAsJava())


def _load_counts(
    spark: SparkSession, count_by: tuple[str, list], read: dict, added: dict
) -> DataFrame:
    column, values = count_by
    pairs = [(read.get(f"n{i}") or 0, added.get(f"n{i}") or 0) for i in range(len(values))]
    rows = [(v, n, m, n - m) for v, (n, m) in zip(values, pairs)]
    return spark.createDataFrame(
        rows, f"{quoted(column)} bigint, read bigint, inserted bigint, skipped bigint"
    )


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: type in a relational store, rows and values present. One pass."""
    counted = df.selectExpr(
        "count(*) as _rows", *[f"count({quoted(c)}) as _{i}" for i, c in enumerate(df.columns)]
    )
    lines = ", ".join(
        f"struct({i} as ordinal, {text(f.name)} as column_name, "
        f"'{storage_type(f.dataType)}' as storage_type, _rows as row_count, _{i} as non_null)"
        for i, f in enumerate(df.schema)
    )
    return counted.selectExpr(f"inline(array({lines}))")
