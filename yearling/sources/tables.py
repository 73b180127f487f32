"""Catalog tables with a declared schema, an optional key and partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearling.functions.names import quoted, text
from yearling.sources.staging import balanced, staged

_KEY = "unique_columns"
#: Keys that a message names.
_NAMED = 20


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    key: list[str] | None = None,
    partition_by: list[str] | None = None,
    path: str | None = None,
) -> None:
    """Create a Parquet table unless it exists. The key is kept as a property.

    An existing table with other columns or types fails here, before any load.
    """
    if spark.catalog.tableExists(name):
        have = {f.name: f.dataType for f in spark.table(name).schema}
        want = {f.name: f.dataType for f in schema}
        if have != want:
            raise ValueError(f"table {name} exists with another schema")
        return
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"]
    if partition_by:
        parts.append("PARTITIONED BY (" + ", ".join(map(quoted, partition_by)) + ")")
    if path:
        parts.append(f"LOCATION {text(path)}")
    if key:
        parts.append(f"TBLPROPERTIES ('{_KEY}' = {text(','.join(key))})")
    spark.sql(" ".join(parts))


def create_table_like(df: DataFrame, name: str, **options) -> None:
    """Create a table from a frame's schema; an empty frame is rejected."""
    if df.isEmpty():
        raise ValueError("cannot create a table from an empty frame")
    create_table(df.sparkSession, name, df.schema, **options)


def table_key(spark: SparkSession, name: str) -> list[str]:
    """The key a table was created with, [] when it has none."""
    for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect():
        if row["key"] == _KEY:
            return row["value"].split(",")
    return []


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def add_rows(df: DataFrame, name: str) -> None:
    """Append by column name, unchecked."""
    spark = df.sparkSession
    rows, parts = df.select(*spark.table(name).columns), partition_columns(spark, name)
    (balanced(rows, parts) if parts else rows).write.insertInto(name)


def clashing_keys(df: DataFrame, name: str, key: list[str]) -> DataFrame:
    """Keys that would not be single after `df` is added: the key, `new` and `stored` rows.

    One pass over both: the table in key columns only, and of its partitions those the rows
    go to. Rows are counted per key before the shuffle. A key with a NULL part equals none.
    """
    spark = df.sparkSession
    stored, parts = spark.table(name), [c for c in partition_columns(spark, name) if c in key]
    if parts:
        stored = stored.join(df.select(*parts).distinct(), parts, "left_semi")
    key = [quoted(k) for k in key]
    both = df.selectExpr(*key, "1 as _new").unionByName(stored.selectExpr(*key, "0 as _new"))
    return (
        both.filter(" and ".join(f"{k} is not null" for k in key))
        .groupBy(*key)
        .agg(F.sum("_new").alias("new"), F.sum(1 - F.col("_new")).alias("stored"))
        .filter("new > 0 and new + stored > 1")
    )


def append(df: DataFrame, name: str) -> None:
    """Append by column name. A key that the table declares stays single: if the rows
    repeat one, or the table has it, nothing is written and the first such keys are named.

    The rows are stored before they are checked, so that what was checked is what is
    added. One writer at a time.
    """
    key = table_key(df.sparkSession, name)
    if key:
        df = staged(df, "batch")
        # Two rows are enough to tell; the message names a few.
        clashes = clashing_keys(df, name, key).orderBy(*map(quoted, key)).limit(_NAMED + 1)
        found = [tuple(r[k] for k in key) for r in clashes.collect()]
        if found:
            more = ", ..." if len(found) > _NAMED else ""
            named = ", ".join(map(str, found[:_NAMED]))
            raise ValueError(f"key {tuple(key)} of {name} not single: {named}{more}")
    add_rows(df, name)


def update_by_key(changes: DataFrame, name: str, key: list[str] | None = None) -> None:
    """Set the columns of `changes` in the stored rows that have its keys.

    `changes` has the key, every partition column among it, one row per key, and any
    other columns of the table. Only partitions with a changed row are rewritten, by a
    dynamic overwrite; the others keep their files. Keys the table lacks are left out,
    and doing it again changes nothing more. One writer at a time.
    """
    spark = changes.sparkSession
    key = key or table_key(spark, name)
    table, parts = spark.table(name), partition_columns(spark, name)
    if not key or not parts:
        raise ValueError(f"table {name} needs a key and partitions to be updated by key")
    if unknown := [c for c in changes.columns if c not in table.columns]:
        raise ValueError(f"table {name} has no columns {unknown}")
    if outside := [c for c in parts if c not in key]:
        raise ValueError(f"partition columns {outside} are not in the key")
    changes = staged(changes, "changes")
    if not changes.groupBy(*key).count().filter("count > 1").isEmpty():
        raise ValueError(f"several changes of one key {tuple(key)}")
    new = [c for c in changes.columns if c not in key]
    renamed = changes.select(*key, *(F.col(quoted(c)).alias(f"_new_{c}") for c in new))
    renamed = renamed.withColumn("_changed", F.lit(True))
    # Partitions that hold a row to change, not all that are named.
    held = table.select(*key).join(changes.select(*key), key, "left_semi")
    touched = staged(held.select(*parts).distinct(), "touched")
    if touched.isEmpty():
        return
    kept = table.join(touched, parts, "left_semi").join(renamed, key, "left")
    rows = kept.select(
        *(
            F.when(F.col("_changed"), F.col(quoted(f"_new_{c}"))).otherwise(F.col(quoted(c))).alias(c)
            if c in new
            else F.col(quoted(c))
            for c in table.columns
        )
    )
    # Stored first: a table cannot be read while it is overwritten.
    rows = staged(rows, "updated")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        balanced(rows, parts).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def storage_type(kind: T.DataType) -> str:
    """Column type of a relational store for a Spark type."""
    if isinstance(kind, T.IntegralType):
        return "BIGINT"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "DOUBLE PRECISION"
    if isinstance(kind, T.BooleanType):
        return "BOOLEAN"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    return "TEXT"
