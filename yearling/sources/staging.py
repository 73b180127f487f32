"""Shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from yearling.functions.names import quoted


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session.

    In local mode, where driver and tasks share a machine, a session without the setting
    gets a fresh folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="yearling-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write once, read back: later passes scan columns instead of recomputing.

    The table survives lost executors and cuts the lineage; partitioning by the
    time column makes every later time filter a directory choice.
    """
    path = fresh_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = balanced(df, partition_by).write.partitionBy(*partition_by)
    writer.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of `staged` that nothing reads any more.

    What was made of them must be staged itself, or it could not be made again.
    """
    for table in tables:
        spark = table.sparkSession
        context = spark.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(folder))
            if path.getParent().getName() != shared_folder(spark).rsplit("/", 1)[-1]:
                raise ValueError(f"{folder} is no staged table")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def balanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Gather partition values before a write, in files of a sound size.

    Without it every task adds a file to every folder. AQE splits a value that
    holds many of the rows and joins small ones.
    """
    return df.hint("rebalance", *map(quoted, partition_by))
