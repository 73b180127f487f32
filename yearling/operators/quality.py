"""Declared data-quality checks, counted per batch.

A row check is a SQL condition for a bad row; NULL does not count, so checks that
must fail on missing values say so themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearling.functions.names import quoted, text
from yearling.operators.panel import nan_as_null


@dataclass(frozen=True)
class RowCheck:
    name: str
    bad: str


def not_missing(column: str) -> RowCheck:
    return RowCheck(f"{column}_not_missing", f"{quoted(column)} is null")


def positive(column: str) -> RowCheck:
    return RowCheck(f"{column}_positive", f"{quoted(column)} <= 0")


def percentage(column: str) -> RowCheck:
    """Outside 0 to 100, or missing."""
    return RowCheck(f"{column}_range", f"not coalesce({quoted(column)} between 0 and 100, false)")


def parts_within(name: str, parts: list[str], whole: str) -> RowCheck:
    """No part alone exceeds the whole."""
    return RowCheck(name, " or ".join(f"{quoted(p)} > {quoted(whole)}" for p in parts))


def reconcile(name: str, parts: list[str], whole: str) -> RowCheck:
    """The parts add up to the whole; a missing value is a mismatch."""
    added = " + ".join(map(quoted, parts))
    return RowCheck(name, f"coalesce({added} <> {quoted(whole)}, true)")


def rederived(name: str, formula: str, column: str) -> RowCheck:
    """A formula gives the stored column again; a missing value is a mismatch."""
    return RowCheck(name, f"coalesce(({formula}) <> {quoted(column)}, true)")


def chain(name: str, columns: list[str]) -> RowCheck:
    """0 <= each column <= the next one; the last column bounds, unchecked."""
    columns = list(map(quoted, columns))
    steps = [f"{a} < 0 or {a} > {b}" for a, b in zip(columns, columns[1:])]
    return RowCheck(name, " or ".join(steps))


def row_check_counts(df: DataFrame, batch: str, checks: list[RowCheck]) -> DataFrame:
    """One row per batch: `rows` and one count per check, from a single pass."""
    wanted = ["count(*) as rows", *[f"count_if({c.bad}) as {quoted(c.name)}" for c in checks]]
    return nan_as_null(df).groupBy(batch).agg(*[F.expr(w) for w in wanted])


def duplicate_counts(df: DataFrame, batch: str, key: list[str]) -> DataFrame:
    """Rows beyond the first of each key; NULL keys are equal.

    Counts per key before adding up per batch: a key with most of the rows is one
    row per task by the time it is shuffled.
    """
    by = list(dict.fromkeys([batch, *key]))
    return (
        df.groupBy(*by)
        .agg(F.expr("count(*) - 1 as _extra"))
        .groupBy(batch)
        .agg(F.expr("sum(_extra) as duplicates"))
    )


def report(
    df: DataFrame,
    batch: str,
    checks: list[RowCheck],
    key: list[str],
    expected_rows: int | None = None,
    batches: list[int] | DataFrame | None = None,
) -> DataFrame:
    """Long form: (batch, check_name, violations, passed), one row per check.

    With `batches`, a batch without any row fails its row count too. `batches` may be a
    frame with a column of the batch's name, as of the batches that were landed.
    """
    counts = row_check_counts(df, batch, checks)
    if batches is not None:
        kind = df.schema[batch].dataType.simpleString()
        if isinstance(batches, DataFrame):
            listed = batches.select(F.col(batch).cast(kind)).distinct()
        else:
            listed = df.sparkSession.createDataFrame([(b,) for b in batches], f"{quoted(batch)} {kind}")
        counts = listed.join(counts, batch, "full")
        counts = counts.na.fill(0, subset=["rows", *[c.name for c in checks]])
    entries = [f"struct({text(c.name)} as check_name, {quoted(c.name)} as violations)" for c in checks]
    if expected_rows is not None:
        entries.insert(0, f"struct('row_count' as check_name, abs(rows - {expected_rows}) as violations)")
    long = counts.selectExpr(
        f"{quoted(batch)} as batch", f"inline(array({', '.join(entries)})) as (check_name, violations)"
    )
    unique = duplicate_counts(df, batch, key).selectExpr(
        f"{quoted(batch)} as batch", "'unique_key' as check_name", "duplicates as violations"
    )
    return long.unionByName(unique).selectExpr("*", "violations = 0 as passed")


def verdict(checked: DataFrame) -> DataFrame:
    """Per batch: how many checks failed, and their names in order."""
    wanted = [
        "count_if(not passed) as failed_checks",
        "array_join(array_sort(collect_list(if(passed, null, check_name))), ', ') as failures",
    ]
    return checked.groupBy("batch").agg(*[F.expr(w) for w in wanted])


def require_passed(checked: DataFrame) -> None:
    """Raise once, naming every failed check; the report has a row per batch and check."""
    failed = checked.filter("not passed").orderBy("batch", "check_name")
    lines = [f"{r.batch}: {r.check_name} ({r.violations})" for r in failed.toLocalIterator()]
    if lines:
        raise ValueError("data quality failed: " + "; ".join(lines))
