"""Panel shaping: growth, complete rows, splits, guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from yearling.functions.names import quoted
from yearling.functions.numeric import growth, nan_to_null
from yearling.spec import PanelSpec


def with_growth(df: DataFrame, spec: PanelSpec, span: int = 1024) -> DataFrame:
    """Add past and future one-step growth; NULL unless the neighbour is 1 away.

    A key's history is cut into spans of `span` time steps, each sorted by its own
    task, so a key with a very long history is split too. Only the rows at a cut
    are sent to both sides; calendar years have no cut between 1024 and 2047. The
    panel has one row per (key, time), as the loader and the key check ensure.
    """
    time, value = quoted(spec.time), quoted(spec.value)
    home = f"floor({time} / {span})"
    touched = f"array_distinct(array(floor(({time} - 1) / {span}), {home}, floor(({time} + 1) / {span})))"
    over = f"over (partition by {quoted(spec.key)}, _span order by {time})"
    before, after = f"lag({value}) {over}", f"lead({value}) {over}"
    return (
        df.selectExpr("*", f"explode({touched}) as _span")
        .selectExpr(
            "*",
            f"if({time} - lag({time}) {over} = 1, {growth(value, before)}, null) as {quoted(spec.past)}",
            f"if(lead({time}) {over} - {time} = 1, {growth(after, value)}, null) as {quoted(spec.target)}",
        )
        .filter(f"_span <=> {home}")
        .drop("_span")
    )


def create_growth_view(
    spark: SparkSession,
    view: str,
    table: str,
    spec: PanelSpec,
    key: str | None = None,
    time: str | None = None,
) -> None:
    """A catalog view of a stored table with past and future one-step growth.

    `key` and `time` are SQL over the table's columns that give the place and the time step,
    where it does not have them under the names of `spec`. The view has the table's columns,
    these two, and growth as of `with_growth`; any SQL client of the catalog can read it.

    Neighbours are joined on place and time, with the neighbour's time shifted to the row's.
    So a filter by time holds for all three scans: of a table partitioned by time, only the
    years asked for and their neighbours are read.
    """
    own = set(spark.table(table).columns)
    if {spec.key, spec.time} & own and (key or time):
        raise ValueError(f"table {table} has columns named {spec.key} or {spec.time} already")
    at = {spec.key: key or quoted(spec.key), spec.time: time or quoted(spec.time)}
    names, value = [quoted(spec.key), quoted(spec.time)], quoted(spec.value)
    added = [f"{sql} as {quoted(n)}" for n, sql in at.items() if n not in own]

    def neighbour(step: int) -> str:
        return f"""(select {at[spec.key]} as {names[0]}, {at[spec.time]} + ({step}) as {names[1]},
            {value} as _value from {table})"""

    spark.sql(
        f"""create or replace view {view} as
        select c.*,
            {growth(f"c.{value}", "before._value")} as {quoted(spec.past)},
            {growth("after._value", f"c.{value}")} as {quoted(spec.target)}
        from (select {', '.join(['*', *added])} from {table}) c
        left join {neighbour(1)} before
            on before.{names[0]} = c.{names[0]} and before.{names[1]} = c.{names[1]}
        left join {neighbour(-1)} after
            on after.{names[0]} = c.{names[0]} and after.{names[1]} = c.{names[1]}"""
    )


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN counts as missing: Spark sorts it above every number otherwise."""
    return df.selectExpr(
        *[
            f"{nan_to_null(quoted(name))} as {quoted(name)}" if kind in ("double", "float") else quoted(name)
            for name, kind in df.dtypes
        ]
    )


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with no missing value (NULL or NaN) in `columns`."""
    kinds = dict(df.dtypes)
    known = [f"{quoted(c)} is not null" for c in columns]
    known += [f"not isnan({quoted(c)})" for c in columns if kinds[c] in ("double", "float")]
    return df.filter(" and ".join(known)) if known else df


def known_target(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return complete_rows(df, [spec.target])


def time_split(df: DataFrame, time: str, train_until: int, test_at: int) -> DataFrame:
    """Add `role`: 'train' up to a time, 'test' at a time; other rows go."""
    time = quoted(time)
    role = f"case when {time} <= {train_until} then 'train' when {time} = {test_at} then 'test' end"
    return df.selectExpr("*", f"{role} as role").filter("role is not null")


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df
