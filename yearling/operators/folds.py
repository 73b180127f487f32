"""Expanding-window folds: train on every earlier time, test on one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearling.functions.names import quoted


#: Folds up to which a row per time is repeated for each later fold.
FEW = 64


def _array(test_times: Sequence[int]) -> str:
    return f"array({', '.join(str(int(t)) for t in sorted(set(test_times)))})"


def _served(time: str, test_times: Sequence[int]) -> str:
    """The folds a row at `time` serves: one output row each."""
    return f"explode(filter({_array(test_times)}, fold -> fold >= {quoted(time)})) as test_year"


def first_fold(time: str, test_times: Sequence[int]) -> str:
    """The first fold that trains on a row at `time`, NULL when none does.

    A fold's training rows are those of its own and of all earlier first folds, so
    anything that adds up needs one sum per fold and not one per time.
    """
    return f"array_min(filter({_array(test_times)}, fold -> fold > {quoted(time)}))"


def fold_rows(df: DataFrame, time: str, test_times: Sequence[int]) -> DataFrame:
    """Every row once per fold it serves, with `test_year` and `role`.

    Repeats a row for each later fold without a join. Only for work that needs the
    rows themselves; counts and metrics use `per_fold` below.
    """
    role = f"if({quoted(time)} = test_year, 'test', 'train') as role"
    return df.selectExpr("*", _served(time, test_times)).selectExpr("*", role)


def fold_counts(
    df: DataFrame, key: str, time: str, test_times: Sequence[int]
) -> DataFrame:
    """`training_rows` and `test_rows` of each key in each fold that it serves.

    Rows are counted per key and time first; only these counts are dealt to folds.
    """
    name, key, time = time, quoted(key), quoted(time)
    counted = (
        df.filter(F.col(time) <= max(test_times)).groupBy(key, time).agg(F.count("*").alias("_n"))
    )
    earlier, same = (F.col(time) < F.col("test_year")), (F.col(time) == F.col("test_year"))
    return (
        counted.selectExpr("*", _served(name, test_times))
        .groupBy(key, "test_year")
        .agg(
            F.sum(F.when(earlier, F.col("_n")).otherwise(0)).alias("training_rows"),
            F.sum(F.when(same, F.col("_n")).otherwise(0)).alias("test_rows"),
        )
    )


def per_fold(
    by_time: DataFrame,
    time: str,
    rows: str,
    test_times: Sequence[int],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Folds from one-row-per-time aggregates.

    Adds up `rows` of the earlier times and carries the test time's own columns.
    The input has one row per time, so the repetition is times x folds; above `FEW`
    folds running totals take its place. A fold without a training or a test row is left
    out.
    """
    if len(set(test_times)) > FEW:
        listed = by_time.sparkSession.createDataFrame(
            [(int(t),) for t in sorted(set(test_times))], "test_year int"
        )
        return every_fold(by_time, time, rows, carry).join(listed, "test_year", "left_semi")
    served = _served(time, test_times)
    time, rows = quoted(time), quoted(rows)
    test, train = f"{time} = test_year", f"{time} < test_year"
    wanted = [
        f"sum({rows}) filter (where {train}) as training_rows",
        f"sum({rows}) filter (where {test}) as test_rows",
        f"min({time}) filter (where {train}) as first_training_year",
        f"max({time}) filter (where {train}) as last_training_year",
        *[f"max({quoted(c)}) filter (where {test}) as {quoted(c)}" for c in carry],
    ]
    return (
        by_time.selectExpr("*", served)
        .groupBy("test_year")
        .agg(*[F.expr(w) for w in wanted])
        .filter("training_rows > 0 and test_rows > 0")
    )


def earlier_totals(
    by_time: DataFrame, time: str, sums: Sequence[str], span: int = 1024
) -> DataFrame:
    """Adds to one-row-per-time rows what lies before each: `before_<c>`, the total of each
    listed column over all earlier times (0 at the first), and `first_before` and
    `last_before`, the first and last earlier time (NULL at the first).

    A scan in two levels: times are cut into spans of `span` steps, totals of whole spans
    are added up in order, one row per span, and each span then adds up its own rows. So
    the work is linear in the times and no task sorts more than a span's rows, or one row
    of each span. `time` is a whole number or a date; rows without one are left out.
    """
    name, time = time, quoted(time)
    steps = f"unix_date({time})" if dict(by_time.dtypes)[name] == "date" else time
    placed = by_time.filter(f"{time} is not null").withColumn(
        "_span", F.expr(f"floor({steps} / {span})")
    )
    whole = placed.groupBy("_span").agg(
        *[F.sum(quoted(c)).alias(f"_sum{i}") for i, c in enumerate(sums)],
        F.min(time).alias("_low"),
        F.max(time).alias("_high"),
    )
    ahead = "over (order by _span rows between unbounded preceding and 1 preceding)"
    whole = whole.selectExpr(
        "_span",
        *[f"coalesce(sum(_sum{i}) {ahead}, 0) as _ahead{i}" for i in range(len(sums))],
        f"min(_low) {ahead} as _first",
        f"max(_high) {ahead} as _last",
    )
    within = f"over (partition by _span order by {time} rows between unbounded preceding and 1 preceding)"
    columns = [quoted(c) for c in by_time.columns]
    return placed.join(whole, "_span").selectExpr(
        *columns,
        *[
            f"_ahead{i} + coalesce(sum({quoted(c)}) {within}, 0) as {quoted(f'before_{c}')}"
            for i, c in enumerate(sums)
        ],
        f"coalesce(_first, min({time}) {within}) as first_before",
        f"coalesce(max({time}) {within}, _last) as last_before",
    )


def every_fold(
    by_time: DataFrame,
    time: str,
    rows: str,
    carry: Sequence[str] = (),
    fold: str = "test_year",
) -> DataFrame:
    """A fold for every time that has rows before it, from one-row-per-time aggregates.

    Linear in the times, however many there are: daily folds of decades are one row a day.
    Columns as of `per_fold`, the fold's time as `fold`.
    """
    kind = dict(by_time.dtypes)[time]
    kind = "int" if kind in ("bigint", "smallint", "tinyint") else kind
    found = earlier_totals(by_time, time, [rows])
    return found.selectExpr(
        f"cast({quoted(time)} as {kind}) as {quoted(fold)}",
        f"{quoted(f'before_{rows}')} as training_rows",
        f"{quoted(rows)} as test_rows",
        "first_before as first_training_year",
        "last_before as last_training_year",
        *[quoted(c) for c in carry],
    ).filter("training_rows > 0 and test_rows > 0")


def expanding_folds(complete: DataFrame, time: str, test_times: Sequence[int]) -> DataFrame:
    """Row counts and training range of each fold that has both roles."""
    by_time = (
        complete.filter(F.col(quoted(time)) <= max(test_times))
        .groupBy(quoted(time))
        .agg(F.expr("count(*) as _rows"))
    )
    return per_fold(by_time, time, "_rows", test_times)
