"""Exact median of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearling.functions.names import quoted
from yearling.sources.staging import staged

# Fixed monotone code: ln(size) * 2^30 as a whole number, lifted above zero.
_SIZE = "floor(least(ln(abs(_v)), 800) * 1073741824) + 1099511627776"
_CODE = f"bigint(case when _v > 0 then {_SIZE} when _v < 0 then -({_SIZE}) else 0 end)"
# Bins of about a thousandth, then of a billionth, then single values.
_BINS = [f"shiftright({_CODE}, 20)", _CODE, "_v"]


def exact_median(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Median per group (mean of the middle two), as `by` + [name].

    The built-in median holds a whole group in one task. Here the two middle ranks
    are narrowed down by histograms: some thousand bins to an e-fold of values,
    then a million to each of those, then the values of one bin, less than a
    billionth apart. Bin counts merge in each task, so little is ever shuffled,
    and no step sorts more than a few million rows of a group.

    `df` is read once per step: give a stored table. The bins kept by a step are
    stored too, so Spark knows their size when it picks the join.
    """
    value = quoted(value)
    values = df.filter(f"{value} is not null and not isnan({value})").selectExpr(
        *map(quoted, by), f"double({value}) as _v"
    )
    kept = _middle(values.selectExpr("*", f"{_BINS[0]} as _bin"), by, [])
    for wider, finer in zip(_BINS, _BINS[1:]):
        known = staged(kept.drop("_rows"), "median-bins")
        inside = values.selectExpr("*", f"{wider} as _bin").join(known, [*by, "_bin"])
        kept = _middle(
            inside.drop("_bin").selectExpr("*", f"{finer} as _bin"), by, ["_lo", "_hi"]
        )
    low, high = [f"max(_bin) filter (where {_covers(r)})" for r in ("_lo", "_hi")]
    return kept.groupBy(*by).agg(F.expr(f"({low} + {high}) / 2 as {quoted(name)}"))


def _covers(rank: str) -> str:
    return f"{rank} >= 0 and {rank} < _rows"


def _middle(values: DataFrame, by: list[str], held: list[str]) -> DataFrame:
    """Bins holding a middle rank, with both ranks counted from the bin's start."""
    group = ", ".join([*map(quoted, by), *held])
    bins = values.groupBy(*by, *held, "_bin").agg(F.expr("count(*) as _rows"))
    before = f"sum(_rows) over (partition by {group} order by _bin) - _rows"
    size = f"sum(_rows) over (partition by {group})"
    ranks = held or [f"floor(({size} - 1) / 2)", f"floor({size} / 2)"]
    left = [f"{rank} - ({before}) as {n}" for rank, n in zip(ranks, ("_lo", "_hi"))]
    return bins.selectExpr(*map(quoted, by), "_bin", "_rows", *left).filter(
        f"({_covers('_lo')}) or ({_covers('_hi')})"
    )
