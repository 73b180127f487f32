"""Forecast errors, per-fold metrics and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearling.functions import metrics
from yearling.functions.names import quoted, text
from yearling.functions.numeric import percent
from yearling.operators.folds import per_fold
from yearling.operators.panel import complete_rows
from yearling.operators.quantile import exact_median
from yearling.spec import PanelSpec

METRICS = ["growth_mae", "growth_rmse", "growth_r2", "population_mae", "population_mape"]


def with_errors(df: DataFrame, spec: PanelSpec, predicted: str) -> DataFrame:
    """Turn growth back into population and add every error column."""
    value, target, predicted = map(quoted, (spec.value, spec.target, predicted))
    return (
        df.selectExpr(
            "*",
            f"{value} * (1 + {target}) as actual_population",
            f"{value} * (1 + {predicted}) as predicted_population",
            f"{predicted} - {target} as prediction_error",
        )
        .selectExpr("*", "predicted_population - actual_population as population_error")
        .selectExpr(
            "*",
            "abs(population_error) as absolute_population_error",
            f"{percent('abs(population_error)', 'abs(actual_population)')}"
            " as absolute_percentage_error",
            f"{percent('population_error', 'actual_population')} as population_error_pct",
        )
    )


def metric_columns(spec: PanelSpec, predicted: str) -> list[str]:
    """The five metrics over rows that `with_errors` has seen."""
    target, predicted = quoted(spec.target), quoted(predicted)
    return [
        f"{metrics.mae(target, predicted)} as growth_mae",
        f"{metrics.rmse(target, predicted)} as growth_rmse",
        f"{metrics.r2(target, predicted)} as growth_r2",
        "avg(absolute_population_error) as population_mae",
        "avg(absolute_percentage_error) as population_mape",
    ]


def persistence_rows(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Complete rows with last year's growth as the forecast, and its errors."""
    wanted = panel.select(*map(quoted, spec.persistence_columns))
    complete = complete_rows(wanted, [spec.past, spec.target])
    forecast = complete.selectExpr("*", f"{quoted(spec.past)} as predicted_growth")
    return with_errors(forecast, spec, "predicted_growth")


def persistence_metrics(
    panel: DataFrame, spec: PanelSpec, test_times: Sequence[int]
) -> DataFrame:
    """Rolling metrics of the persistence forecast from one pass over the panel.

    Every time is aggregated once, as if it were a test; folds then only combine
    one row per time. No row is repeated per fold.
    """
    wanted = ["count(*) as _rows", *metric_columns(spec, "predicted_growth")]
    by_time = (
        persistence_rows(panel, spec)
        .filter(f"{quoted(spec.time)} <= {max(test_times)}")
        .groupBy(quoted(spec.time))
        .agg(*[F.expr(w) for w in wanted])
    )
    return per_fold(by_time, spec.time, "_rows", test_times, carry=METRICS)


def scored_metrics(scored: DataFrame, folds: DataFrame, spec: PanelSpec) -> DataFrame:
    """Metrics of fitted models: per (model_name, test_year), with fold counts.

    `scored` holds test rows with `predicted_growth`; both sides of the join are
    one row per fold and model.
    """
    found = (
        with_errors(scored, spec, "predicted_growth")
        .groupBy("model_name", "test_year")
        .agg(*[F.expr(w) for w in metric_columns(spec, "predicted_growth")])
    )
    return folds.join(found, "test_year")


def _fold_range() -> list[str]:
    return [
        "min(test_year) as first_test_year",
        "max(test_year) as last_test_year",
        "count(*) as years_evaluated",
    ]


def fold_averages(folds: DataFrame) -> DataFrame:
    """Unweighted means over folds, their range and the running row totals."""
    return folds.selectExpr(
        *_fold_range(),
        "sum(training_rows) as total_training_rows",
        "sum(test_rows) as total_test_rows",
        *[f"avg({m}) as avg_{m}" for m in METRICS],
    )


def fold_lines(folds: DataFrame) -> DataFrame:
    """Add `line`: the fold's metrics as one line of text."""
    shown = "'%d mae=%.6f rmse=%.6f r2=%.6f mape=%.2f%%'"
    values = "test_year, growth_mae, growth_rmse, growth_r2, population_mape"
    return folds.selectExpr("*", f"format_string({shown}, {values}) as line")


def summary_lines(folds: DataFrame) -> DataFrame:
    """(ordinal, line): the range of the folds and their unweighted means as text."""
    shown = [
        ("'test years %d-%d'", "first_test_year, last_test_year"),
        ("'years evaluated %d'", "years_evaluated"),
        ("'average growth mae %.6f'", "avg_growth_mae"),
        ("'average growth rmse %.6f'", "avg_growth_rmse"),
        ("'average growth r2 %.6f'", "avg_growth_r2"),
        ("'average population mae %.0f'", "avg_population_mae"),
        ("'average population mape %.2f%%'", "avg_population_mape"),
    ]
    return _lines(fold_averages(folds), shown).selectExpr("ordinal", "line")


def comparison_lines(wide: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """(test_year, ordinal, line): growth and population metrics of each model in a fold."""
    shown = []
    for prefix in prefixes:
        name = text(prefix)
        c = {m: quoted(f"{prefix}_{m}") for m in ("mae", "rmse", "r2", "population_mae", "mape")}
        shown.append(
            ("'%s growth mae=%.6f rmse=%.6f r2=%.6f'", f"{name}, {c['mae']}, {c['rmse']}, {c['r2']}")
        )
        shown.append(
            ("'%s population mae=%.0f mape=%.2f%%'", f"{name}, {c['population_mae']}, {c['mape']}")
        )
    return _lines(wide, shown).selectExpr("test_year", "ordinal", "line")


def _lines(df: DataFrame, shown: list[tuple[str, str]]) -> DataFrame:
    """A row per (format, values) of each row, numbered from 1."""
    lines = ", ".join(f"format_string({form}, {values})" for form, values in shown)
    return df.selectExpr("*", f"posexplode(array({lines})) as (_at, line)").selectExpr(
        "*", "_at + 1 as ordinal"
    )


def error_summary(scored: DataFrame, spec: PanelSpec, by: str = "test_year") -> DataFrame:
    """Count, MAE, MAPE, median APE, largest error and the two extreme rows.

    Ties go to the first row by (label, time). `scored` is read several times:
    give a stored table.
    """
    label = quoted(spec.label)
    row = f"struct({label} as label, population_error as error, population_error_pct as pct)"
    tie = f"{label}, {quoted(spec.time)}"
    wanted = [
        "count(*) as rows_evaluated",
        "avg(abs(population_error)) as mean_absolute_error",
        "avg(_ape) as mean_absolute_pct_error",
        "max(abs(population_error)) as max_absolute_error",
        f"min_by({row}, struct(-population_error, {tie})) as _over",
        f"min_by({row}, struct(population_error, {tie})) as _under",
    ]
    scored = scored.selectExpr("*", "abs(population_error_pct) as _ape")
    extremes = [
        f"_{side}.{part} as largest_{side}_{part}"
        for side in ("over", "under")
        for part in ("label", "error", "pct")
    ]
    summary = (
        scored.groupBy(quoted(by))
        .agg(*[F.expr(w) for w in wanted])
        .selectExpr("*", *extremes)
        .drop("_over", "_under")
    )
    median = exact_median(scored, [by], "_ape", "median_absolute_pct_error")
    return summary.join(median, by, "left")


def comparison(metrics_rows: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """One wide row per test year: `<prefix>_<metric>` for each model."""
    short = {
        "growth_mae": "mae",
        "growth_rmse": "rmse",
        "growth_r2": "r2",
        "population_mae": "population_mae",
        "population_mape": "mape",
    }
    wide = [
        f"max({metric}) filter (where model_name = {text(model)}) as {quoted(f'{prefix}_{name}')}"
        for metric, name in short.items()
        for model, prefix in prefixes.items()
    ]
    return metrics_rows.groupBy("test_year", "training_rows", "test_rows").agg(
        *[F.expr(w) for w in wide]
    )


def comparison_averages(wide: DataFrame) -> DataFrame:
    """Unweighted mean over folds of every model metric, and the fold range."""
    shared = ("test_year", "training_rows", "test_rows")
    return wide.selectExpr(
        *_fold_range(), *[f"avg({quoted(c)}) as {quoted(f'avg_{c}')}" for c in wide.columns if c not in shared]
    )
