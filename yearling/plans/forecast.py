"""Whole evaluations: persistence, linear, forest and their comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearling.functions.names import quoted
from yearling.operators import evaluation as ev
from yearling.operators import models
from yearling.operators.folds import expanding_folds
from yearling.operators.panel import complete_rows, require_columns, require_rows, time_split
from yearling.operators.runs import Registry
from yearling.sources.staging import staged
from yearling.spec import PanelSpec

# Fixed value: the model name of recorded runs.
PERSISTENCE = "persistence_baseline"


def model_table(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Complete rows of the model columns, stored by time for the many passes."""
    require_columns(panel, spec.model_columns)
    names = dict.fromkeys([*spec.model_columns, spec.value, spec.past])
    wanted = panel.select(*map(quoted, names))
    ready = complete_rows(wanted, [*spec.features, spec.target])
    return staged(ready, "model-table", [spec.time])


def run_persistence(
    panel: DataFrame,
    spec: PanelSpec,
    test_times: list[int],
    registry: Registry,
    notes: str = "last known growth carried forward",
) -> int:
    """Evaluate and record the persistence forecast; returns the run id."""
    scored = ev.persistence_rows(panel, spec).filter(F.col(quoted(spec.time)).isin(test_times))
    scored = scored.selectExpr("*", f"int({quoted(spec.time)}) as test_year")
    folds = ev.persistence_metrics(panel, spec, test_times)
    return registry.record(PERSISTENCE, notes, test_times, folds, scored, spec)


def linear_validation(panel: DataFrame, spec: PanelSpec, test_times: list[int]) -> DataFrame:
    """Fold metrics of the rolling linear regression."""
    table = model_table(panel, spec)
    scored = models.linear_rolling(table, spec, test_times)
    return ev.scored_metrics(scored, expanding_folds(table, spec.time, test_times), spec)


def forest_split(
    panel: DataFrame,
    spec: PanelSpec,
    train_until: int,
    test_at: int,
    params: models.ForestParams = models.ForestParams(),
):
    """One forest on one time split: (forest, scored test rows with errors)."""
    require_columns(panel, [spec.key, spec.label, *spec.model_columns])
    table = time_split(model_table(panel, spec), spec.time, train_until, test_at)
    train = table.filter("role = 'train'")
    test = require_rows(table.filter("role = 'test'"), "test set")
    rows = train.count()
    if rows == 0:
        raise ValueError("training set: no rows")
    forest = models.fit_forests([(train, rows)], spec, params)[0]
    scored = models.predict_forest(forest, test.drop("role"), spec)
    return forest, ev.with_errors(scored, spec, "predicted_growth")


def rolling_comparison(
    panel: DataFrame,
    spec: PanelSpec,
    test_times: list[int],
    params: models.ForestParams = models.ForestParams(),
) -> DataFrame:
    """Persistence beside the forest, one wide row per fold."""
    table = model_table(panel, spec)
    # One row per listed test year comes back. Both models see the rows complete in every feature.
    folds = expanding_folds(table, spec.time, test_times)
    sizes = {r.test_year: r.training_rows for r in folds.collect()}
    if not sizes:
        raise ValueError("no fold has both training and test rows")
    usable = sorted(sizes)
    forest = models.forest_rolling(table, spec, sizes, params)
    tests = table.filter(F.col(quoted(spec.time)).isin(usable))
    baseline = tests.selectExpr(
        "*",
        f"int({quoted(spec.time)}) as test_year",
        f"{quoted(spec.past)} as predicted_growth",
        f"'{PERSISTENCE}' as model_name",
    )
    both = forest.select(*map(quoted, baseline.columns)).unionByName(baseline)
    rows = ev.scored_metrics(both, folds, spec)
    return ev.comparison(rows, {PERSISTENCE: "baseline", "random_forest": "rf"})
