"""Linear and forest forecasts over expanding folds."""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearling.functions.names import quoted
from yearling.operators.folds import first_fold
from yearling.spec import PanelSpec

# --- linear regression -------------------------------------------------------


@dataclass(frozen=True)
class LinearFit:
    test_year: int
    intercept: float
    coefficients: list[float]


def fit_linear(complete: DataFrame, spec: PanelSpec, test_times: list[int]) -> list[LinearFit]:
    """Ordinary least squares with intercept for every fold, from two passes.

    Cross products add up: each row is summed once, under the first fold it trains,
    and a fold is the sum over itself and the folds before. The data is not read
    again per fold; what comes to the driver is one small matrix per fold.
    """
    names = list(spec.features)
    columns = names + [spec.target]
    usable = complete.filter(f"{quoted(spec.time)} < {max(test_times)}")
    moments = usable.selectExpr(
        *[f"avg({quoted(c)}) as m{i}" for i, c in enumerate(columns)],
        *[f"stddev_pop({quoted(c)}) as s{i}" for i, c in enumerate(columns)],
    ).first()
    if moments["m0"] is None:
        return []
    center = np.array([moments[f"m{i}"] for i in range(len(columns))], dtype=float)
    scale = np.array([moments[f"s{i}"] or 1.0 for i in range(len(columns))], dtype=float)
    usable = usable.selectExpr(
        f"{first_fold(spec.time, test_times)} as _fold",
        *[f"double({quoted(c)}) as _c{i}" for i, c in enumerate(columns)],
    )
    places = [f"_c{i}" for i in range(len(columns))]
    grams = _cross_products(usable, "_fold", places, center, scale)

    fits = []
    for test in sorted(set(test_times)):
        past = [g for fold, g in grams.items() if fold <= test]
        if past:
            intercept, coefficients = _solve(sum(past), center, scale)
            fits.append(LinearFit(test, intercept, coefficients))
    return fits


def _cross_products(
    df: DataFrame, group: str, columns: list[str], center: np.ndarray, scale: np.ndarray
) -> dict[int, np.ndarray]:
    """Z'Z per group of Z = [1, (columns - center) / scale], summed on executors."""
    width = len(columns) + 1
    upper = np.triu_indices(width)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            values = (batch[columns].to_numpy(dtype=float) - center) / scale
            z = np.column_stack([np.ones(len(values)), values])
            groups = batch[group].to_numpy()
            for g in np.unique(groups):
                part = z[groups == g]
                sums[int(g)] = sums.get(int(g), 0) + part.T @ part
        for g, gram in sums.items():
            yield pd.DataFrame({"g": g, "i": np.arange(len(upper[0])), "v": gram[upper]})

    summed = (
        df.mapInPandas(partial, "g bigint, i int, v double")
        .groupBy("g", "i")
        .agg(F.expr("sum(v) as v"))
        .toPandas()
    )
    grams = {}
    for g, rows in summed.groupby("g"):
        gram = np.zeros((width, width))
        gram[upper[0][rows["i"]], upper[1][rows["i"]]] = rows["v"]
        grams[int(g)] = gram + np.triu(gram, 1).T
    return grams


def _solve(gram: np.ndarray, center: np.ndarray, scale: np.ndarray) -> tuple[float, list[float]]:
    """Least-squares solution of smallest norm in the original units."""
    mean = gram[0, 1:] / gram[0, 0]
    spread = gram[1:, 1:] - gram[0, 0] * np.outer(mean, mean)
    xx, xy = spread[:-1, :-1], spread[:-1, -1]
    size, axes = np.linalg.eigh(xx)
    used = size > max(size[-1], 0.0) * 1e-12
    beta = axes[:, used] @ ((axes[:, used].T @ xy) / size[used])
    beta = beta * scale[-1] / scale[:-1]
    if not used.all():
        # Collinear features: drop the part along the free directions.
        free, _ = np.linalg.qr(axes[:, ~used] / scale[:-1, None])
        beta = beta - free @ (free.T @ beta)
    at = center + mean * scale
    return float(at[-1] - at[:-1] @ beta), [float(b) for b in beta]


def predict_linear(complete: DataFrame, spec: PanelSpec, fits: list[LinearFit]) -> DataFrame:
    """Test rows of every fitted fold with `test_year` and `predicted_growth`."""
    spark = complete.sparkSession
    rows = [(f.test_year, f.intercept, f.coefficients) for f in fits]
    table = spark.createDataFrame(rows, "test_year int, _b double, _w array<double>")
    guess = " + ".join(["_b", *[f"_w[{i}] * {quoted(c)}" for i, c in enumerate(spec.features)]])
    # One row per fold the caller listed: always small.
    return (
        complete.filter(F.col(quoted(spec.time)).isin([f.test_year for f in fits]))
        .selectExpr("*", f"int({quoted(spec.time)}) as test_year")
        .join(F.broadcast(table), "test_year")
        .selectExpr(
            "*", f"{guess} as predicted_growth", "'linear_regression' as model_name"
        )
        .drop("_b", "_w")
    )


def linear_rolling(complete: DataFrame, spec: PanelSpec, test_times: list[int]) -> DataFrame:
    return predict_linear(complete, spec, fit_linear(complete, spec, test_times))


# --- random forest -----------------------------------------------------------

# Rows of a partition while a forest grows, for few rows and for many; the number of
# partitions follows from the rows alone, as the rows a tree draws depend on it.
_FEW_ROWS_PER_TASK, _FEW_TASKS = 100, 4
_ROWS_PER_TASK = 20_000
_FITS_AT_ONCE = 16

# Bytes of a node of a tree in memory, as measured with some to spare.
_NODE_BYTES = 200


@dataclass(frozen=True)
class ForestParams:
    """Grown deep on all features, as the usual regression forest is.

    Spark cuts features into `max_bins` at most and stops at depth 30. A tree draws
    `tree_rows` rows at most on average, with replacement, whatever the training set: the
    bound of a documented sample, which the caller states. So a forest has at most
    2 * `trees` * `tree_rows` / `min_rows` nodes at any size of the training set. The
    driver and every task that scores hold them: `model_mb` is checked before a forest is
    grown, and again before it is sent to score.
    """

    trees: int = 300
    seed: int = 42
    max_depth: int = 30
    max_bins: int = 32
    min_rows: int = 1
    memory_mb: int = 1024
    tree_rows: int = 4096
    model_mb: int = 512

    def __post_init__(self) -> None:
        leaves = min(2**self.max_depth, self.tree_rows // self.min_rows)
        most = 2 * self.trees * leaves * _NODE_BYTES >> 20
        if most > self.model_mb:
            raise ValueError(
                f"a forest may take {most} MB, over model_mb = {self.model_mb}: "
                "fewer trees or tree_rows, or more min_rows"
            )


@dataclass(frozen=True)
class Forest:
    model: RandomForestRegressionModel
    model_mb: int = ForestParams.model_mb

    @property
    def trees(self) -> int:
        return self.model.getNumTrees

    @property
    def nodes(self) -> int:
        return self.model.totalNumNodes

    @property
    def importances(self) -> list[float]:
        """Per feature, adding up to 1: the mean over trees."""
        return [float(w) for w in self.model.featureImportances.toArray()]


def _assembled(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Adds `_features`, in the order of the spec, whatever the features are called."""
    places = [f"_f{i}" for i in range(len(spec.features))]
    named = df.selectExpr(
        "*", *[f"{quoted(c)} as {p}" for c, p in zip(spec.features, places)]
    )
    assembler = VectorAssembler(inputCols=places, outputCol="_features", handleInvalid="error")
    return assembler.transform(named).drop(*places)


def _tasks(rows: int) -> int:
    few = min(_FEW_TASKS, math.ceil(rows / _FEW_ROWS_PER_TASK))
    return max(1, few, math.ceil(rows / _ROWS_PER_TASK))


def _drawn(
    df: DataFrame, rows: int, by: list[str], params: ForestParams
) -> tuple[DataFrame, int, float]:
    """The rows the trees draw from, their number, and the share of them that one draws.

    A forest of t trees sees t * `tree_rows` different rows at most; of more, so many are
    kept by the hash of key and time, which depends on nothing else.
    """
    most = params.trees * params.tree_rows
    if rows > most:
        steps = 1 << 30
        hashed = F.pmod(F.xxhash64(*map(quoted, by), F.lit(params.seed)), F.lit(steps))
        df, rows = df.filter(hashed < steps * most // rows), most
    return df, rows, min(1.0, params.tree_rows / max(rows, 1))


def fit_forests(
    sets: list[tuple[DataFrame, int]], spec: PanelSpec, params: ForestParams = ForestParams()
) -> list[Forest]:
    """One forest per (training rows, their number); independent fits run at once.

    A fit depends on the rows, the parameters and the seed, and on nothing of the
    cluster: rows are dealt by key to partitions whose number follows from the rows, and
    sorted in them.
    """
    spark = sets[0][0].sparkSession
    by = [spec.key, spec.time]
    ready = []
    for df, rows in sets:
        pool, size, share = _drawn(df, rows, by, params)
        laid = (
            pool.select(*map(quoted, spec.model_columns))
            .repartition(_tasks(size), *map(quoted, by))
            .sortWithinPartitions(*map(quoted, by))
        )
        target = F.col(quoted(spec.target)).alias("_target")
        ready.append((_assembled(laid, spec).select("_features", target), share))

    @inheritable_thread_target(spark)
    def grow(drawn: tuple[DataFrame, float]) -> Forest:
        rows, share = drawn
        return Forest(
            RandomForestRegressor(
                featuresCol="_features",
                labelCol="_target",
                subsamplingRate=share,
                numTrees=params.trees,
                seed=params.seed,
                maxDepth=params.max_depth,
                maxBins=params.max_bins,
                minInstancesPerNode=params.min_rows,
                maxMemoryInMB=params.memory_mb,
                featureSubsetStrategy="all",
            ).fit(rows),
            params.model_mb,
        )

    with ThreadPoolExecutor(max_workers=_FITS_AT_ONCE) as pool:
        return list(pool.map(grow, ready))


def predict_forest(forest: Forest, test: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add `predicted_growth`: the mean over all trees. Every task that scores gets them."""
    if forest.nodes * _NODE_BYTES > forest.model_mb << 20:
        raise ValueError(f"forest of {forest.nodes} nodes is over {forest.model_mb} MB")
    scored = forest.model.setPredictionCol("predicted_growth").transform(_assembled(test, spec))
    return scored.selectExpr(
        "*", f"int({quoted(spec.time)}) as test_year", "'random_forest' as model_name"
    ).drop("_features")


def forest_rolling(
    complete: DataFrame,
    spec: PanelSpec,
    training_rows: dict[int, int],
    params: ForestParams = ForestParams(),
) -> DataFrame:
    """A forest per test time, its test rows scored; `complete` should be a table.

    A table partitioned by time makes each fold read its own years only.
    """
    tests = sorted(training_rows)
    time = quoted(spec.time)
    sets = [(complete.filter(f"{time} < {t}"), training_rows[t]) for t in tests]
    scored = [
        predict_forest(forest, complete.filter(f"{time} = {t}"), spec)
        for t, forest in zip(tests, fit_forests(sets, spec, params))
    ]
    return reduce(DataFrame.unionByName, scored)


def feature_importance(
    forest: Forest, spec: PanelSpec, spark: SparkSession, top: int = 15
) -> DataFrame:
    """(feature, importance), largest first."""
    rows = list(zip(spec.features, forest.importances))
    listed = spark.createDataFrame(rows, "feature string, importance double")
    return listed.orderBy(F.desc("importance"), "feature").limit(top)


def importance_lines(ranked: DataFrame) -> DataFrame:
    """(ordinal, line): ranked importances as text."""
    place = "row_number() over (order by importance desc, feature) as ordinal"
    return ranked.selectExpr(place, "format_string('%s: %.6f', feature, importance) as line")
