"""Run registry: runs, metrics and predictions as tables."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearling import schemas
from yearling.functions.names import quoted, text
from yearling.sources.staging import staged
from yearling.spec import PanelSpec


def current_run_id(runs: DataFrame, model: str) -> DataFrame:
    """Highest run id of one model, NULL when it has none."""
    return runs.filter(F.col("model_name") == model).selectExpr("max(run_id) as run_id")


def next_run_id(runs: DataFrame) -> int:
    return runs.selectExpr("coalesce(max(run_id), 0) + 1").first()[0]


def with_run_counts(
    runs: DataFrame, run_id: int, training_rows: int, test_rows: int
) -> DataFrame:
    """A version of the table with the counts of one run set."""
    new = {"training_rows": training_rows, "test_rows": test_rows}
    return runs.selectExpr(
        *[
            f"if(run_id = {run_id}, bigint({new[c]}), {c}) as {c}" if c in new else quoted(c)
            for c in runs.columns
        ]
    )


def metric_rows(folds: DataFrame, run_id: int, model: str) -> DataFrame:
    return _conform(folds, schemas.MODEL_METRICS, run_id, model, {})


def prediction_rows(
    scored: DataFrame, spec: PanelSpec, run_id: int, model: str
) -> DataFrame:
    """Test rows with `test_year` and the columns `with_errors` adds."""
    named = {
        "location_id": spec.key,
        "county_name": spec.label,
        "feature_year": spec.time,
        "actual_growth": spec.target,
    }
    return _conform(scored, schemas.PREDICTIONS, run_id, model, named)


def run_row(
    spark: SparkSession,
    run_id: int,
    model: str,
    test_times: list[int],
    training_rows: int,
    test_rows: int,
    notes: str,
    years_before: int = 5,
) -> DataFrame:
    """The feature window recorded starts `years_before` the first test time."""
    first, last = min(test_times), max(test_times)
    window = (first - years_before, last - 1)
    row = (run_id, model, *window, first, last, training_rows, test_rows, notes)
    return spark.createDataFrame([row], schemas.MODEL_RUNS)


class RunIds:
    """Ids of which each is given out once, by exclusive creation of a file named after it.

    A second writer that asks for the same id finds its file and takes the next. The file
    system must create files exclusively, as HDFS and local disks do.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._folder = spark._jvm, folder
        self._files = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def take(self, least: int) -> int:
        """The first id from `least` on that nobody has taken."""
        self._files.mkdirs(self._path(self._folder))
        while not self._created(self._path(f"{self._folder}/{least}")):
            least += 1
        return least

    def release(self, run_id: int) -> None:
        self._files.delete(self._path(f"{self._folder}/{run_id}"), False)

    def _created(self, path) -> bool:
        if self._files.getScheme() == "file":
            # Hadoop's local file system looks first and creates then; this is one step.
            return self._jvm.java.io.File(path.toUri().getPath()).createNewFile()
        try:
            self._files.create(path, False).close()
        except Py4JJavaError as problem:
            if "FileAlreadyExists" not in problem.java_exception.getClass().getName():
                raise
            return False
        return True


class Registry:
    """Three tables below one folder, a folder for each run id in each. Writers may record
    at the same time.

    A run's id is its alone from the start (`RunIds`); an attempt that raises gives it
    back, and one that dies leaves a gap. Its metrics and predictions are written first,
    the run row last, which marks success: what a broken attempt left is not read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._ids = RunIds(spark, f"{self.path}/_ids")

    def _read(self, table: str, schema) -> DataFrame:
        folder = f"{self.path}/{table}"
        try:
            return self.spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def runs(self) -> DataFrame:
        return self._read("model_runs", schemas.MODEL_RUNS)

    def metrics(self) -> DataFrame:
        return self._finished(self._read("model_metrics", schemas.MODEL_METRICS))

    def predictions(self) -> DataFrame:
        return self._finished(self._read("predictions", schemas.PREDICTIONS))

    def _finished(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.runs().select("run_id"), "run_id", "left_semi")

    def record(
        self,
        model: str,
        notes: str,
        test_times: list[int],
        folds: DataFrame,
        scored: DataFrame,
        spec: PanelSpec,
        years_before: int = 5,
    ) -> int:
        """Store one evaluated run and return its id."""
        run_id = self._ids.take(next_run_id(self.runs()))
        try:
            self._record(run_id, model, notes, test_times, folds, scored, spec, years_before)
        except BaseException:
            self._ids.release(run_id)
            raise
        return run_id

    def _record(
        self, run_id, model, notes, test_times, folds, scored, spec, years_before
    ) -> None:
        self._store("model_metrics", metric_rows(folds, run_id, model), run_id)
        # A metric row per fold: as many as the caller listed test times.
        stored = (
            self._read("model_metrics", schemas.MODEL_METRICS)
            .filter(f"run_id = {run_id}")
            .select("test_year", "training_rows", "test_rows")
            .collect()
        )
        if not stored:
            raise ValueError("no fold has both training and test rows")
        # Only rows of folds that counted are predictions.
        kept = scored.filter(F.col("test_year").isin([r.test_year for r in stored]))
        self._store("predictions", prediction_rows(kept, spec, run_id, model), run_id)
        row = run_row(
            self.spark,
            run_id,
            model,
            test_times,
            sum(r.training_rows for r in stored),
            sum(r.test_rows for r in stored),
            notes,
            years_before,
        )
        self._store("model_runs", row.coalesce(1), run_id)

    def set_counts(self, run_id: int, training_rows: int, test_rows: int) -> None:
        """Set the counts of one stored run. Only its folder is rewritten."""
        run = self.runs().filter(F.col("run_id") == run_id)
        changed = staged(with_run_counts(run, run_id, training_rows, test_rows), "run")
        if changed.isEmpty():
            raise ValueError(f"no run {run_id}")
        changed.coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("run_id").parquet(f"{self.path}/model_runs")

    def _store(self, table: str, rows: DataFrame, run_id: int) -> None:
        folder = f"{self.path}/{table}/run_id={run_id}"
        rows.drop("run_id").write.mode("overwrite").parquet(folder)


def _conform(
    df: DataFrame, schema: T.StructType, run_id: int, model: str, source: dict[str, str]
) -> DataFrame:
    """The declared columns and types, from `source` where names differ."""
    source = {"run_id": str(run_id), "model_name": text(model)} | {
        name: quoted(column) for name, column in source.items()
    }
    return df.selectExpr(
        *[
            f"cast({source.get(f.name, f.name)} as {f.dataType.simpleString()}) as {f.name}"
            for f in schema
        ]
    )
