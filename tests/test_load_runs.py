import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import types as T

from yearling.operators import runs
from yearling.operators.load import insert_skip_existing, rows_to_insert, table_profile
from yearling.plans import forecast
from yearling.sources.staging import shared_folder
from yearling.sources.tables import (
    append,
    clashing_keys,
    create_table,
    create_table_like,
    storage_type,
    table_key,
    update_by_key,
)
from yearling.spec import PanelSpec

SPEC = PanelSpec()
SCHEMA = "year int, k string, v int"


def batch(spark, *rows_):
    return spark.createDataFrame(list(rows_), SCHEMA)


@pytest.fixture
def target(spark, tmp_path, request):
    name = request.node.name.replace("[", "_").replace("]", "")
    create_table(
        spark,
        name,
        batch(spark).schema,
        key=["year", "k"],
        partition_by=["year"],
        path=str(tmp_path / "table"),
    )
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_first_row_wins_and_twice_is_once(spark, target, rows):
    first = batch(spark, (2020, "a", 2), (2020, "a", 1), (2020, "b", 5))
    insert_skip_existing(first, target, ["v"])
    insert_skip_existing(first, target, ["v"])
    assert rows(spark.table(target), "year", "k", "v") == [(2020, "a", 1), (2020, "b", 5)]
    insert_skip_existing(batch(spark, (2020, "a", 0), (2021, "a", 9)), target, ["v"])
    assert rows(spark.table(target), "year", "k", "v") == [
        (2020, "a", 1),
        (2020, "b", 5),
        (2021, "a", 9),
    ]


def test_null_keys_never_conflict(spark, target):
    nulls = batch(spark, (2020, None, 1), (2020, None, 1), (2020, "a", 1))
    insert_skip_existing(nulls, target, ["v"])
    insert_skip_existing(nulls, target, ["v"])
    found = spark.table(target)
    assert (found.filter("k is null").count(), found.filter("k = 'a'").count()) == (4, 1)


def test_insert_reads_touched_partitions_only(spark, target, plan):
    insert_skip_existing(batch(spark, (2020, "a", 1), (2021, "a", 1)), target, ["v"])
    pruned = spark.table(target).filter("year in (2021)")
    text = plan(rows_to_insert(batch(spark, (2021, "b", 1)), pruned, ["year", "k"], ["v"]))
    assert "PartitionFilters: [isnotnull(year" in text and "LeftAnti" in text
    assert "ReadSchema: struct<k:string>" in text


def test_table_rules(spark, target):
    assert table_key(spark, target) == ["year", "k"]
    create_table(spark, target, batch(spark).schema)
    with pytest.raises(ValueError, match="another schema"):
        create_table(spark, target, T.StructType([T.StructField("k", T.LongType())]))
    with pytest.raises(ValueError, match="empty"):
        insert_skip_existing(batch(spark), target, ["v"])
    with pytest.raises(ValueError, match="empty"):
        create_table_like(batch(spark), "never_made")
    assert not spark.catalog.tableExists("never_made")


def test_append_keeps_the_key_single(spark, target, rows):
    first = batch(spark, (2020, "a", 1), (2020, "b", 2))
    append(first, target)
    for again in (first, batch(spark, (2021, "a", 1), (2020, "b", 9))):
        with pytest.raises(ValueError, match=r"not single: .*\(2020, 'b'\)"):
            append(again, target)
    with pytest.raises(ValueError, match=r"not single: \(2022, 'c'\)$"):
        append(batch(spark, (2022, "c", 1), (2022, "c", 1), (2022, "d", 1)), target)
    many = spark.range(100).selectExpr("2023 as year", "string(id % 50) as k", "int(id) as v")
    with pytest.raises(ValueError, match=r", \.\.\.$"):
        append(many, target)
    assert rows(spark.table(target), "year", "k", "v") == [(2020, "a", 1), (2020, "b", 2)]
    # A key with a NULL part equals none.
    append(batch(spark, (2020, None, 1), (2020, None, 1), (2021, "a", 3)), target)
    append(batch(spark, (2020, None, 1)), target)
    assert spark.table(target).count() == 6


def test_key_check_reads_touched_partitions_and_key_columns(spark, target, plan):
    append(batch(spark, (2020, "a", 1), (2021, "a", 1)), target)
    text = plan(clashing_keys(batch(spark, (2021, "b", 1)), target, ["year", "k"]))
    assert "ReadSchema: struct<k:string>" in text and "Cartesian" not in text


def _files(folder):
    return {
        (os.path.join(d, f), os.stat(os.path.join(d, f)).st_mtime_ns)
        for d, _, names in os.walk(folder)
        for f in names
        if f.endswith(".parquet")
    }


def test_update_rewrites_touched_partitions_only(spark, target, rows, tmp_path):
    append(batch(spark, *[(y, k, 1) for y in (2020, 2021, 2022) for k in "ab"]), target)
    before = _files(tmp_path / "table")
    change = batch(spark, (2021, "a", 7), (2022, "z", 8), (2030, "a", 9))
    for _ in range(2):
        update_by_key(change, target)
        assert rows(spark.table(target), "year", "k", "v") == [
            (2020, "a", 1), (2020, "b", 1), (2021, "a", 7), (2021, "b", 1),
            (2022, "a", 1), (2022, "b", 1),
        ]
    same = _files(tmp_path / "table") & before
    assert {p.split("year=")[1][:4] for p, _ in same} == {"2020", "2022"}
    # NULL is a value to set; a column that is not named stays.
    update_by_key(batch(spark, (2020, "b", None)), target)
    update_by_key(batch(spark, (2020, "a", 5)).drop("v"), target)
    assert rows(spark.table(target).filter("year = 2020"), "k", "v") == [("a", 1), ("b", None)]
    update_by_key(batch(spark), target)
    assert spark.table(target).count() == 6


def test_update_rules(spark, target):
    append(batch(spark, (2020, "a", 1)), target)
    with pytest.raises(ValueError, match="several changes"):
        update_by_key(batch(spark, (2020, "a", 1), (2020, "a", 2)), target)
    with pytest.raises(ValueError, match="no columns \\['w'\\]"):
        update_by_key(batch(spark, (2020, "a", 1)).withColumnRenamed("v", "w"), target)
    with pytest.raises(ValueError, match="not in the key"):
        update_by_key(batch(spark, (2020, "a", 1)), target, key=["k"])


def test_load_counts_come_from_the_writes(spark, target):
    first = batch(spark, (2020, "a", 2), (2020, "a", 1), (2021, "b", 5), (2021, None, 5))
    by = ("year", [2020, 2021, 2022])
    def counts():
        loaded = insert_skip_existing(first, target, ["v"], count_by=by)
        return [tuple(r) for r in loaded.orderBy("year").collect()]

    assert counts() == [(2020, 2, 1, 1), (2021, 2, 2, 0), (2022, 0, 0, 0)]
    # Rows without a whole key are added again.
    assert counts() == [(2020, 2, 0, 2), (2021, 2, 1, 1), (2022, 0, 0, 0)]


def test_a_table_without_key_is_refused(spark, tmp_path):
    create_table(spark, "keyless", batch(spark).schema, path=str(tmp_path / "k"))
    with pytest.raises(ValueError, match="no key"):
        insert_skip_existing(batch(spark, (1, "a", 1)), "keyless", ["v"])


@pytest.mark.parametrize(
    "kind, stored",
    [
        ("tinyint", "BIGINT"),
        ("bigint", "BIGINT"),
        ("float", "DOUBLE PRECISION"),
        ("double", "DOUBLE PRECISION"),
        ("boolean", "BOOLEAN"),
        ("timestamp", "TIMESTAMP"),
        ("timestamp_ntz", "TIMESTAMP"),
        ("string", "TEXT"),
        ("date", "TEXT"),
        ("array<int>", "TEXT"),
    ],
)
def test_storage_types(kind, stored):
    assert storage_type(T.StructType.fromDDL(f"c {kind}")["c"].dataType) == stored


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "a bigint, b string")
    assert rows(table_profile(df)) == [(0, "a", "BIGINT", 2, 2), (1, "b", "TEXT", 2, 1)]


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def panel(spark):
    data = [
        (f"l{i}", f"L{i}", y, 100 + i, 0.01 * i, 0.02 * (i + y - 2000))
        for i in range(6)
        for y in range(2000, 2006)
    ]
    return spark.createDataFrame(
        data,
        "location_id string, county_name string, feature_year int, population bigint,"
        " historical_growth_1yr double, future_growth_1yr double",
    )


def test_runs_are_recorded_after_success(spark, tmp_path):
    registry = runs.Registry(spark, str(tmp_path / "registry"))
    assert registry.runs().count() == 0
    assert runs.current_run_id(registry.runs(), "x").first().run_id is None
    tests = [2000, 2003, 2004]
    assert forecast.run_persistence(panel(spark), SPEC, tests, registry) == 1
    assert forecast.run_persistence(panel(spark), SPEC, tests, registry) == 2
    run = registry.runs().filter("run_id = 2").first()
    # 2000 has no training rows, so it is no fold.
    assert (run.training_rows, run.test_rows) == (6 * 3 + 6 * 4, 12)
    assert (run.feature_start_year, run.feature_end_year) == (1995, 2003)
    assert (run.test_start_year, run.test_end_year) == (2000, 2004)
    assert registry.metrics().filter("run_id = 2").count() == 2
    found = registry.predictions().filter("run_id = 2")
    assert found.count() == 12
    assert {r.test_year for r in found.collect()} == {2003, 2004}
    assert runs.current_run_id(registry.runs(), forecast.PERSISTENCE).first().run_id == 2


def test_a_run_without_folds_leaves_nothing(spark, tmp_path):
    registry = runs.Registry(spark, str(tmp_path / "registry"))
    with pytest.raises(ValueError, match="no fold"):
        forecast.run_persistence(panel(spark), SPEC, [2000], registry)
    assert registry.runs().count() == 0 and registry.metrics().count() == 0
    assert forecast.run_persistence(panel(spark), SPEC, [2003], registry) == 1
    assert registry.metrics().count() == 1


def test_counts_of_one_run_are_set(spark, rows):
    table = spark.createDataFrame(
        [(1, None, None), (2, None, None)],
        "run_id bigint, training_rows bigint, test_rows bigint",
    )
    assert rows(runs.with_run_counts(table, 2, 7, 8)) == [(1, None, None), (2, 7, 8)]


def test_two_writers_get_two_ids(spark, tmp_path):
    registry = runs.Registry(spark, str(tmp_path / "registry"))
    rows = panel(spark).cache()

    @inheritable_thread_target(spark)
    def record(_):
        own = runs.Registry(spark, registry.path)
        return forecast.run_persistence(rows, SPEC, [2003, 2004], own)

    with ThreadPoolExecutor(4) as pool:
        ids = list(pool.map(record, range(4)))
    assert sorted(ids) == [1, 2, 3, 4]
    assert sorted(r.run_id for r in registry.runs().collect()) == ids_of(registry.metrics())
    assert registry.metrics().count() == 8 and registry.predictions().count() == 48


def ids_of(df):
    return sorted({r.run_id for r in df.collect()})


def test_an_id_is_given_out_once(spark, tmp_path):
    folder = str(tmp_path / "ids")
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(lambda _: runs.RunIds(spark, folder).take(1), range(40)))
    assert sorted(taken) == list(range(1, 41))
    ids = runs.RunIds(spark, folder)
    ids.release(7)
    assert (ids.take(1), ids.take(1), ids.take(100)) == (7, 41, 100)


def test_counts_of_a_stored_run(spark, tmp_path):
    registry = runs.Registry(spark, str(tmp_path / "registry"))
    for _ in range(2):
        forecast.run_persistence(panel(spark), SPEC, [2003], registry)
    folder = tmp_path / "registry" / "model_runs"
    before = _files(folder)
    for _ in range(2):
        registry.set_counts(2, 5, 6)
        found = {r.run_id: (r.training_rows, r.test_rows, r.notes) for r in registry.runs().collect()}
        assert found[2][:2] == (5, 6) and found[1][:2] == (18, 6) and found[1][2] == found[2][2]
    assert [p for p, _ in _files(folder) & before if "run_id=1" in p]
    with pytest.raises(ValueError, match="no run 9"):
        registry.set_counts(9, 1, 1)
    assert registry.metrics().count() == 2
