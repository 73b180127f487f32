import duckdb
import pytest
from conftest_llm import lower, prose

import corpus_pipeline
from yearling.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_on_planted_documents(spark, table, tmp_path):
    base, passage = prose(1, 200), prose(2, 70)
    w = base.split()
    w[100] = "other"
    texts = {
        1: base,
        2: base.upper(),
        3: " ".join(w),
        4: prose(4, 50) + " " + passage,
        5: prose(5, 90) + " " + passage + " " + prose(6, 20),
        6: "12 34 !!",
        7: None,
        8: prose(8, 100),
        9: "Two words",
    }
    docs = table(texts).unionByName(table({8: texts[8]}))
    docs = docs.selectExpr("*", "'x' as kept", "'y' as words_left", "array(doc_id) as component")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        columns, docs = docs.columns, spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(sorted(r[0] for r in docs.select("doc_id").collect()))
        if name != "packing":
            assert docs.columns == columns
        if name == "substring_dedup":
            left = {r.doc_id: r for r in docs.collect()}
    assert kept[0] == [1, 2, 3, 4, 5, 8, 8, 9]
    assert kept[1] == [2, 3, 4, 5, 8, 9]  # of equal texts the largest id
    assert kept[2] == [2, 4, 5, 8, 9]
    assert kept[3] == [2, 4, 5, 8, 9]
    assert lower(left[5].text) == lower(prose(5, 90) + " " + prose(6, 20))
    assert left[5].n_chars == len(left[5].text)
    assert left[4].text == texts[4] and left[8].text == texts[8]
    assert kept[4] == [2, 4, 5, 8, 9]


def test_only_what_may_go_is_shuffled(spark, table):
    """Ids with a kept row stay with all their rows; null ids go; the rest is not joined."""
    docs = table([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e"), (4, "f")])
    marked = spark.createDataFrame(
        [(1, True), (1, False), (2, False), (3, True), (None, True), (4, None)],
        "doc_id bigint, kept boolean",
    )
    left = corpus_pipeline._only(docs, marked)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, "a"), (1, "b"), (3, "d")]


def test_stages_are_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "exact_dedup", "near_dedup", "substring_dedup", "packing",
    ]


def test_run_over_a_folder(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "conversations", "benchmark"):
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    found = queries.QUERIES[name](spark, SF)
    expected = duck.execute(queries.ORACLE[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(found.columns)
    want = sorted(tuple(str(r[names.index(c)]) for c in sorted(names)) for r in expected.fetchall())
    got = sorted(tuple(str(r[c]) for c in sorted(names)) for r in found.collect())
    assert got == want and got


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_other_queries_run(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0
