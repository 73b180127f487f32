"""Each operator on awkward, empty and widened tables."""

import pytest

from yearling.llm.exact_dedup import exact_groups
from yearling.llm.language import languages
from yearling.llm.licences import licence_matches
from yearling.llm.near_dedup import near_groups
from yearling.llm.packing import pack
from yearling.llm.pages import main_text
from yearling.llm.passages import repeated_passages
from yearling.llm.ppm import log_probabilities
from yearling.llm.quality import ledger
from yearling.llm.tokens import encoded, token_digests

#: Operator, and whether it gives a row for every row.
OPERATORS = [
    (licence_matches, False),
    (pack, False),
    (languages, True),
    (repeated_passages, False),
    (exact_groups, True),
    (log_probabilities, True),
    (encoded, True),
    (token_digests, True),
    (ledger, True),
    (near_groups, True),
]


@pytest.mark.parametrize(("operator", "each"), OPERATORS)
def test_awkward_table(awkward, operator, each):
    found = operator(awkward).collect()
    if each:
        ids = [r.doc_id for r in awkward.select("doc_id").collect()]
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in found)


@pytest.mark.parametrize(("operator", "each"), OPERATORS)
def test_other_columns_change_nothing(awkward, rows, operator, each):
    plain = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    drop = {"sequence_id", "offset"}
    wide = operator(awkward)
    columns = [c for c in wide.columns if c not in drop]
    assert rows(wide, *columns) == rows(operator(plain), *columns)


@pytest.mark.parametrize(("operator", "each"), OPERATORS)
def test_empty_table(awkward, operator, each):
    assert operator(awkward.limit(0)).collect() == []


@pytest.mark.parametrize(("operator", "each"), OPERATORS)
def test_only_nulls(table, operator, each):
    found = operator(table([(None, None), (1, None), (1, None)])).collect()
    assert len(found) == 3 or not each


def test_pages_empty_and_null(spark):
    schema = "page_id bigint, url string, html string, host string, paths string"
    pages = spark.createDataFrame(
        [(1, None, None, "a", "b"), (2, "http://h.x/", "", "", ""), (None, "x", "<p>a", "", "")],
        schema,
    )
    found = {r.page_id: (r.text, r.n_chars) for r in main_text(pages).collect()}
    assert found == {1: ("", 0), 2: ("", 0), None: ("a", 1)}
    assert main_text(pages.limit(0)).collect() == []
