import hashlib

import numpy as np
from conftest_llm import lower
from hypothesis import given
from hypothesis import strategies as st

from yearling.llm.exact_dedup import exact_groups, golomb_decode, golomb_encode


@given(st.sets(st.integers(0, 2**42), max_size=300))
def test_codes_round_trip(values):
    values = np.array(sorted(values), np.int64)
    assert golomb_decode(golomb_encode(values), len(values)).tolist() == values.tolist()


def test_codes_are_short():
    values = np.unique(np.random.default_rng(1).integers(0, 2**40, 10_000))
    # 2**40 / 10000 is a gap of 27 bits; Rice codes take about 1.5 more.
    assert len(golomb_encode(values)) * 8 < 29 * len(values)


def test_groups_equal_brute_force(table):
    texts = {i: f"Text {i % 40}" if i % 3 else f"TEXT {i % 7} É" for i in range(400)}
    texts |= {400: None, 401: "", 402: "text 4", 403: "é", 404: "É"}
    groups = {}
    for i, t in texts.items():
        groups.setdefault(lower(t), []).append(i)
    df = table(texts).repartition(5)
    for r in exact_groups(df).collect():
        own = groups[lower(texts[r.doc_id])]
        assert (r.keep_id, r.group_size, r.kept) == (max(own), len(own), r.doc_id == max(own))
        assert r.text_sha256 == hashlib.sha256(lower(texts[r.doc_id]).encode()).hexdigest()


def test_a_group_with_a_third_of_all_rows(table):
    texts = {i: "Same" if i % 3 == 0 else f"own {i}" for i in range(3000)}
    found = exact_groups(table(texts).repartition(8)).where("group_size > 1")
    assert found.count() == 1000
    assert found.where("kept").select("doc_id").collect()[0][0] == 2997
