import random

import numpy as np
import pytest
from conftest_llm import components, prose, shingles

from yearling.llm import near_dedup
from yearling.llm.components import components as spark_components
from yearling.llm.near_dedup import band_keys, near_groups, signature


def edited(text, every, seed):
    rng = random.Random(seed)
    w = text.split()
    for i in rng.sample(range(len(w)), max(1, len(w) // every)):
        w[i] = f"edit{rng.random()}"
    return " ".join(w)


def brute(texts, size, percent):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    ids = [i for i in texts if sets[i]]
    linked = []
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                linked.append((a, b))
    return sets, components(texts, linked)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_components_equal_brute_force(table, size, percent):
    texts = {}
    for base in range(25):
        text = prose(base, 150)
        for copy in range(8):
            texts[len(texts)] = edited(text, 20 + 10 * copy, base * 100 + copy) if copy else text
    texts |= {500: None, 501: "", 502: "two words", 503: "Two WORDS", 504: "a b c", 505: texts[3]}
    sets, least = brute(texts, size, percent)
    found = near_groups(table(texts).repartition(4), shingle=size, percent=percent).collect()
    assert {r.doc_id: r.component_id for r in found} == least
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_a_large_family_in_many_blocks(table, monkeypatch):
    """More members than a block, of which many are not linked with the first."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    text = prose(99, 120)
    texts = {i: edited(text, 12 + i % 40, i) for i in range(120)}
    _, least = brute(texts, 3, 85)
    found = near_groups(table(texts).repartition(3), shingle=3, percent=85).collect()
    assert {r.doc_id: r.component_id for r in found} == least


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64))
    b = np.concatenate((a[:3000], np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64))))
    equal = np.mean(signature(a) == signature(b))
    assert equal == pytest.approx(3000 / 5000, abs=0.15)


def test_bands_find_what_must_be_found():
    rng, missed = np.random.default_rng(4), 0
    for _ in range(300):
        a = rng.integers(0, 2**63, 200).astype(np.uint64)
        b = a.copy()
        b[:16] = rng.integers(0, 2**63, 16).astype(np.uint64)  # Jaccard 0.852
        missed += not set(band_keys(a)) & set(band_keys(b))
    assert missed == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = spark_components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r.node: r.component for r in found.collect()} == {
        **{i: 0 for i in range(41)},
        **{i: 100 for i in range(100, 160)},
    }


def test_ids_with_several_texts(table):
    """Every text of an id links, whatever the order of the rows."""
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    rows = [(1, a), (1, b), (2, edited(b, 80, 5)), (3, c), (4, a), (4, c), (5, prose(4, 80))]
    expected = {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}
    for order in (rows, rows[::-1]):
        for parts in (1, 3):
            found = near_groups(table(order).repartition(parts), shingle=3, percent=85).collect()
            assert len(found) == len(rows)
            assert {r.doc_id: r.component_id for r in found} == expected
            assert all(r.kept == (r.doc_id == r.component_id) for r in found)
