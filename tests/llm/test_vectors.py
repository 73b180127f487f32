"""Linked vectors against all pairs of cosines."""

import math
import random

import numpy as np
import pytest
from conftest_llm import components

from yearling.llm import vectors
from yearling.llm.vectors import connected, linked_vectors, unit_of

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, least=0.93):
    units = [None if r[2] is None else unit_of(r[1]) for r in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if float(a @ b) >= least:
                links.append((i, j))
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    place = {i: p for p, i in enumerate(order)}
    comps = components(range(len(rows)), [(place[i], place[j]) for i, j in links])
    out = []
    for i, row in enumerate(rows):
        c = rows[order[comps[place[i]]]][0]
        n = sum(i in pair for pair in links)
        out.append((row[0], n, c, row[0] == c))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def clustered(seed, n, dims=8, labels=2, spread=0.25, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    middle /= np.linalg.norm(middle, axis=1)[:, None]
    rows = []
    for i in range(n):
        v = middle[rng.integers(centres)] * rng.uniform(0.5, 3) + rng.normal(size=dims) * spread * (
            rng.random() ** 2
        )
        rows.append((i, [float(x) for x in v], int(rng.integers(labels))))
    return rows


@pytest.fixture
def told_rows(spark):
    return lambda rows: told(linked_vectors(spark.createDataFrame(rows, SCHEMA)))


def test_one_cell_a_label(told_rows):
    rows = clustered(1, 300)
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(40)]
    rows += [(2000, rows[0][1], 1 - rows[0][2])]
    assert told_rows(rows) == brute(rows)


@pytest.mark.parametrize(("cell", "block", "chunk"), [(20, 1024, 16384), (40, 7, 30), (300, 50, 64)])
def test_pivots_and_blocks_change_nothing(monkeypatch, told_rows, cell, block, chunk):
    for name, value in (("CELL", cell), ("BLOCK", block), ("CHUNK", chunk)):
        monkeypatch.setattr(vectors, name, value)
    rows = clustered(2, 500, labels=1)
    # A tight group that is a third of all, and vectors at a core's edge.
    tight = np.array(rows[0][1])
    rng = np.random.default_rng(9)
    rows += [(5000 + i, (tight + rng.normal(size=8) * 0.02).tolist(), 0) for i in range(250)]
    rows += [(7000 + i, (tight + rng.normal(size=8) * 0.15).tolist(), 0) for i in range(60)]
    rows += [(8000 + i, rng.normal(size=8).tolist(), 0) for i in range(60)]
    assert told_rows(rows) == brute(rows)


def test_odd_vectors(told_rows):
    nan, inf = math.nan, math.inf
    rows = [
        (1, [1.0, 0.0], 0), (2, [1e300, 1e299], 0), (3, [1e-300, 1e-301], 0), (4, [0.0, 0.0], 0),
        (5, [1.0, None], 0), (6, [1.0, nan], 0), (7, [inf, 0.0], 0), (8, None, 0), (9, [], 0),
        (10, [1.0, 0.0], None), (11, [1.0, 0.0], 1), (12, [1.0, 0.0, 0.0], 0), (13, [-1.0, 0.0], 0),
        (14, [1.0, -0.0], 0), (14, [1.0, 0.0], 0), (14, [0.0, 1.0], 0), (None, [0.0, 2.0], 0),
        (None, [1.0, 1.0], 2), (None, [1.0, 1.0], 2), (None, None, None), (-3, [0.0, 5.0], 0),
    ]
    assert told_rows(rows) == brute(rows)


def test_chains_join_and_ends_do_not_link(told_rows):
    step = math.acos(0.94)
    rows = [(50 - i, [math.cos(i * step), math.sin(i * step)], 3) for i in range(15)]
    found = told_rows(rows)
    assert {r[2] for r in found} == {36}
    assert sorted(r[1] for r in found) == [1, 1] + [2] * 13
    assert found == brute(rows)


def test_empty_tables_other_columns_and_floats(spark, told_rows):
    assert told_rows([(1, None, None)]) == [(1, 0, 1, True)]
    rows = clustered(4, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    assert told(linked_vectors(df.limit(0))) == []
    wide = df.selectExpr(
        "*", "1 as n", "'a' as key", "'b' as unit", "'c' as space", "2 as cell", "3 as kind"
    )
    assert told(linked_vectors(wide)) == told(linked_vectors(df))
    floats = df.selectExpr("vec_id", "cast(embedding as array<float>) as embedding", "label")
    exact = [(r.vec_id, list(r.embedding), r.label) for r in floats.collect()]
    assert told(linked_vectors(floats)) == brute(exact)


def test_connected():
    rng = random.Random(1)
    edges = [(rng.randrange(50), rng.randrange(50)) for _ in range(30)]
    i, j = (np.array(x) for x in zip(*edges, strict=True))
    assert dict(enumerate(connected(50, i, j).tolist())) == components(range(50), edges)
