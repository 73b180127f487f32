"""The prefix trie against a plain count of all prefixes."""

import hashlib
import random
import zlib
from itertools import pairwise

import pytest

from yearling.llm import conversations
from yearling.llm.conversations import (
    TURN,
    Forest,
    common_turns,
    digests_of_ends,
    prefix_trie,
    sequences,
    with_shared_starts,
)

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def turns_of(rows):
    """{conv_id: [(role, text), ...]} of raw rows."""
    out = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            out.setdefault(conv_id, []).append((turn, role or "", text or ""))

    def place(t):
        named = f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()
        return (t[0] is not None, t[0] or 0, hashlib.sha256(named).digest())

    return {c: [t[1:] for t in sorted(ts, key=place)] for c, ts in out.items()}


def shared(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(f"{'-' if c < 0 else ''}{abs(c) % 100}")
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for prefix, ids in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        kids = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(q[:-1] == p for q in below if q)]
        ends = sorted(c for c in ids if len(convs[c]) == len(prefix))
        out.append(
            (
                min(ids),
                len(prefix),
                min(members[prefix[:-1]]) if prefix else None,
                len(ids),
                len(kids),
                len(leaves),
                sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def told(trie):
    digest = {bytes(r.node): r.ids_sha256 for r in digests_of_ends(trie.ends).collect()}
    none = hashlib.sha256(b"").hexdigest()
    return sorted(
        (
            (
                r["first"], r.depth, r.parent_first, r.n_convs, r.n_children, r.n_leaves, r.saved,
                digest.get(bytes(r.node), none),
            )
            for r in trie.nodes.collect()
        ),
        key=str,
    )


def some_rows(seed, n, turns=5, kinds=2):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(0, turns)):
            rows.append((c, t, "user", f"{'w' * rng.randint(0, kinds)}{rng.randint(1, kinds)}"))
    return rows


@pytest.mark.parametrize(("seed", "kinds", "partitions"), [(1, 1, 4), (2, 2, 7), (3, 3, 23)])
def test_equals_all_prefixes(spark, seed, kinds, partitions):
    rows = some_rows(seed, 150, kinds=kinds)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        trie = prefix_trie(sequences(spark.createDataFrame(rows, SCHEMA)))
        assert told(trie) == brute(turns_of(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_shared_starts(spark):
    rows = [(c, t, "r", f"{c}-{t}") for c in range(95, 330, 3) for t in range(c % 9)]
    rows += [(200, t, "r", f"200-{t}") for t in range(4)] + [(-105, 0, "r", "x"), (-100, 0, "r", "y")]
    convs = with_shared_starts(sequences(spark.createDataFrame(rows, SCHEMA)))
    expected = shared(turns_of(rows))
    assert {r.conv_id: len(r.turns) for r in convs.collect()} == {
        c: len(t) for c, t in expected.items()
    }
    assert told(prefix_trie(convs)) == brute(expected)


def test_nulls_ties_long_and_clashing(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, "b"), (1, 1, "user", None),
        (2, None, "user", "first"), (2, 0, "", "b"), (2, 1, "user", ""), (2, 1, "user", "z"),
        (3, 5, "a", "b"), (3, 5, "a", "a"), (3, 5, "ab", ""), (3, 5, "a", "b"),
        (None, 0, "user", "first"), (None, None, None, None),
        (4, 0, "user", "\U0001f600é" * 1_000_00), (5, 0, "user", "\U0001f600é" * 1_000_00),
        (-7, 0, "user", "first"), (6, None, "user", "first"),
    ]
    rows += [(8, t, "user", "again") for t in range(3000)]
    rows += [(9, t, "user", "again") for t in range(2990)]
    df = spark.createDataFrame(rows, SCHEMA)
    wide = df.selectExpr("*", "'x' as seq", "'y' as unit", "1 as part", "2 as n", "3 as h")
    found = told(prefix_trie(sequences(wide)))
    small = [r for r in rows if r[0] not in (8, 9)]
    assert found == told(prefix_trie(sequences(df)))
    assert told(prefix_trie(sequences(spark.createDataFrame(small, SCHEMA)))) == brute(
        turns_of(small)
    )
    deep = [r for r in found if r[1] == 2990]
    assert deep[0][0] == 8 and deep[0][3:7] == (2, 1, 1, 5 + 50 - 5 - 50 + 5)


def test_empty_and_turnless(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert told(prefix_trie(sequences(df))) == []
    turnless = spark.createDataFrame([(3, []), (1, []), (11, [])], "conv_id bigint, turns array<binary>")
    ends = hashlib.sha256(b"1,3,11").hexdigest()
    assert told(prefix_trie(turnless)) == [(1, 0, None, 3, 0, 1, 0, ends)]


def test_many_ends_of_one_node_come_in_runs(spark, monkeypatch):
    monkeypatch.setattr(conversations._runs, "__defaults__", (3,))
    ends = spark.range(50).selectExpr("cast(cast(id % 2 as string) as binary) as node", "id * 7 as conv_id")
    found = {int(bytes(r.node)): r.ids_sha256 for r in digests_of_ends(ends).collect()}
    for k in (0, 1):
        ids = ",".join(str(i * 7) for i in range(50) if i % 2 == k)
        assert found[k] == hashlib.sha256(ids.encode()).hexdigest()


def test_every_merge_makes_a_branching_node():
    rng = random.Random(5)
    unit = [bytes([k]) * TURN for k in range(3)]
    seqs = sorted({b"".join(rng.choices(unit, k=rng.randint(0, 6))) for _ in range(60)})
    forest = Forest([(s, 1, i) for i, s in enumerate(seqs)])
    branching = {
        (a[: common_turns(a, b) * TURN]) for a, b in pairwise(seqs)
    } | {b""}
    nodes = {forest.seqs[forest.low[x]][: forest.depth[x] * TURN] for x, _ in forest.parents()}
    assert nodes == branching | set(seqs)
