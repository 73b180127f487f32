"""Prefix trie of conversations: union-find over the LCP edges of sorted neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from yearling.llm.text import batch_of, per_row
from yearling.sources.staging import staged

#: Bytes of a turn in a sequence: 16 of the SHA-256 of role and text, 4 of its length.
TURN = 20

#: Turns of a sorted part, whose forest one task builds.
PART_TURNS = 1 << 17

NODES = pa.schema(
    [
        ("node", pa.binary()),
        ("parent", pa.binary()),
        ("depth", pa.int64()),
        ("first", pa.int64()),
        ("parent_first", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved", pa.int64()),
        ("n_ends", pa.int64()),
        ("end_first", pa.int64()),
        ("open", pa.bool_()),
    ]
)


def sequences(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """A row per conversation: `conv_id` and `turns`, its turns in order as `TURN` bytes each.

    Turns go by `turn_col`, null first, and equal ones by the SHA-256 of role and text, null
    of either counting as empty. Rows without a conversation id belong to none. A
    conversation is held as 28 bytes a turn, never as texts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(named, 256)), 1, TURN - 4)
    length = F.unhex(F.lpad(F.hex(F.char_length(text)), 8, "0"))
    units = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("at"), F.concat(digest, length).alias("unit")).alias("turn"),
    )
    ordered = units.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return ordered.select("conv_id", F.col("turns.unit").alias("turns"))


def with_shared_starts(convs: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Conversation c starts with the first h turns of conversation c - c % `block` and goes
    on with its own after its first h; h is the unsigned CRC-32 of c's decimal text, modulo
    `most`. Of a conversation that is absent, no turns are taken.
    """
    heads = convs.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, most - 1).alias("head")
    )
    at = F.col("conv_id") - F.col("conv_id") % block
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    placed = convs.withColumns({"head_id": at, "h": h}).join(heads, "head_id", "left")
    none = F.array().cast("array<binary>")
    start = F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return placed.select(
        "conv_id", F.concat(F.coalesce(start, none), rest).alias("turns")
    )


@dataclass
class Trie:
    """`nodes`: `node` (16 bytes of the SHA-256 of its turns), `parent`, `depth`, `first`
    (its smallest member), `parent_first`, `n_convs`, `n_children`, `n_leaves`, `saved`
    (over its subtree, members less one times the length of a node's last text), `n_ends`
    and `end_first` (the number and smallest id of the conversations that end there).
    `ends`: the `conv_id` of each conversation beside the `node` where it ends.
    """

    nodes: DataFrame
    ends: DataFrame


def prefix_trie(convs: DataFrame) -> Trie:
    """The trie of all prefixes of conversations given as `conv_id` and `turns`.

    Every distinct sequence of the first d turns of some conversation is a node, with the
    textless root at d = 0; a conversation without turns is a member of the root alone. No
    conversations, no nodes. Rows of one `conv_id` count as conversations of their own.

    1. Equal sequences become one row with their number and smallest id.
    2. Sequences are sorted over all tasks. Each part builds the forest of its own: the
       common prefix (LCP) of two neighbours is an edge between them, and edges are taken
       in descending depth. A merge of two components makes a branching node.
    3. What a part shares with its neighbours is a prefix of its first or last sequence no
       longer than the LCP across the boundary. Those nodes leave the part as sums, which
       are added up by node; all others are whole.
    """
    hexed = F.transform("turns", lambda u: F.hex(u))
    rows = staged(
        convs.select("conv_id", F.unhex(F.array_join(hexed, "")).alias("seq")), "conversations"
    )
    classes = rows.groupBy("seq").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first")
    )
    turns = rows.agg(F.sum(F.octet_length("seq"))).first()[0] or 0
    spark = convs.sparkSession
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // (TURN * PART_TURNS))
    )
    ordered = staged(
        classes.repartitionByRange(parts, "seq").withColumn("part", F.spark_partition_id()),
        "sorted",
    )
    by_part = Window.orderBy("part")
    bounds = ordered.groupBy("part").agg(F.min("seq").alias("a"), F.max("seq").alias("b"))
    bounds = bounds.select(
        "part", "a", "b", F.lag("b").over(by_part).alias("p"), F.lead("a").over(by_part).alias("q")
    )
    shared = staged(per_row(bounds, "part int, low bigint, high bigint", shared_ends), "bounds")
    found = staged(
        ordered.join(shared, "part").groupBy("part").applyInArrow(part_forest, from_arrow_schema(NODES)),
        "forests",
    )
    ends = rows.select("conv_id", _node_of("seq").alias("node"))
    return Trie(_merged(found), ends)


def _node_of(column: str):
    return F.substring(F.unhex(F.sha2(F.col(column), 256)), 1, 16)


def _merged(found: DataFrame) -> DataFrame:
    """Nodes of several parts added up, and the smallest member of each node's parent."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved", "n_ends")]
    opened = staged(
        found.where("open")
        .groupBy("node", "parent", "depth")
        .agg(F.min("first").alias("first"), F.min("end_first").alias("end_first"), *sums),
        "open",
    )
    above = opened.select(F.col("node").alias("parent"), F.col("first").alias("above"))
    whole = found.where(~F.col("open"))
    columns = [c for c in found.columns if c != "open"]
    within = whole.where("parent_first is not null or parent is null").select(columns)
    below = whole.where("parent_first is null and parent is not null").select(
        [c for c in columns if c != "parent_first"]
    )
    below = below.unionByName(opened).join(above, "parent", "left")
    return within.unionByName(below.withColumnRenamed("above", "parent_first").select(columns))


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences start with in common."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // TURN
    x, y = (np.frombuffer(s, np.uint8, size) for s in (a, b))
    return int((x != y).argmax()) // TURN


def shared_ends(rows: Iterator[tuple]) -> Iterator[tuple]:
    """What a part's first and last sequences share with the neighbours; -1 without one."""
    for part, a, b, before, after in rows:
        yield (
            part,
            -1 if before is None else common_turns(before, a),
            -1 if after is None else common_turns(b, after),
        )


class Forest:
    """The compact trie of sorted distinct sequences, given with number and smallest id."""

    def __init__(self, rows: list[tuple[bytes, int, int]]):
        self.seqs = [r[0] for r in rows]
        count = range(len(rows))
        # Of each node: depth, first and last row, members, smallest id, children, and the
        # row that ends there (-1 if none).
        self.depth = [len(s) // TURN for s in self.seqs]
        self.low, self.high = list(count), list(count)
        self.members = [r[1] for r in rows]
        self.first = [r[2] for r in rows]
        self.kids: list[list[int]] = [[] for _ in rows]
        self.end = list(count)
        self.root = self.merged()

    def merged(self) -> int:
        edges = [common_turns(a, b) for a, b in zip(self.seqs, self.seqs[1:], strict=False)]
        up = list(range(len(self.seqs)))
        top = list(up)

        def find(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for e in np.argsort(-np.array(edges, np.int64), kind="stable").tolist():
            a, b = find(e), find(e + 1)
            up[b] = a
            top[a] = self.joined(top[a], top[b], edges[e])
        node = top[find(0)]
        return node if self.depth[node] == 0 else self.branch(0, [node])

    def joined(self, a: int, b: int, depth: int) -> int:
        """The node at `depth` above two neighbouring tops."""
        into = [x for x in (a, b) if self.depth[x] == depth]
        if not into:
            return self.branch(depth, [a, b])
        if len(into) == 2:
            keep, gone = (a, b) if len(self.kids[a]) >= len(self.kids[b]) else (b, a)
            self.kids[keep] += self.kids[gone]
            self.end[keep] = max(self.end[keep], self.end[gone])
        else:
            keep, gone = (a, b) if into == [a] else (b, a)
            self.kids[keep].append(gone)
        self.members[keep] += self.members[gone]
        self.first[keep] = min(self.first[keep], self.first[gone])
        self.low[keep] = min(self.low[keep], self.low[gone])
        self.high[keep] = max(self.high[keep], self.high[gone])
        return keep

    def branch(self, depth: int, kids: list[int]) -> int:
        self.depth.append(depth)
        self.low.append(min(self.low[k] for k in kids))
        self.high.append(max(self.high[k] for k in kids))
        self.members.append(sum(self.members[k] for k in kids))
        self.first.append(min(self.first[k] for k in kids))
        self.kids.append(list(kids))
        self.end.append(-1)
        return len(self.depth) - 1

    def parents(self) -> list[tuple[int, int]]:
        """Every node after its parent, beside it; the root beside -1."""
        order, at = [(self.root, -1)], 0
        while at < len(order):
            node = order[at][0]
            order += [(k, node) for k in self.kids[node]]
            at += 1
        return order


def forest_nodes(
    rows: list[tuple[bytes, int, int]], left: int, right: int
) -> Iterator[tuple]:
    """All nodes of a part's sequences, those of single children included.

    The prefixes of the first row of at most `left` turns, and of the last of at most
    `right`, are open: other parts have them too. Sums over them are told so that they add
    up; what occurs once, a node's own subtrahend or place among its parent's children, is
    told by the first part that has it.
    """
    forest = Forest(rows)
    last = len(rows) - 1
    order = forest.parents()
    saved, leaves = [0] * len(forest.depth), [0] * len(forest.depth)
    chains: dict[int, list[int]] = {}
    for node, parent in reversed(order):
        above = forest.depth[parent] if parent >= 0 else -1
        depth, members = forest.depth[node], forest.members[node]
        seq = forest.seqs[forest.low[node]]
        kids = forest.kids[node]
        if kids:
            leaves[node] = sum(leaves[k] for k in kids)
        else:
            leaves[node] = int(not _open(forest, node, depth, left, right, last))
        total = sum(saved[k] for k in kids)
        chain = []
        for d in range(depth, above, -1):
            length = int.from_bytes(seq[d * TURN - 4 : d * TURN], "big") if d else 0
            met = forest.low[node] == 0 and d <= left
            total += (members - (not met)) * length
            chain.append(total)
        saved[node] = total
        chains[node] = chain
    states = {-1: hashlib.sha256()}
    for node, parent in order:
        above = forest.depth[parent] if parent >= 0 else -1
        depth = forest.depth[node]
        seq, chain = forest.seqs[forest.low[node]], chains.pop(node)
        state = states[parent].copy()
        over = states[parent].digest()[:16] if parent >= 0 else None
        over_open = parent >= 0 and _open(forest, parent, above, left, right, last)
        over_first = forest.first[parent] if parent >= 0 else None
        for d in range(above + 1, depth + 1):
            if d:
                state.update(seq[(d - 1) * TURN : d * TURN])
            own = state.digest()[:16]
            now_open = _open(forest, node, d, left, right, last)
            below = len(forest.kids[node]) if d == depth else 1
            # The next node of the first row is another part's to count.
            below -= forest.low[node] == 0 and d < left
            end = forest.end[node] if d == depth else -1
            yield (
                own,
                over,
                d,
                forest.first[node],
                None if over_open or over is None else over_first,
                forest.members[node],
                below,
                leaves[node],
                chain[depth - d],
                rows[end][1] if end >= 0 else 0,
                rows[end][2] if end >= 0 else None,
                now_open,
            )
            over, over_open, over_first = own, now_open, forest.first[node]
        states[node] = state


def _open(forest: Forest, node: int, depth: int, left: int, right: int, last: int) -> bool:
    return (forest.low[node] == 0 and depth <= left) or (
        forest.high[node] == last and depth <= right
    )


def part_forest(table: pa.Table) -> pa.Table:
    rows = sorted(
        zip(*(table[c].to_pylist() for c in ("seq", "n", "first")), strict=True)
    )
    left, right = table["low"][0].as_py(), table["high"][0].as_py()
    nodes = forest_nodes(rows, left, right)
    batches = []
    while some := list(islice(nodes, 1 << 14)):
        batches.append(batch_of(some, NODES))
    return pa.Table.from_batches(batches, NODES)


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """`node` and `ids_sha256`: the SHA-256 of the decimal ids of the conversations that end
    there, ascending, with commas between them.

    Ids are sorted over all tasks and written as runs; a node's runs then pass one task in
    order, which holds one of them at a time.
    """
    ordered = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    runs = staged(
        per_row(ordered.select("node", "conv_id"), "node binary, start bigint, ids string", _runs),
        "runs",
    )
    placed = runs.repartition("node").sortWithinPartitions("node", "start")
    return per_row(placed.select("node", "ids"), "node binary, ids_sha256 string", _hashed, step=8)


def _runs(rows: Iterator[tuple], most: int = 1 << 16) -> Iterator[tuple]:
    node, ids = None, []
    for key, conv_id in rows:
        if ids and (key != node or len(ids) == most):
            yield node, ids[0], ",".join(map(str, ids))
            ids = []
        node = key
        ids.append(conv_id)
    if ids:
        yield node, ids[0], ",".join(map(str, ids))


def _hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
    node, state = None, None
    for key, ids in rows:
        if state is not None and key == node:
            state.update(b",")
        else:
            if state is not None:
                yield node, state.hexdigest()
            node, state = key, hashlib.sha256()
        state.update(ids.encode())
    if state is not None:
        yield node, state.hexdigest()
