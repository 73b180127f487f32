"""Near duplicates by circulant MinHash, banding and exact Jaccard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearling.llm.components import components
from yearling.llm.text import id_and_bytes, mix, per_row, shingle_hashes, word_hashes, words
from yearling.sources.staging import discard, staged

#: Rows of a band and bands. Two sets of Jaccard 0.85 share no band with a chance of
#: (1 - 0.85^5)^30, or 2 in 10^8.
ROWS, BANDS = 5, 30

#: Members of a bucket that are compared at a time.
BLOCK = 64

_SIGMA = np.uint64(0x9E3779B97F4A7C15)
_SHIFTS = np.arange(ROWS * BANDS, dtype=np.uint64)


def shingle_set(raw: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct shingles of a text, as 64-bit hashes."""
    return np.unique(shingle_hashes(word_hashes(words(raw)), size))


def signature(shingles: np.ndarray, chunk: int = 1024) -> np.ndarray:
    """MinHash coordinates from two permutations of the 64-bit integers.

    The first, sigma, breaks any structure of the set. The second, pi, is used for all
    coordinates: number k is the least pi(sigma(x) + k), pi shifted circularly by k.
    """
    placed = mix(shingles ^ _SIGMA)
    least = np.full(len(_SHIFTS), np.iinfo(np.uint64).max)
    for a in range(0, len(placed), chunk):
        least = np.minimum(least, mix(placed[a : a + chunk] + _SHIFTS[:, None]).min(axis=1))
    return least


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band; the band's number is part of the key."""
    rows = signature(shingles).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * _SIGMA + rows[:, k])
    return key.view(np.int64)


class Sketch:
    def __init__(self, size: int):
        self.size = size

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, raw in rows:
            found = shingle_set(raw, self.size)
            if len(found):
                key = xxhash.xxh3_128_digest(found.tobytes())
                yield doc_id, len(found), key, band_keys(found).tolist()
            else:
                yield doc_id, 0, None, None


class Sets:
    def __init__(self, size: int):
        self.size = size

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, raw in rows:
            found = shingle_set(raw, self.size).tobytes()
            yield doc_id, xxhash.xxh3_128_digest(found), found


def _numbers(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint64)


class LinkPairs:
    """Pairs of sets that are similar enough, counted on the full sets."""

    def __init__(self, percent: int):
        self.percent = percent

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for a, b, one, two in rows:
            x, y = _numbers(one), _numbers(two)
            if min(len(x), len(y)) * 100 < self.percent * max(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= self.percent * (len(x) + len(y) - both):
                yield a, b


class LinkBlocks:
    """Links between two blocks of one bucket, one for each pair of components.

    Sets become rows of 0 and 1 over the shingles both blocks have; their product
    counts every intersection exactly.
    """

    def __init__(self, percent: int):
        self.percent = percent

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for left, right in rows:
            yield from self.links(left, right)

    def links(self, left: list[dict], right: list[dict]) -> Iterator[tuple]:
        comps = [np.array([m["comp"] for m in side]) for side in (left, right)]
        sets = [[_numbers(m["shingles"]) for m in side] for side in (left, right)]
        sizes = [np.array([len(s) for s in side]) for side in sets]
        small = np.minimum.outer(*sizes) * 100 >= self.percent * np.maximum.outer(*sizes)
        wanted = small & (comps[0][:, None] != comps[1][None, :])
        if not wanted.any():
            return
        flat = [np.concatenate(side) for side in sets]
        shared = np.intersect1d(*flat)
        both = np.zeros(wanted.shape, np.int64)
        # Shingles by the thousand, so that long sets stay small matrices.
        at = [np.searchsorted(shared, f) for f in flat]
        hit = [
            (p < len(shared)) & (shared[np.minimum(p, len(shared) - 1)] == f)
            if len(shared)
            else np.zeros(len(f), bool)
            for p, f in zip(at, flat, strict=True)
        ]
        owner = [np.repeat(np.arange(len(s)), s) for s in sizes]
        at = [p[h] for p, h in zip(at, hit, strict=True)]
        owner = [o[h] for o, h in zip(owner, hit, strict=True)]
        for low in range(0, len(shared), 4096):
            ones = []
            for p, o, s in zip(at, owner, sizes, strict=True):
                inside = (p >= low) & (p < low + 4096)
                grid = np.zeros((len(s), min(4096, len(shared) - low)), np.float32)
                grid[o[inside], p[inside] - low] = 1
                ones.append(grid)
            both += np.rint(ones[0] @ ones[1].T).astype(np.int64)
        union = np.add.outer(*sizes) - both
        told = set()
        for i, j in zip(*np.nonzero(wanted & (100 * both >= self.percent * union)), strict=True):
            pair = (int(comps[0][i]), int(comps[1][j]))
            if pair not in told:
                told.add(pair)
                yield pair


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Every row of `docs` with its near-duplicate component: `doc_id`, `n_shingles`,
    `component_id`, `kept`.

    A text's set holds its distinct shingles of `shingle` words, lower-cased A-Z; a text
    with fewer words is one shingle, one without words (or null) has an empty set and is
    linked with nothing. Two rows are linked when 100 * intersection >= percent * union,
    counted on the full sets. The component is the smallest id reachable and that row is
    kept; of repeated rows with that id, all are. Rows that repeat an id with different
    texts are one document with the links of all of them, in whatever order they come.
    Rows with a null id stay unlinked unless another row has the same set. Other columns
    are not read.

    1. Rows with equal sets collapse to one class before anything else.
    2. Classes that share a band form a bucket. Each class is compared with the first of
       each of its buckets, which joins most of a large group at little cost.
    3. Buckets whose classes are still in different components are compared in full, in
       pairs of small blocks. No pair is written out; only the links found are.
    """
    source = id_and_bytes(docs, id_col, text_col)
    rows = staged(
        per_row(
            source, "doc_id bigint, n int, set_key binary, bands array<bigint>", Sketch(shingle)
        ),
        "sketches",
    )
    classes = staged(
        rows.where("set_key is not null and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")),
        "classes",
    )
    keyed = classes.select("id", F.explode("bands").alias("bucket"))
    buckets = keyed.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("n"))
    members = staged(keyed.join(buckets.where("n > 1"), "bucket"), "members")

    wanted = members.select("id").distinct()
    sets = staged(
        per_row(
            source.join(wanted.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"),
            "id bigint, set_key binary, shingles binary",
            Sets(shingle),
        )
        .dropDuplicates(["id", "set_key"])
        .select("id", "shingles"),
        "sets",
    )

    stars = members.where("id <> hub").select("hub", "id").distinct()
    pairs = stars.join(sets, "id").join(
        sets.select(F.col("id").alias("hub"), F.col("shingles").alias("hub_shingles")), "hub"
    )
    links = per_row(
        pairs.select("hub", "id", "hub_shingles", "shingles"),
        "a bigint, b bigint",
        LinkPairs(percent),
        step=64,
    )
    links = links.unionByName(_texts_of_one_id(rows, classes))
    found = staged(components(links), "components")

    final = _join_rest(members, sets, found, percent)
    by_class = classes.join(final.withColumnRenamed("node", "id"), "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component")
    )
    component = F.coalesce("component", "doc_id")
    return rows.join(by_class, "set_key", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _texts_of_one_id(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of the different texts of an id."""
    sets = rows.where("set_key is not null and doc_id is not null").select("doc_id", "set_key")
    again = sets.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high"))
    again = staged(again.where("low < high").select("doc_id"), "again")
    placed = (
        sets.join(again, "doc_id", "left_semi")
        .distinct()
        .join(classes.select("set_key", "id"), "set_key")
    )
    least = placed.groupBy("doc_id").agg(F.min("id").alias("a"))
    return placed.join(least, "doc_id").select("a", F.col("id").alias("b")).where("a <> b")


def _join_rest(
    members: DataFrame, sets: DataFrame, found: DataFrame, percent: int
) -> DataFrame:
    """Components after comparing the classes that the first round left apart."""
    placed = members.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "bucket", "id", "n", F.coalesce("component", "id").alias("comp")
    )
    # In a bucket of two, the only pair has been compared. Buckets with the same members,
    # which one family leaves in many bands, are compared once.
    mixed = (
        placed.where("n > 2")
        .groupBy("bucket", "n")
        .agg(
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
            F.bit_xor(F.xxhash64("id")).alias("one"),
            F.sum(F.col("id").cast("decimal(38,0)")).alias("two"),
        )
        .where("low < high")
        .groupBy("n", "low", "high", "one", "two")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket")
    )
    open_members = staged(placed.join(mixed, "bucket", "left_semi"), "open")
    blocks = staged(
        open_members.join(sets, "id")
        .withColumn("block", F.expr(f"pmod(xxhash64(id), ceil(n / {BLOCK}))"))
        .groupBy("bucket", "block")
        .agg(F.collect_list(F.struct("comp", "shingles")).alias("members")),
        "blocks",
    )
    other = blocks.select(
        "bucket", F.col("block").alias("other"), F.col("members").alias("others")
    )
    pairs = blocks.join(other, "bucket").where("block <= other").select("members", "others")
    more = staged(
        per_row(pairs, "a bigint, b bigint", LinkBlocks(percent), step=4).distinct(), "more_links"
    )
    merged = staged(components(more), "merged")
    discard(more, blocks, open_members, members, sets)
    merged = merged.select(
        F.col("node").alias("component"), F.col("component").alias("to")
    )
    return found.unionByName(
        merged.select(F.col("component").alias("node"), "component")
    ).distinct().join(merged, "component", "left").select(
        "node", F.coalesce("to", "component").alias("component")
    )
