"""Near-equal vectors by an exact metric range join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearling.llm.components import components
from yearling.llm.text import per_row
from yearling.sources.staging import staged

#: Distinct vectors of a space that one cell is meant to hold.
CELL = 4096

#: Vectors of a block; two blocks are compared at a time.
BLOCK = 1024

#: Vectors that are measured against the pivots of their space at a time.
CHUNK = 16384

#: What rounding may add to a distance. Bounds are widened by it; links are told by cosine.
SLACK = 1e-9

CLASS = "space string, key binary, unit binary, n bigint"
PLACED = f"{CLASS}, cell int, distance double, kind int"

#: Kinds of places in a cell: natives so near the pivot that all link with each other, other
#: natives, and vectors of other cells; the last two near enough to link with the first or not.
CORE, NATIVE_NEAR, NATIVE_FAR, GUEST_NEAR, GUEST_FAR = range(5)


class Units:
    """Unit vectors as bytes of doubles; none for vectors that link with nothing."""

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for vec_id, label, vector in rows:
            unit = None if label is None else unit_of(vector)
            if unit is None:
                yield vec_id, None, None, None
            else:
                space = f"{len(unit)}:{label}"
                raw = unit.tobytes()
                key = xxhash.xxh3_128_digest(space.encode() + b"\0" + raw)
                yield vec_id, space, key, raw


def unit_of(vector: list | None) -> np.ndarray | None:
    if not vector or any(x is None for x in vector):
        return None
    v = np.array(vector, np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    # The largest component first, so that no square overflows or vanishes.
    v = v / np.abs(v).max()
    return v / math.sqrt(float(v @ v)) + 0.0


def matrix(units: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class Pivots:
    """Of a space's candidates those that keep their distance from all taken before."""

    def __init__(self, apart: float):
        self.apart = apart

    def __call__(self, table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["key"].to_pylist(), table["unit"].to_pylist(), strict=True))
        units = matrix([u for _, u in rows])
        open_, taken = np.ones(len(rows), bool), []
        for i in range(len(rows)):
            if open_[i]:
                taken.append(i)
                open_ &= distances(units, units[i : i + 1])[:, 0] > self.apart
        return pa.table(
            {
                "space": pa.array([table["space"][0].as_py()] * len(taken), pa.string()),
                "cell": pa.array(range(len(taken)), pa.int32()),
                "pivot": pa.array([rows[i][1] for i in taken], pa.binary()),
            }
        )


class Assign:
    """Every vector of a chunk with its nearest pivot's cell."""

    def __init__(self, radius: float):
        self.radius = radius

    def __call__(self, chunk: pa.Table, pivots: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return placed([], [])
        rows = list(zip(*(chunk[c].to_pylist() for c in COLUMNS), strict=True))
        pivots = pivots.sort_by("cell")
        far = distances(matrix([r[2] for r in rows]), matrix(pivots["pivot"].to_pylist()))
        cells = far.argmin(axis=1)
        places = []
        for i, cell in enumerate(cells.tolist()):
            d = float(far[i, cell])
            near = d <= 1.5 * self.radius + SLACK
            core = d <= 0.5 * self.radius - SLACK
            places.append((cell, d, CORE if core else NATIVE_NEAR if near else NATIVE_FAR))
        return placed(rows, places)


class Replicate:
    """Copies of a chunk's vectors for the cells of lower number that may hold a link.

    With cells i of x and j of y, y is nearer to pivot j, so x is within the radius of the
    plane between the pivots; and x is at most the radius farther from pivot j than the
    farthest vector there. The core of a cell counts for itself.
    """

    def __init__(self, radius: float):
        self.radius = radius

    def __call__(self, chunk: pa.Table, pivots: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return placed([], [])
        names = [*COLUMNS, "cell"]
        rows = list(zip(*(chunk[c].to_pylist() for c in names), strict=True))
        pivots = pivots.sort_by("cell")
        centres = matrix(pivots["pivot"].to_pylist())
        reach = np.array(pivots["reach"].to_pylist(), np.float64)
        far = distances(matrix([r[2] for r in rows]), centres)
        between = distances(centres, centres)
        out, places = [], []
        for row, d in zip(rows, far, strict=True):
            i = row[4]
            if not i:
                continue
            plane = (d[:i] ** 2 - d[i] ** 2) / (2 * between[i, :i])
            near = d[:i] <= 1.5 * self.radius + SLACK
            may = (plane <= self.radius + SLACK) & (
                near | (d[:i] <= reach[:i] + self.radius + SLACK)
            )
            for j in np.flatnonzero(may).tolist():
                out.append(row[:4])
                places.append((j, float(d[j]), GUEST_NEAR if near[j] else GUEST_FAR))
        return placed(out, places)


COLUMNS = ["space", "key", "unit", "n"]
_PLACED = pa.schema(
    [
        ("space", pa.string()),
        ("key", pa.binary()),
        ("unit", pa.binary()),
        ("n", pa.int64()),
        ("cell", pa.int32()),
        ("distance", pa.float64()),
        ("kind", pa.int32()),
    ]
)


def placed(rows: list[tuple], places: list[tuple]) -> pa.Table:
    columns = zip(*(r + p for r, p in zip(rows, places, strict=True)), strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _PLACED, strict=False)]
    return pa.Table.from_arrays(arrays, schema=_PLACED) if arrays else _PLACED.empty_table()


class Compare:
    """Links between two blocks: how many each vector has, and edges that join the same.

    A block stands beside itself or another. Of the links only a forest is told, which
    connects what they connect.
    """

    def __init__(self, cosine: float):
        self.cosine = cosine

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for same, left, right in rows:
            a, b = (matrix([m["unit"] for m in side]) for side in (left, right))
            linked = a @ b.T >= self.cosine
            if same:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            sides = [(left, right, linked)] if same else [
                (left, right, linked), (right, left, linked.T)
            ]
            for side, others, grid in sides:
                links = grid @ np.array([m["n"] for m in others], np.float64)
                for i in np.flatnonzero(links).tolist():
                    yield side[i]["key"], None, int(links[i])
            keys = [m["key"] for m in left] + ([] if same else [m["key"] for m in right])
            i, j = np.nonzero(linked)
            j = j if same else j + len(left)
            least = connected(len(keys), i, j)
            for x in np.flatnonzero(least != np.arange(len(keys))).tolist():
                yield keys[x], keys[least[x]], None


def connected(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of `n` is connected with."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[i], least[j])
        after = least.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == least).all():
            return least
        least = after


def linked_vectors(
    vectors: DataFrame,
    cosine: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Every row of `vectors` with `n_links`, `component_id` and `kept`.

    Two rows are linked when their labels are equal and not null, their vectors have as many
    components, and the cosine in double precision is at least `cosine`. Vectors that are
    null, empty, all zero or hold a null or non-finite component link with nothing.
    `n_links` counts the other rows linked directly, rows with the same id or vector too.
    `component_id` is the smallest id reachable; rows without an id link, but give no id.
    `kept` is whether the id is the component's. Other columns are not read.

    For unit vectors a cosine of at least t is a distance of at most r = sqrt(2 - 2t).

    1. Equal unit vectors of a label are one, with their number.
    2. A space (label and number of components) with more than `CELL` of them gets pivots:
       about one for each `CELL`, chosen by hash, none within r of another. Each vector is
       native to its nearest pivot's cell, and a guest where a bound by distances from the
       pivots cannot exclude a link with a native. Chunks of a space meet its pivots in many
       tasks. Pivots decide what is compared, never what is linked.
    3. Natives within r / 2 of their pivot all link with each other: they are counted, not
       compared. All other vectors of a cell are compared in pairs of blocks. Every pair of
       vectors meets in one cell at most, and what leaves a pair of blocks is a count for
       each vector and a forest, never the links themselves.
    """
    radius = math.sqrt(2 - 2 * cosine)
    source = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("vector"),
    )
    rows = staged(
        per_row(source, "vec_id bigint, space string, key binary, unit binary", Units()), "units"
    )
    classes = staged(
        rows.where("key is not null")
        .groupBy("space", "key", "unit")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("least")),
        "classes",
    )
    cells = staged(_cells(classes.select(*COLUMNS), radius), "cells")
    core = cells.where(F.col("kind") == CORE)
    cores = core.groupBy("space", "cell").agg(F.sum("n").alias("all"), F.min("key").alias("hub"))
    in_core = core.join(cores, ["space", "cell"]).select("key", "hub", F.col("all").alias("links"))
    none = F.lit(None)
    found = staged(
        per_row(
            _block_pairs(cells), "key binary, other binary, links bigint", Compare(cosine), step=1
        )
        .unionByName(in_core.select("key", none.cast("binary").alias("other"), "links"))
        .unionByName(
            in_core.where("key <> hub").select(
                "key", F.col("hub").alias("other"), none.cast("bigint").alias("links")
            )
        ),
        "found",
    )
    counts = found.where("links is not null").groupBy("key").agg(F.sum("links").alias("links"))
    joined = components(
        found.where("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b"))
    )
    joined = staged(joined, "joined")
    # The count of a core holds its own class, that of blocks does not.
    inside = core.select("key", F.lit(1).alias("core"))
    told = (
        classes.select("key", "n", "least")
        .join(counts, "key", "left")
        .join(inside, "key", "left")
        .join(joined.withColumnRenamed("node", "key"), "key", "left")
        .select(
            "key",
            "least",
            F.coalesce("component", "key").alias("component"),
            (
                F.coalesce("links", F.lit(0))
                + F.when(F.col("core").isNull(), F.col("n")).otherwise(0)
                - 1
            ).alias("n_links"),
        )
    )
    told = staged(told, "told")
    smallest = told.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = told.join(smallest, "component").select("key", "n_links", "component_id")
    out = rows.select("vec_id", "key").join(by_class, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _cells(classes: DataFrame, radius: float) -> DataFrame:
    """Natives and guests of every cell."""
    pivots_of = Pivots(radius)
    sizes = classes.groupBy("space").agg(F.count("*").alias("size"))
    large = staged(sizes.where(F.col("size") > CELL), "large")
    small = classes.join(large, "space", "left_anti").select(
        *COLUMNS,
        F.lit(0).alias("cell"),
        F.lit(0.0).alias("distance"),
        F.lit(NATIVE_FAR).alias("kind"),
    )
    if large.isEmpty():
        return small
    whole = classes.join(large, "space")
    chosen = whole.where(F.pmod(F.xxhash64("key"), F.lit(CELL)) == 0).select(*COLUMNS)
    pivots = staged(
        chosen.groupBy("space").applyInArrow(
            lambda rows: pivots_of(rows), "space string, cell int, pivot binary"
        ),
        "pivots",
    )
    # A space none of whose vectors was chosen is one cell.
    without = large.join(pivots.select("space").distinct(), "space", "left_anti")
    undivided = classes.join(without, "space", "left_semi").select(small.columns[:4]).select(
        *COLUMNS,
        F.lit(0).alias("cell"),
        F.lit(0.0).alias("distance"),
        F.lit(NATIVE_FAR).alias("kind"),
    )
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    dealt = whole.join(without, "space", "left_anti").withColumn(
        "chunk", F.pmod(F.xxhash64("key", F.lit(1)), chunks).cast("int")
    )
    spread = pivots.join(large, "space").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), chunks - 1))
    )
    natives = staged(
        _together(dealt.drop("size"), spread.drop("size"), Assign(radius)), "natives"
    )
    # Cores are bounded by their own radius.
    reach = (
        natives.where(F.col("kind") != CORE)
        .groupBy("space", "cell")
        .agg(F.max("distance").alias("reach"))
    )
    spread = spread.join(reach, ["space", "cell"], "left").fillna({"reach": -1.0})
    sized = natives.select(*COLUMNS, "cell").join(large, "space")
    again = sized.withColumn(
        "chunk", F.pmod(F.xxhash64("key", F.lit(1)), chunks).cast("int")
    ).drop("size")
    guests = _together(again, spread.drop("size"), Replicate(radius))
    return natives.unionByName(guests).unionByName(small).unionByName(undivided)


def _together(rows: DataFrame, pivots: DataFrame, work) -> DataFrame:
    keys = ["space", "chunk"]
    return (
        rows.groupBy(keys)
        .cogroup(pivots.groupBy(keys))
        .applyInArrow(lambda chunk, near: work(chunk, near), PLACED)
    )


def _block_pairs(cells: DataFrame) -> DataFrame:
    """Pairs of blocks of a cell that must be compared, each pair once."""
    where = ["space", "cell", "kind"]
    sizes = cells.groupBy(where).agg(F.count("*").alias("size"))
    blocks = staged(
        cells.join(sizes, where)
        .withColumn(
            "block",
            F.pmod(F.xxhash64("key", F.lit(2)), F.ceil(F.col("size") / BLOCK)).cast("int"),
        )
        .groupBy(*where, "block")
        .agg(F.collect_list(F.struct("key", "unit", "n")).alias("members")),
        "blocks",
    )
    left = blocks.where(F.col("kind") != CORE)
    right = blocks.where(F.col("kind") <= NATIVE_FAR).select(
        "space",
        "cell",
        F.col("kind").alias("other_kind"),
        F.col("block").alias("other_block"),
        F.col("members").alias("others"),
    )
    with_core = F.col("kind").isin(NATIVE_NEAR, GUEST_NEAR) & (F.col("other_kind") == CORE)
    guests = (F.col("kind") >= GUEST_NEAR) & (F.col("other_kind") != CORE)
    natives = (
        (F.col("kind") <= NATIVE_FAR)
        & (F.col("other_kind") != CORE)
        & (F.struct("kind", "block") <= F.struct("other_kind", "other_block"))
    )
    pairs = left.join(right, ["space", "cell"]).where(with_core | guests | natives)
    same = (F.col("kind") == F.col("other_kind")) & (F.col("block") == F.col("other_block"))
    return pairs.select(same.alias("same"), "members", "others")
