"""Log-probability of texts by prediction by partial matching over bytes."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from yearling.llm.text import crc_remainder, mix, per_row, tuples
from yearling.sources.staging import staged

#: A symbol is a byte or the end; a context may also hold the start. Nine bits each.
END, START = 256, 257
SYMBOLS, BITS = 257, 9
#: Bytes of the longest context; with the symbol, a gram fills 63 bits.
ORDER = 6

#: A word is frequent if it is at least one in so many tokens, a gram if it is at least
#: one in so many symbols. What is frequent goes to every task and spares a join; what is
#: not is joined. So there are never more than this in a task, and results do not change.
SHARE = 1 << 20
GRAM_SHARE = 1 << 22
#: Grams are dealt by so many symbols before the last one; levels of shorter contexts,
#: whose number the alphabet bounds, are known to all tasks.
SHARED = 3
#: Distinct grams, and symbols, of texts that are looked up together.
WANTED = 1_000_000
WANTED_SYMBOLS = 32_000_000
#: Bytes of texts whose words a task counts together, and distinct grams it holds, before
#: it passes their counts on.
WORDS_TOGETHER = 8 << 20
GRAMS_HELD = 2_000_000
#: Symbols, and texts, that are counted or scored together.
TOGETHER, TEXTS_TOGETHER = 1_000_000, 10_000


def codes(body: bytes, order: int) -> np.ndarray:
    """For each symbol of a text and its end: the context and the symbol, in one number."""
    n = len(body) + 1
    symbols = np.full(n + order, START, np.int64)
    symbols[order:-1] = np.frombuffer(body, np.uint8)
    symbols[-1] = END
    out = np.zeros(n, np.int64)
    for k in range(order + 1):
        out = out << BITS | symbols[k : k + n]
    return out


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, and the place of each value among them.

    Values are hashed, and only the distinct ones sorted: most occur many times.
    """
    place, distinct = pd.factorize(values)
    order = np.argsort(distinct)
    places = np.empty(len(order), np.int64)
    places[order] = np.arange(len(order))
    return distinct[order], places[place]


def _contexts(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct contexts of sorted grams, and the place of each gram's among them."""
    contexts = grams >> BITS
    first = np.ones(len(contexts), bool)
    first[1:] = contexts[1:] != contexts[:-1]
    return contexts[first], np.cumsum(first) - 1


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted table, and whether each is a hit."""
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


class _Nothing:
    """No levels."""

    grams = counts = contexts = own = excluded = direct = ()


class Trie:
    """Contexts of `order` bytes, of one less, and so on, with the symbols after each.

    A symbol is looked up in the longest context the trie has. If it is not there, an
    escape is charged: the distinct symbols there, and all that was seen there but is no
    node, as a share of all that was seen plus the distinct symbols (method C); with all
    grams as nodes there is nothing of the latter. In the
    next shorter context the symbols of the longer one, which cannot follow, are taken
    out of every count. What no context has is shared evenly. Every node's suffix is a
    node, so what is excluded is known beforehand for every context.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], base: Trie | None = None):
        """`levels`: grams (sorted) and their counts, by the length of the context.

        With a `base`, which has the levels of shorter contexts, these are the levels
        after it, and all grams of their contexts are nodes.
        """
        known = base or _Nothing
        self.grams = [*known.grams, *(g for g, _ in levels)]
        self.counts = [*known.counts, *(n.astype(np.float64) for _, n in levels)]
        self.contexts, self.own = [*known.contexts], [*known.own]
        self.excluded, self.direct = [*known.excluded], [*known.direct]
        texts = self._count(0, np.array([END]))[0] if base is None else None
        for k in range(len(self.contexts), len(self.grams)):
            grams, counts = self.grams[k], self.counts[k]
            contexts, place = _contexts(grams)
            kept = np.bincount(place, counts, len(contexts))
            distinct = np.bincount(place, minlength=len(contexts)).astype(np.float64)
            if k and base is None:
                start = sum(START << BITS * i for i in range(k))
                seen = np.where(contexts == start, texts, self._count(k - 1, contexts))
            else:
                seen = kept
            self.contexts.append(contexts)
            whole = (seen + distinct)[place]
            self.direct.append(np.log10(counts / whole))
            # All that was seen, what is in nodes, distinct symbols; and these for the
            # next shorter context without the symbols of this one.
            self.own.append((seen, kept, distinct))
            if k:
                shorter, _ = _find(self.contexts[k - 1], self._suffix(contexts, k - 1))
                gone = np.bincount(
                    place, self._count(k - 1, self._suffix(grams, k)), len(contexts)
                )
                seen, kept, others = (x[shorter] for x in self.own[k - 1])
                self.excluded.append((seen - gone, kept - gone, others - distinct))
            else:
                self.excluded.append(None)
        self.even = -math.log10(max(1, SYMBOLS - len(self.grams[0])))

    @staticmethod
    def _suffix(codes: np.ndarray, symbols: int) -> np.ndarray:
        return codes & ((1 << BITS * symbols) - 1)

    def _count(self, k: int, grams: np.ndarray) -> np.ndarray:
        if not len(self.grams[k]):
            return np.zeros(len(grams))
        at, hit = _find(self.grams[k], grams)
        return np.where(hit, self.counts[k][at], 0.0)

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each gram, after the ones before it."""
        out = np.zeros(len(grams))
        open_, longer = np.arange(len(grams)), np.full(len(grams), -1)
        for k in range(len(self.grams) - 1, -1, -1):
            if not len(self.grams[k]):
                continue
            own = self._suffix(grams[open_], k + 1)
            gram, hit = _find(self.grams[k], own)
            before = longer[open_]
            fallen = before >= 0
            # Nothing longer is known: the context's own counts.
            plain = hit & ~fallen
            out[open_[plain]] += self.direct[k][gram[plain]]
            after = hit & fallen
            if after.any():
                seen, _, distinct = (x[before[after]] for x in self.excluded[k + 1])
                out[open_[after]] += np.log10(self.counts[k][gram[after]] / (seen + distinct))
            open_, own, before = open_[~hit], own[~hit], before[~hit]
            if not len(open_):
                break
            context, known = _find(self.contexts[k], own >> BITS)
            fallen = before >= 0
            state = [x[context] for x in self.own[k]]
            if fallen.any():
                state = [
                    np.where(fallen, x[before], y)
                    for x, y in zip(self.excluded[k + 1], state, strict=True)
                ]
            seen, kept, distinct = state
            some = known & (seen + distinct > 0)
            share = np.where(some, seen - kept + distinct, 1.0) / np.where(
                some, seen + distinct, 1.0
            )
            out[open_] += np.log10(share)
            longer[open_] = np.where(known, context, -1)
        out[open_] += self.even
        return out

    def scores(self, bodies: list[bytes]) -> np.ndarray:
        """log10 probability of each text; each distinct gram is looked up once."""
        order = len(self.grams) - 1
        grams = [codes(body, order) for body in bodies]
        starts = np.cumsum([0] + [len(g) for g in grams[:-1]])
        distinct, place = _distinct(np.concatenate(grams))
        return np.add.reduceat(self.lengths(distinct)[place], starts)


@lru_cache(maxsize=1)
def _trie(levels: bytes) -> Trie:
    return Trie(pickle.loads(levels))


def _last(grams: np.ndarray, symbols: int) -> np.ndarray:
    return grams & ((1 << BITS * symbols) - 1)


def _summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams, sorted, and the sums of their counts; sorted runs are merged."""
    if not len(grams):
        return grams, counts
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[first], np.add.reduceat(counts[order], first)


def _shortened(
    grams: np.ndarray, counts: np.ndarray, symbols: int
) -> tuple[np.ndarray, np.ndarray]:
    """The last symbols of grams, distinct and sorted, and the sums of their counts."""
    shorter, place = _distinct(_last(grams, symbols))
    return shorter, np.bincount(place, counts, len(shorter)).astype(np.int64)


def _dealt(grams: np.ndarray, order: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets and the places of their grams, in order. Grams whose contexts end with the
    same `SHARED` symbols have one bucket, and so have all contexts that these escape to."""
    suffix = _last(grams >> BITS, min(order, SHARED)).astype(np.uint64)
    # Small numbers are sorted in fewer steps.
    kind = np.uint16 if buckets <= 1 << 16 else np.int64
    own = (mix(suffix) % np.uint64(buckets)).astype(kind)
    at = np.argsort(own, kind="stable")
    own = own[at]
    for part in np.split(at, np.flatnonzero(own[1:] != own[:-1]) + 1):
        if len(part):
            yield int((mix(suffix[part[:1]]) % np.uint64(buckets))[0]), part


def _packed(values: np.ndarray, rising: bool = False) -> bytes:
    """Numbers as few bytes, by planes of their bytes; rising ones as differences."""
    if rising:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(packed: bytes, kind: type = np.int64, rising: bool = False) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    planes = pa.decompress(packed[8:], size, "zstd", asbytes=True)
    planes = np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    values = np.ascontiguousarray(planes.T).view(kind).reshape(-1)
    return np.cumsum(values, dtype=kind) if rising else values


def _packed_lengths(values: np.ndarray) -> bytes:
    """Lengths, of which many are equal, as their distinct values and small numbers."""
    distinct, place = np.unique(values, return_inverse=True)
    known = _packed(distinct.view(np.int64), True)
    kind = np.uint16 if len(distinct) <= 1 << 16 else np.uint32
    return len(known).to_bytes(8, "little") + known + _packed(place.astype(kind))


def _unpacked_lengths(packed: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(packed[:8], "little")
    distinct = _unpacked(packed[8:end], rising=True).view(np.float64)
    kind = np.uint16 if len(distinct) <= 1 << 16 else np.uint32
    return distinct[_unpacked(packed[end:], kind)]


def _array(column: pa.ChunkedArray, kind: type = np.int64, rising: bool = False) -> np.ndarray:
    """The numbers of all rows."""
    parts = [_unpacked(p, kind, rising) for p in column.to_pylist()]
    return np.concatenate([np.empty(0, kind), *parts])


class GramCounts:
    """Counts of the grams of a partition, as Arrow batches: a row for each bucket."""

    def __init__(self, order: int, buckets: int):
        self.order, self.buckets = order, buckets

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        runs: list[tuple[np.ndarray, np.ndarray]] = []
        size = waiting = 0

        def count() -> None:
            runs.append(np.unique(np.concatenate(held), return_counts=True))
            held.clear()

        def merge() -> None:
            grams, counts = (np.concatenate(x) for x in zip(*runs, strict=True))
            runs[:] = [_summed(grams, counts)]

        def out() -> Iterator[pa.RecordBatch]:
            for grams, counts in runs:
                counts = counts.astype(np.int64)
                rows = [
                    (bucket, _packed(grams[at], True), _packed(counts[at]))
                    for bucket, at in _dealt(grams, self.order, self.buckets)
                ]
                for a in range(0, len(rows), 256):
                    columns = map(pa.array, zip(*rows[a : a + 256], strict=True))
                    yield pa.RecordBatch.from_arrays(list(columns), ["bucket", "grams", "ns"])
            runs.clear()

        for (raw,) in tuples(batches):
            held.append(codes((raw or b"").lower(), self.order))
            size += len(held[-1])
            if size > TOGETHER:
                count()
                size, waiting = 0, waiting + len(runs[-1][0])
                if waiting > GRAMS_HELD:
                    merge()
                    waiting = len(runs[0][0])
                    if 2 * waiting > GRAMS_HELD:
                        yield from out()
                        waiting = 0
        if held:
            count()
        if runs:
            merge()
            yield from out()


def _counted(training: DataFrame, order: int, buckets: int) -> DataFrame:
    """All grams of all texts, a row for each bucket: `bucket`, `grams` (sorted) and `ns`,
    their sum `n`, and the counts of the longest grams that all tasks know, `short`."""
    shared = min(order, SHARED)

    def merged(rows: pa.Table) -> pa.Table:
        grams, counts = _summed(_array(rows["grams"], rising=True), _array(rows["ns"]))
        short, sums = _shortened(grams, counts, shared)
        found = {
            "bucket": rows["bucket"][:1],
            "grams": [_packed(grams, True)],
            "ns": [_packed(counts)],
            "n": [int(counts.sum())],
            "short": [short.tolist()],
            "sums": [sums.tolist()],
        }
        return pa.table(found, schema=to_arrow_schema(kind))

    kind = StructType.fromDDL(
        "bucket bigint, grams binary, ns binary, n bigint, short array<bigint>, sums array<bigint>"
    )
    counts = training.mapInArrow(
        GramCounts(order, buckets), "bucket bigint, grams binary, ns binary"
    )
    return staged(counts.groupBy("bucket").applyInArrow(merged, kind), "grams")


def _base(grams: DataFrame, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of the shorter contexts, which the alphabet bounds and the driver sees."""
    shared = min(order, SHARED)
    if not shared:
        return []
    found = (
        grams.select(F.explode(F.arrays_zip("short", "sums")).alias("g"))
        .groupBy(F.col("g.short").alias("gram"))
        .agg(F.sum("g.sums").alias("n"))
        .sort("gram")
        .toArrow()
    )
    levels = [(found["gram"].to_numpy(), found["n"].to_numpy())]
    for k in range(shared - 1, 0, -1):
        longer, counts = levels[-1]
        levels.append(_shortened(longer, counts, k))
    return levels[::-1]


class Frequent:
    """Frequent grams of a bucket, and their log10 probability after what is before them."""

    def __init__(self, least: float):
        self.least = least

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for own, ns in rows:
            grams, counts = _unpacked(own, rising=True), _unpacked(ns)
            contexts, place = _contexts(grams)
            whole = np.bincount(place, counts + 1, len(contexts))
            often = counts >= self.least
            found = np.log10(counts[often] / whole[place[often]])
            yield from zip(grams[often].tolist(), found.tolist(), strict=True)


def _looked_up(
    grams: DataFrame, wanted: DataFrame, base: Broadcast, order: int
) -> DataFrame:
    """`chunk`, `bucket` and `lengths` of all wanted grams, bucket by bucket: all contexts
    that a gram can escape to are in its bucket or known to all tasks."""

    def lengths(known: pa.Table, asked: pa.Table) -> pa.Table:
        own, counts = _array(known["grams"], rising=True), _array(known["ns"])
        levels = [_shortened(own, counts, k + 1) for k in range(min(order, SHARED), order)]
        trie = Trie([*levels, (own, counts)], _trie(base.value))
        held = [_unpacked(g, rising=True) for g in asked["grams"].to_pylist()]
        distinct, place = _distinct(np.concatenate([own[:0], *held]))
        found = trie.lengths(distinct)[place]
        ends = np.cumsum([len(g) for g in held])
        parts = [_packed_lengths(x) for x in np.split(found, ends[:-1])] if held else []
        return pa.table(
            [asked["chunk"], asked["bucket"], pa.array(parts, pa.binary())],
            schema=to_arrow_schema(kind),
        )

    kind = StructType.fromDDL("chunk bigint, bucket bigint, lengths binary")
    return grams.select("bucket", "grams", "ns").groupBy("bucket").cogroup(
        wanted.select("bucket", "chunk", "grams").groupBy("bucket")
    ).applyInArrow(lengths, kind)


def _sums(texts: DataFrame, found: DataFrame) -> DataFrame:
    """`row` and `rare_score`: the sum over the grams of each text that were looked up."""

    def summed(own: pa.Table, known: pa.Table) -> pa.Table:
        # Grams of a chunk are numbered bucket by bucket.
        parts = known.sort_by("bucket")["lengths"].to_pylist()
        by_place = np.concatenate([np.empty(0), *map(_unpacked_lengths, parts)])
        texts = (_unpacked(p, np.int32, True) for p in own["places"].to_pylist())
        sums = [by_place[p].sum() for p in texts]
        return pa.table([own["row"], pa.array(sums, pa.float64())], schema=to_arrow_schema(kind))

    kind = StructType.fromDDL("row bigint, rare_score double")
    return (
        texts.select("chunk", "row", "places")
        .groupBy("chunk")
        .cogroup(found.groupBy("chunk"))
        .applyInArrow(summed, kind)
    )


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of many texts at a time; the end of a text is the empty word."""
    held: list[bytes] = []
    size = 0

    def counted() -> Iterator[pa.RecordBatch]:
        texts = pa.array(held, pa.binary()).cast(pa.string())
        found = pc.ascii_split_whitespace(texts).flatten()
        # White space at either end leaves empty words.
        found = found.filter(pc.not_equal(found, "")).value_counts()
        words, counts = found.field("values").cast(pa.binary()), found.field("counts")
        for a in range(0, len(words), 1 << 16):
            yield _words_batch(words.slice(a, 1 << 16), counts.slice(a, 1 << 16))
        yield _words_batch(pa.array([b""], pa.binary()), pa.array([len(held)]))

    for (raw,) in tuples(batches):
        held.append((raw or b"").lower())
        size += len(held[-1])
        if size > WORDS_TOGETHER or len(held) > WORDS_TOGETHER // 64:
            yield from counted()
            held, size = [], 0
    if held:
        yield from counted()
    pa.default_memory_pool().release_unused()


def _words_batch(words: pa.Array, counts: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([words, counts], ["word", "n"])


class Chunk:
    """Distinct grams of texts that are looked up together, numbered as they come."""

    def __init__(self, key: int):
        self.key, self.symbols = key, 0
        self.grams, self.numbers = np.empty(0, np.int64), np.empty(0, np.int32)
        #: Rows of texts and the numbers of their grams, at most one for each symbol.
        self.texts: list[tuple[int, np.ndarray]] = []

    def places(self, grams: np.ndarray) -> np.ndarray:
        """Numbers of distinct, sorted grams."""
        out = np.full(len(grams), -1, np.int32)
        if len(self.grams):
            at, hit = _find(self.grams, grams)
            out[hit] = self.numbers[at[hit]]
        new = out < 0
        out[new] = np.arange(len(self.grams), len(self.grams) + new.sum(), dtype=np.int32)
        at = np.searchsorted(self.grams, grams[new])
        self.grams = np.insert(self.grams, at, grams[new])
        self.numbers = np.insert(self.numbers, at, out[new])
        return out


class Scores:
    """Rows of texts, with their score as far as frequent words and grams go, rows of the
    grams that are looked up for a chunk of them, and of the places of these in each text:
    they are numbered by bucket, then in order, so that no numbers travel with them. Words
    that are not frequent leave with the row, to be joined. Arrow batches in and out."""

    def __init__(self, often, frequent, order: int, buckets: int, schema: pa.Schema):
        self.often, self.frequent, self.order, self.buckets = often, frequent, order, buckets
        self.schema = schema
        # Workers do not see what the driver sets.
        self.wanted, self.wanted_symbols = WANTED, WANTED_SYMBOLS
        self.together = TOGETHER

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, frequent = _often(self.often.value), self.frequent.value
        part, number = TaskContext.get().partitionId(), 0
        held, bodies, size, chunk = [], [], 0, None
        for doc_id, held_out, raw in tuples(batches):
            body = (raw or b"").lower()
            held.append((part << 33 | number, doc_id, held_out))
            number += 1
            bodies.append(body)
            size += len(body)
            if size > self.together or len(held) >= TEXTS_TOGETHER:
                chunk = chunk or Chunk(held[0][0])
                yield self.scored(often, frequent, chunk, held, bodies)
                held, bodies, size = [], [], 0
                if len(chunk.grams) > self.wanted or chunk.symbols > self.wanted_symbols:
                    yield from self.asked(chunk)
                    chunk = None
        if held:
            chunk = chunk or Chunk(held[0][0])
            yield self.scored(often, frequent, chunk, held, bodies)
        if chunk:
            yield from self.asked(chunk)
        # Workers live on; what Arrow keeps for later would add to the next operator's.
        pa.default_memory_pool().release_unused()

    def batch(self, n: int, **columns) -> pa.RecordBatch:
        """Rows with some of the columns; the others are null."""
        arrays = [
            pa.nulls(n, f.type) if f.name not in columns else pa.array(columns[f.name], f.type)
            for f in self.schema
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)

    def scored(
        self, often: tuple, frequent: dict, chunk: Chunk, held: list[tuple], bodies: list[bytes]
    ) -> pa.RecordBatch:
        grams = [codes(body, self.order) for body in bodies]
        ends = np.cumsum([len(g) for g in grams])
        distinct, place = _distinct(np.concatenate(grams))
        lengths, known = np.zeros(len(distinct)), np.zeros(len(distinct), bool)
        if len(often[0]):
            at, known = _find(often[0], distinct)
            lengths[known] = often[1][at[known]]
        places = np.full(len(distinct), -1, np.int32)
        places[~known] = chunk.places(distinct[~known])
        chunk.symbols += len(place)
        scores = np.add.reduceat(lengths[place], np.concatenate(([0], ends[:-1])))
        own = np.split(places[place], ends[:-1])
        for (row, _, _), p in zip(held, own, strict=True):
            chunk.texts.append((row, p[p >= 0]))
        rows, doc_ids, held_out = zip(*held, strict=True)
        return self.batch(
            len(held),
            row=rows,
            doc_id=doc_ids,
            held_out=held_out,
            score=scores,
            **self.base(bodies, frequent),
        )

    def asked(self, chunk: Chunk) -> Iterator[pa.RecordBatch]:
        place, known = np.empty(len(chunk.grams), np.int32), 0
        parts = sorted(_dealt(chunk.grams, self.order, self.buckets), key=lambda part: part[0])
        found = []
        for bucket, at in parts:
            place[chunk.numbers[at]] = np.arange(known, known + len(at), dtype=np.int32)
            known += len(at)
            found.append((bucket, _packed(chunk.grams[at], True)))
        for some in _some(found):
            buckets, packed = zip(*some, strict=True)
            keys = [chunk.key] * len(some)
            yield self.batch(len(some), chunk=keys, bucket=buckets, grams=packed)
        texts = (
            (row, _packed(np.sort(place[numbers]), True))
            for row, numbers in chunk.texts
            if len(numbers)
        )
        for some in _some(texts):
            rows, packed = zip(*some, strict=True)
            yield self.batch(len(some), row=rows, chunk=[chunk.key] * len(some), places=packed)

    def base(self, bodies: list[bytes], frequent: dict[bytes, float]) -> dict:
        """Of each text: tokens, those among them that are frequent, their log10
        probability, and the others with their counts. Distinct words are looked up once."""
        texts = pa.array(bodies, pa.binary()).cast(pa.string())
        split = pc.ascii_split_whitespace(texts)
        found = split.flatten().dictionary_encode()
        words = found.dictionary.cast(pa.binary())
        lengths = map(frequent.get, words.to_pylist(), repeat(math.nan))
        lengths = np.fromiter(lengths, np.float64, len(words))
        # White space at either end leaves empty words; the end is a token of its own.
        some = pc.not_equal(words, b"").to_numpy(zero_copy_only=False)
        often = some & ~np.isnan(lengths)
        lengths = np.where(often, lengths, 0.0)
        word = found.indices.to_numpy()
        text = np.repeat(np.arange(len(bodies)), np.diff(split.offsets.to_numpy()))
        n = len(bodies)
        rare = (some & ~often)[word]
        end = frequent.get(b"")
        # Words that are not frequent, once for each text, text by text.
        pairs, counts = np.unique(text[rare] * max(1, len(words)) + word[rare], return_counts=True)
        owner, which = np.divmod(pairs, max(1, len(words)))
        own, ns = pa.array(which), counts.astype(np.int64)
        rest = words.take(own)
        if end is None:
            # The end of a text is not frequent: one more word of each.
            owner = np.concatenate((owner, np.arange(n)))
            order = np.argsort(owner, kind="stable")
            owner, ns = owner[order], np.concatenate((ns, np.ones(n, np.int64)))[order]
            rest = pa.concat_arrays([rest, pa.array([b""] * n, pa.binary())]).take(pa.array(order))
        offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
        kind = self.schema.field("rest").type
        pairs = pa.StructArray.from_arrays([rest, pa.array(ns)], fields=list(kind.value_type))
        return {
            "n_tokens": np.bincount(text, some[word], n).astype(np.int64) + 1,
            "known": np.bincount(text, often[word], n).astype(np.int64) + (end is not None),
            "base": np.bincount(text, lengths[word], n) + (end or 0.0),
            "rest": pa.ListArray.from_arrays(pa.array(offsets), pairs, type=kind),
        }


def _some(rows: Iterable[tuple], most: int = 4096, size: int = 8 << 20) -> Iterator[list[tuple]]:
    """Rows, whose last value is long, in lists of bounded count and size."""
    held, waiting = [], 0
    for row in rows:
        held.append(row)
        waiting += len(row[-1])
        if len(held) >= most or waiting >= size:
            yield held
            held, waiting = [], 0
    if held:
        yield held


@lru_cache(maxsize=1)
def _often(grams: bytes) -> tuple[np.ndarray, np.ndarray]:
    return pickle.loads(grams)


def log_probabilities(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    modulus: int = 5,
    held_out: int = 1,
    order: int = ORDER,
) -> DataFrame:
    """Two log10 probabilities of every text: `doc_id`, `held_out`, `n_tokens`, `n_known`,
    `train_tokens`, `base_score`, `score`.

    Both learn from all texts whose `crc32` of the id as text, modulo `modulus`, is not
    `held_out`; texts are lower-cased (A-Z). `score` sums the bytes
    and the end of the text in a byte-context trie (`Trie`), `base_score` that of its words
    and its end by their counts plus one half. Null counts as empty: only the end. With
    nothing to learn from, bytes are even and counts are 0. A null id counts as the empty
    text in `crc32`. Repeated rows each give a row; other columns are not read.

    All grams and words of the corpus are counted by Spark, and all are kept. Frequent
    ones, and the levels of contexts of fewer than `SHARED` bytes, go to every task. The
    other words of each text are joined with the counts of all words, and the other
    distinct grams of a chunk of texts with the grams of their bucket, which has all
    contexts that they escape to.
    """
    spark = docs.sparkSession
    remainder = crc_remainder(id_col, modulus)
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (remainder == held_out).alias("held_out"),
        F.col(text_col).cast("binary").alias("raw"),
    )
    training = source.where(~F.col("held_out")).select("raw")
    # A stated number: each bucket of grams is held by one task, one after the other.
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    grams = _counted(training, order, buckets)
    symbols = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = per_row(
        grams.select("grams", "ns"),
        "gram bigint, length double",
        Frequent(symbols / GRAM_SHARE),
        step=1,
    )
    often = often.sort("gram").toArrow()
    counts = staged(
        training.mapInArrow(_word_counts, "word binary, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("c")),
        "words",
    )
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = counts.where(F.col("c") * SHARE >= total).toArrow()
    frequent = zip(frequent["word"].to_pylist(), frequent["c"].to_pylist(), strict=True)
    send = spark.sparkContext.broadcast
    scale = math.log10(total + 0.5 * (distinct + 1))
    kind = (
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, "
        "base double, rest array<struct<word: binary, n: bigint>>, score double, "
        "chunk bigint, places binary, bucket bigint, grams binary"
    )
    scores = Scores(
        send(pickle.dumps((often["gram"].to_numpy(), often["length"].to_numpy()))),
        send({word: math.log10(c + 0.5) - scale for word, c in frequent}),
        order,
        buckets,
        to_arrow_schema(StructType.fromDDL(kind)),
    )
    both = staged(source.mapInArrow(scores, kind), "scores")
    rows = both.where(F.col("chunk").isNull())
    base = send(pickle.dumps(_base(grams, order)))
    found = _looked_up(grams, both.where(F.col("bucket").isNotNull()), base, order)
    sums = _sums(both.where(F.col("places").isNotNull()), found)
    rows = rows.drop("chunk", "places", "bucket", "grams")
    rare = (
        rows.select("row", F.explode("rest").alias("own"))
        .select("row", "own.word", "own.n")
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + 0.5) - scale)).alias(
                "rare_base"
            ),
        )
    )
    joined = rows.drop("rest").join(rare, "row", "left").join(sums, "row", "left")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )
