"""Best-fit packing after Martello-Toth dominance reduction."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearling.llm.bpe import WORD_BPE, encoded_rows, library_words
from yearling.llm.text import id_and_bytes, per_row
from yearling.sources.staging import staged

#: A bin's lengths with how often each occurs in it, in the order in which they lie.
Pattern = tuple[tuple[int, int], ...]


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> list[tuple[int, Pattern]]:
    """Fix bins that some best packing has; `counts` (pieces by length) shrinks in place.

    A feasible set dominates another one if the other's items can be dealt into places
    no smaller than their sum. Let j be an item and k the largest one that fits beside
    it. {j} dominates when nothing fits. {j, k} dominates when it fills the bin, when no
    two items fit beside j, or when at most two do and no pair of them is larger than k.
    Fixing a dominating set is repeated for all items of these lengths at once, and
    the pass over the lengths is repeated until nothing more is fixed.
    """
    fixed: list[tuple[int, Pattern]] = []
    while True:
        before = len(fixed)
        for j in sorted(counts, reverse=True):
            while counts.get(j):
                step = _dominating(j, counts, capacity)
                if step is None:
                    break
                times, pattern = step
                fixed.append(step)
                for length, n in pattern:
                    counts[length] -= times * n
                    if not counts[length]:
                        del counts[length]
        if len(fixed) == before:
            return fixed


def _dominating(j: int, counts: dict[int, int], capacity: int) -> tuple[int, Pattern] | None:
    """A set that dominates all others with an item of length `j`, and how often it can
    be taken."""
    room = capacity - j
    lengths = sorted(counts)
    own = counts[j]
    rest = {**counts, j: own - 1}
    others = [x for x in lengths if x <= room and rest[x]]
    if not others:
        return own, ((j, 1),)
    k = others[-1]
    smallest: list[int] = []
    for x in others:
        smallest += [x] * min(3 - len(smallest), rest[x])
        if len(smallest) == 3:
            break
    dominates = k == room or len(smallest) < 2 or smallest[0] + smallest[1] > room
    if not dominates and (len(smallest) < 3 or sum(smallest) > room):
        dominates = _largest_pair(others, rest, room) <= k
    if not dominates:
        return None
    if k == j:
        return own // 2, ((j, 2),)
    # The argument must hold for each repetition; it does while both lengths last,
    # as removing items only removes rivals.
    return min(own, counts[k]), tuple(sorted(((j, 1), (k, 1)), reverse=True))


def _largest_pair(lengths: list[int], counts: dict[int, int], room: int) -> int:
    best, low, high = 0, 0, len(lengths) - 1
    while low <= high:
        total = lengths[low] + lengths[high]
        if total > room or (low == high and counts[lengths[low]] < 2):
            high -= 1
        else:
            best = max(best, total)
            low += 1
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, Pattern]]:
    """Best-fit decreasing on counts of lengths: longest first, into the fullest bin.

    Bins with the same room are handled together. A bin that takes one item stays the
    fullest that can take another, so it takes as many as fit before the next bin does.
    """
    rooms: list[int] = []
    open_bins: dict[int, list[tuple[int, Pattern]]] = defaultdict(list)

    def put(room: int, times: int, pattern: Pattern) -> None:
        if room not in open_bins:
            insort(rooms, room)
        open_bins[room].append((times, pattern))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fit = capacity // length
                if left >= fit:
                    put(capacity - fit * length, left // fit, ((length, fit),))
                if left % fit:
                    put(capacity - left % fit * length, 1, ((length, left % fit),))
                break
            room = rooms[at]
            times, pattern = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
            fit = min(room // length, left)
            used = min(times, left // fit)
            put(room - fit * length, used, (*pattern, (length, fit)))
            if used < times:
                put(room, times - used, pattern)
            left -= used * fit
    return [bins for room in rooms for bins in open_bins[room]]


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[int, Pattern]]:
    """Bins for pieces given as counts by length; at most `capacity` lengths exist, so
    this is small whatever the number of pieces."""
    counts = {length: n for length, n in counts.items() if n}
    fixed = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(counts, capacity)


class Pieces:
    """Tokenized pieces of at most `capacity`, numbered by length within the partition."""

    def __init__(self, vocabulary: str, capacity: int, end: int):
        self.vocabulary, self.capacity, self.end = vocabulary, capacity, end

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        coder = library_words(self.vocabulary)
        end = np.array([self.end], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), Counter()
        for (doc_id, _), ids in encoded_rows(coder, rows):
            ids += end
            for piece, a in enumerate(range(0, len(ids), 4 * self.capacity)):
                own = ids[a : a + 4 * self.capacity]
                length = len(own) // 4
                yield doc_id, piece, a // 4, length, zlib.crc32(own), part, seen[length]
                seen[length] += 1


class Places:
    """From a piece's number within its length to its sequence and offset."""

    def __init__(self, packed: list[tuple[int, Pattern]]):
        found = defaultdict(list)
        base = 0
        for times, pattern in packed:
            offset = 0
            for length, n in pattern:
                found[length].append((times, n, base, offset))
                offset += length * n
            base += times
        self.places = {}
        for length, spans in found.items():
            times, n, base, offset = np.array(spans, np.int64).T
            starts = np.concatenate(([0], np.cumsum(times * n)))
            self.places[length] = (starts, n, base, offset)

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, piece, start, length, crc, number in rows:
            starts, n, base, offset = self.places[length]
            at = int(np.searchsorted(starts, number, side="right")) - 1
            within = number - int(starts[at])
            many = int(n[at])
            yield (
                doc_id,
                piece,
                start,
                length,
                crc,
                int(base[at]) + within // many,
                int(offset[at]) + within % many * length,
            )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    vocabulary: str = WORD_BPE,
    end: int = 0,
) -> DataFrame:
    """Pack every text into as few sequences of at most `capacity` tokens as it can.

    A document is its ids and then `end`; null or empty text is `end` alone. Longer ones
    are cut into full pieces and a rest. One row for each piece: `doc_id`, `piece`,
    `start`, `length`, `ids_crc32`, `sequence_id`, `offset`. Repeated rows are packed
    each; an empty table gives no rows; other columns are not read.

    Only lengths matter to the packing, and there are at most `capacity` of them: the
    driver packs their counts, giving patterns of lengths with how often each is used.
    Pieces of a length are numbered (within a partition while tokenizing, then by the
    counts of the partitions before it), and the number tells the place.
    """
    pieces = staged(
        per_row(
            id_and_bytes(docs, id_col, text_col),
            "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
            "part int, place bigint",
            Pieces(vocabulary, capacity, end),
        ),
        "pieces",
    )
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    totals = by_part.groupBy("length").agg(F.sum("n").alias("n"))
    packed = pack_lengths({r["length"]: r["n"] for r in totals.collect()}, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select(
        "length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    numbered = pieces.join(before, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.expr("before + place").alias("number")
    )
    return per_row(
        numbered,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint",
        Places(packed),
    )
