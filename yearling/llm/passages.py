"""Passages that repeat, nearly or exactly, in other documents, by compact windows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.window import Window

from yearling.llm.filters import perhaps_in
from yearling.llm.text import (
    id_and_bytes,
    mix,
    per_row,
    shingle_hashes,
    tuples,
    word_hashes,
    words,
)
from yearling.sources.staging import discard, staged

#: Words of a shingle; similarity of two passages, in percent, of their distinct shingles.
SHINGLE, PERCENT = 5, 80

#: Hash functions. Passages of one length share a min-hash of one with at least the
#: chance of their similarity; exact ones share all. At 0.8, five miss 1 in 3,000.
HASHES = 5

#: Shingles of a run at a centre that must agree too. Two similar passages of the least
#: width differ in one word at most, so a centre has such a run on one of its sides.
RUN = 11

#: Earlier documents of a bucket that a window is compared with, round by round; what no
#: round resolves is compared with all.
ROUNDS = (1, 5)

#: Members of a bucket that are compared with each other at a time in the end, and blocks
#: that one task goes through one after the other.
BLOCK, STRIPE = 256, 16

#: Bytes of text that are looked at together.
STEP = 1 << 20

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SEEDS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def centres_of(
    values: np.ndarray, width: int, starts: np.ndarray | None = None, rows: np.ndarray | None = None
) -> np.ndarray:
    """Places of the least values of all runs of `width`: one for each run, at least.

    `starts` are the runs that count (all, if not given), and `rows` tells the text of each
    place. Of equal values in a run the first counts, but in a row of equal ones only as
    many are kept as every run needs. The place fills the low bits of a value, so that one
    minimum by doubling finds both.
    """
    n = len(values)
    if n < width:
        return np.empty(0, np.int64)
    low = np.uint64(max(24, n.bit_length()))
    least, span = (values >> low << low) | np.arange(n, dtype=np.uint64), 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: n - width + 1], least[width - span :][: n - width + 1])
    if starts is not None:
        least = least[starts]
        if not len(least):
            return np.empty(0, np.int64)
    places = (least & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    places = places[np.concatenate(([True], places[1:] != places[:-1]))]
    tied = (values[places[1:]] == values[places[:-1]]) & (np.diff(places) < width)
    if rows is not None:
        tied &= rows[places[1:]] == rows[places[:-1]]
    if not tied.any():
        return places
    kept, last = [], -width
    for i, place in enumerate(places.tolist()):
        follows = i > 0 and tied[i - 1]
        leads = i < len(tied) and tied[i]
        # Inside a row of equal values, a place is needed if the next is out of reach.
        if not (follows and leads) or places[i + 1] > last + width:
            kept.append(place)
            last = place
    return np.array(kept, np.int64)


def compact_windows(
    values: np.ndarray,
    width: int,
    starts: np.ndarray | None = None,
    rows: np.ndarray | None = None,
    ends: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left ends, centres and right ends (inclusive) of the compact windows.

    In every subsequence that contains the centre and lies in the window, the centre has
    the least value; every subsequence of `width` values lies in such a window with its
    centre. The windows are nodes of the Cartesian tree over the values, as far as a
    subsequence of `width` around the centre can reach: a node ends before the next
    smaller value on either side. That is a centre too, so only centres, a share of 2 in
    `width`, are compared. Equal values do not bound each other. For values of several
    texts end to end, `ends` has the first and last place of each of the `rows`.
    """
    centres = centres_of(values, width, starts, rows)
    row = np.zeros(len(centres), np.int64) if rows is None else rows[centres]
    first, last = ends if ends else (np.zeros(1, np.int64), np.array([len(values) - 1]))
    lefts = np.maximum(centres - width + 1, first[row])
    rights = np.minimum(centres + width - 1, last[row])
    own = values[centres]
    for j in range(1, len(centres)):
        a, b = centres[:-j], centres[j:]
        near = (b - a < width) & (row[:-j] == row[j:])
        if not near.any():
            break
        hit = np.flatnonzero(near & (own[:-j] < own[j:]))
        lefts[hit + j] = np.maximum(lefts[hit + j], a[hit] + 1)
        hit = np.flatnonzero(near & (own[j:] < own[:-j]))
        rights[hit] = np.minimum(rights[hit], b[hit] - 1)
    return lefts, centres, rights


def text_id(doc_id: int, key: bytes) -> int:
    """A number for a document's text: rows of one id may have different texts."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(b"%d:" % doc_id + key)).view(np.int64))


def text_key(ws: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(ws))


_SKETCH = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_id", pa.int64()),
        ("n_words", pa.int32()),
        ("text_key", pa.binary()),
        ("buckets", pa.list_(pa.int64())),
        ("centres", pa.list_(pa.int32())),
        ("reaches", pa.list_(pa.int32())),
        ("runs", pa.list_(pa.int64())),
    ]
)


class Passages:
    """Settings shared by the steps."""

    def __init__(self, min_words: int, shingle: int, percent: int, hashes: int):
        self.shingle, self.percent, self.hashes = shingle, percent, hashes
        self.min_words = min_words
        #: Shingles of the shortest passage.
        self.width = min_words - shingle + 1
        #: Equal places of two runs of the least width, if these are similar enough.
        self.least = -(-2 * self.width * percent // (100 + percent))
        self.run = min(RUN, max(1, self.least // 3))


class Sketch(Passages):
    """For each text: a key of its words, and its windows: the bucket of the least value,
    the centre, how far the window reaches on both sides, and hashes of the runs that end
    and start at the centre. Many texts are looked at together, end to end."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in tuples(batches):
            held.append(row)
            size += len(row[1] or b"")
            if size >= STEP or len(held) >= 4096:
                yield self.sketched(held)
                held, size = [], 0
        if held:
            yield self.sketched(held)
        pa.default_memory_pool().release_unused()

    def sketched(self, rows: list[tuple]) -> pa.RecordBatch:
        ids, keys, sizes, flat, lengths = [], [], [], [], []
        for doc_id, raw in rows:
            ws = words(raw)
            key = text_key(ws)
            ids.append(text_id(doc_id, key))
            keys.append(key)
            sizes.append(len(ws))
            long = len(ws) >= self.min_words
            lengths.append(len(ws) if long else 0)
            if long:
                flat += ws
        found = self.windows(word_hashes(flat), np.array(lengths, np.int64), ids)
        order = np.argsort(found[0], kind="stable")
        offsets = np.searchsorted(found[0][order], np.arange(len(rows) + 1)).astype(np.int32)
        lists = [
            pa.ListArray.from_arrays(offsets, pa.array(c[order].astype(kind)))
            for c, kind in zip(found[1:], (np.int64, np.int32, np.int32, np.int64), strict=True)
        ]
        columns = [[r[0] for r in rows], ids, sizes, keys]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _SKETCH, strict=False)]
        return pa.RecordBatch.from_arrays([*arrays, *lists], schema=_SKETCH)

    def windows(self, hashes: np.ndarray, lengths: np.ndarray, ids: list[int]) -> list[np.ndarray]:
        """Row, bucket, centre, reach and runs of all windows of texts that lie end to end."""
        if not len(hashes):
            return [np.empty(0, np.int64) for _ in range(5)]
        shingles = shingle_hashes(hashes, self.shingle)
        first = np.cumsum(lengths) - lengths
        last = first + lengths - self.shingle
        rows = np.repeat(np.arange(len(lengths)), lengths)[: len(shingles)]
        place = np.arange(len(shingles))
        starts = np.flatnonzero(place + self.width - 1 <= last[rows])
        runs = self.run_hashes(shingles)
        alone = mix(np.array(ids, np.int64).view(np.uint64))
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        for k in range(self.hashes):
            values = mix(shingles ^ _SEEDS[k])
            lefts, centres, rights = compact_windows(
                values, self.width, starts, rows, (first, last)
            )
            row = rows[centres]
            packed = np.zeros(len(centres), np.uint64)
            for i, start in enumerate((1 - self.run, 0)):
                at = centres + start
                whole = (at >= first[row]) & (at + self.run - 1 <= last[row])
                # A run that the end of the text cuts off agrees with no other.
                none = mix(alone[row] + centres.astype(np.uint64) + np.uint64(i))
                run = np.where(whole, runs[np.clip(at, 0, len(runs) - 1)], none)
                packed = packed << np.uint64(32) | run >> np.uint64(32)
            reach = (k << 20) | ((centres - lefts) << 10) | (rights - centres)
            parts = (
                row,
                mix(values[centres] + np.uint64(k)).view(np.int64),
                centres - first[row],
                reach,
                packed.view(np.int64),
            )
            for part, to in zip(parts, out, strict=True):
                to.append(part)
        return [np.concatenate(c) for c in out]

    def run_hashes(self, shingles: np.ndarray) -> np.ndarray:
        """Hash of the run that starts at each place, put together from halves."""
        n = len(shingles) - self.run + 1
        out, done, part, span = np.zeros(n, np.uint64), 0, shingles, 1
        while True:
            if self.run & span:
                out = mix(out + part[done : done + n])
                done += span
            span *= 2
            if span > self.run:
                return out
            part = mix(part[: -(span // 2)] * _SEEDS[0] + part[span // 2 :])


def reach_of(centre: int, reach: int) -> tuple[int, int]:
    """First and last place of a window."""
    return centre - (reach >> 10 & 1023), centre + (reach & 1023)


class Chains(Passages):
    """Interval join of two texts' windows: a row for each part in which windows with the
    same least hash follow each other.

    Two such pairs of windows support one passage if, in both texts, some run of the least
    width lies in both windows and has both centres. Pairs of one hash or several that do
    are one part, as far as their windows reach.
    """

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for text, doc_id, hub, hub_doc, seeds in rows:
            pairs = sorted(
                {
                    (s["centre"], *reach_of(s["centre"], s["reach"]),
                     s["hub_centre"], *reach_of(s["hub_centre"], s["hub_reach"]),
                     s["reach"] >> 20)
                    for s in seeds
                }
            )
            for x, y, shift, hashes in self.parts(pairs):
                yield text, doc_id, hub, hub_doc, *x, *y, x[0] + shift - y[0], hashes

    def joined(self, a: tuple, b: tuple) -> bool:
        for at in (0, 3):
            low, high = max(a[at + 1], b[at + 1]), min(a[at + 2], b[at + 2])
            if min(a[at], b[at]) < low or max(a[at], b[at]) > high or high - low + 1 < self.width:
                return False
        return True

    def parts(self, pairs: list[tuple]) -> Iterator[tuple]:
        up = list(range(len(pairs)))

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        # In the order of centres only the next few can reach a window.
        for i, a in enumerate(pairs):
            for j in range(i + 1, len(pairs)):
                if pairs[j][0] > a[2]:
                    break
                if find(i) != find(j) and self.joined(a, pairs[j]):
                    up[find(j)] = find(i)
        parts: dict[int, list[tuple]] = {}
        for i, p in enumerate(pairs):
            parts.setdefault(find(i), []).append(p)
        for members in parts.values():
            x = min(m[1] for m in members), max(m[2] for m in members)
            y = min(m[4] for m in members), max(m[5] for m in members)
            # Most windows stand as far apart as the passages do.
            shifts = sorted(m[3] - m[0] for m in members)
            yield x, y, shifts[len(shifts) // 2], len({m[6] for m in members})


class Blobs(Passages):
    """The shingles of a text from one place to another, as bytes of 32 bits each."""

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, raw, wanted in rows:
            ws = words(raw)
            own = text_id(doc_id, text_key(ws))
            for w in wanted:
                if w["text_id"] == own:
                    some = ws[w["low"] : w["high"] + self.shingle]
                    blob = shingle_hashes(word_hashes(some), self.shingle).astype(np.uint32)
                    yield own, doc_id, w["low"], blob.tobytes()


def _before(values: np.ndarray) -> np.ndarray:
    """The last earlier place of each value, or -1."""
    order = np.argsort(values, kind="stable")
    again = values[order[1:]] == values[order[:-1]]
    before = np.full(len(values), -1)
    before[order[1:][again]] = order[:-1][again]
    return before


def first_in_run(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` values, which of them occur in it for the first time."""
    runs = sliding_window_view(_before(values), width)
    return runs < np.arange(len(runs))[:, None]


def _rows_of(marks: np.ndarray) -> list[list[int]]:
    """Start and past-the-end of each row of marks."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    return edges.reshape(-1, 2).tolist()


def mark(done: np.ndarray, first: int, spans: list[dict]) -> None:
    """Set what passages cover of the places from `first` on."""
    for s in spans:
        done[max(0, s["first"] - first) : max(0, s["last"] + 1 - first)] = True


class Verify(Passages):
    """Passages of one part of a text that are similar to some of another's."""

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for text, doc_id, hub_doc, first, shift, x, y, spans in rows:
            x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
            done = None
            if spans:
                done = np.zeros(len(x), bool)
                mark(done, first, spans)
            for a, b in self.spans(x, y, shift, done):
                yield text, doc_id, first + a, first + b, hub_doc

    def promising(self, shared: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """Runs of which others have so many of the distinct shingles that some may be
        similar."""
        both = (sliding_window_view(shared, self.width) & fresh).sum(axis=1)
        return 100 * both >= self.percent * fresh.sum(axis=1)

    def aligned(self, x: np.ndarray, y: np.ndarray, shift: int) -> list[tuple[int, int]]:
        """Passages of `x` that are similar to what stands `shift` places on in `y`."""
        w, low, high = self.width, max(0, -shift), min(len(x), len(y) - shift)
        if high - low < w:
            return []
        same = x[low:high] == y[low + shift : high + shift]
        if same.all():
            return [(low, high - 1)]
        sums = np.concatenate(([0], np.cumsum(same)))
        enough = sums[w:] - sums[:-w] >= self.least
        if not enough.any() or len(np.unique(x)) < len(x):
            return []
        found = []
        for start, past in _rows_of(enough):
            inside = np.flatnonzero(same[start : past - 1 + w])
            found.append((low + start + int(inside[0]), low + start + int(inside[-1])))
        return found

    def spans(
        self, x: np.ndarray, y: np.ndarray, shift: int = 0, done: np.ndarray | None = None
    ) -> list[tuple[int, int]]:
        """First and last shingle of each passage of `x` that is similar to one of `y`.

        First what is similar place by place. Then, if `y` has more of `x`: runs of the
        least width with enough of what `y` has, wherever it stands there, follow each
        other; of each such row the first and last that are similar to a run of `y` bound a
        passage. Runs of which `y` has nothing beyond what is `done` are left out.
        """
        w = self.width
        if len(x) < w or len(y) < w:
            return []
        found = self.aligned(x, y, shift)
        if found == [(0, len(x) - 1)]:
            return found
        shared = np.isin(x, y)
        more = shared.copy()
        for a, b in found:
            more[a : b + 1] = False
        if done is not None:
            more &= ~done
        if not more.any():
            return found
        plain = len(np.unique(x)) == len(x)
        both_plain = plain and len(np.unique(y)) == len(y)
        if plain:
            # Every run has `w` distinct shingles.
            sizes = np.full(len(x) - w + 1, w)
            sums = np.concatenate(([0], np.cumsum(shared)))
            both = sums[w:] - sums[:-w]
            enough = both >= self.least if both_plain else 100 * both >= self.percent * w
        else:
            fresh = first_in_run(x, w)
            sizes, enough = fresh.sum(axis=1), self.promising(shared, fresh)
        sums = np.concatenate(([0], np.cumsum(more)))
        enough &= sums[w:] > sums[:-w]
        if not enough.any():
            return found
        order = np.argsort(x, kind="stable")
        low = np.searchsorted(x, y, "left", sorter=order)
        high = np.searchsorted(x, y, "right", sorter=order)
        if both_plain:
            # Where each of `y` stands in `x`; each run of both has `w` distinct shingles.
            place = np.where(low < high, np.append(order, -1)[low], -1)

            def similar(i: int) -> bool:
                sums = np.concatenate(([0], np.cumsum((place >= i) & (place < i + w))))
                both = int((sums[w:] - sums[:-w]).max())
                return 100 * both >= self.percent * (2 * w - both)

        else:
            # Places in `x` in the order of their values; those of a value have one number.
            ordered = x[order]
            numbers = np.searchsorted(ordered, ordered) * len(x) + order
            wanted, past_all = low * len(x), np.append(order, len(x))
            # Place p of `y` counts in the runs that start from `since[p]` to p: before
            # that, an earlier place has its shingle or the run does not reach it.
            places = np.arange(len(y))
            since = np.maximum(_before(y) + 1, np.maximum(places - w + 1, 0))

            def distinct(has: np.ndarray) -> np.ndarray:
                n = len(y) + 1
                opened = np.bincount(since[has], minlength=n)
                return np.cumsum(opened - np.bincount(places[has] + 1, minlength=n))[: n - w]

            other_sizes = distinct(np.ones(len(y), bool))

            def similar(i: int) -> bool:
                at = np.searchsorted(numbers, wanted + i)
                both = distinct((at < high) & (past_all[at] < i + w))
                return bool((100 * both >= self.percent * (sizes[i] + other_sizes - both)).any())

        for start, past in _rows_of(enough):
            one = next((i for i in range(start, past) if similar(i)), None)
            if one is None:
                continue
            two = next(i for i in range(past - 1, one - 1, -1) if similar(i))
            inside = np.flatnonzero(shared[one : two + w])
            found.append((one + int(inside[0]), one + int(inside[-1])))
        return found


class Contexts(Passages):
    """The shingles of all windows of a text, with their places."""

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for text, doc_id, low, blob, windows in rows:
            shingles = np.frombuffer(blob, np.int32)
            inside = np.zeros(len(shingles) + 1, np.int64)
            for w in windows:
                a, b = reach_of(w["centre"], w["reach"])
                inside[a - low] += 1
                inside[b + 1 - low] -= 1
            places = np.flatnonzero(np.cumsum(inside)[:-1])
            yield text, doc_id, (places + low).tolist(), shingles[places].tolist()


class Hopeful(Verify):
    """Windows with a run around the centre of which earlier documents have enough, some of
    it in no passage found yet."""

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        w = self.width
        for text, low, blob, windows, shared, spans in rows:
            shingles = np.frombuffer(blob, np.uint32)
            has = np.zeros(len(shingles), bool)
            has[np.array(shared, np.int64) - low] = True
            wanted = has.copy()
            for s in spans or ():
                wanted[s["first"] - low : s["last"] + 1 - low] = False
            if not wanted.any():
                continue
            new = sliding_window_view(wanted, w).any(axis=1)
            enough = self.promising(has, first_in_run(shingles, w)) & new
            for centre, reach in {(x["centre"], x["reach"]) for x in windows}:
                a, b = reach_of(centre, reach)
                a, b = max(a, centre - w + 1) - low, min(centre, b - w + 1) - low
                if enough[a : b + 1].any():
                    yield text, centre, reach


class Rest(Verify):
    """Windows of one block of a bucket against those of others, of earlier documents. What
    one block has settled need not be looked for in the next."""

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        last = None
        for key, block, left, right in rows:
            if last != (key, block):
                last, settled = (key, block), [self.settled(m) for m in left]
            right.sort(key=lambda m: m["doc_id"])
            others = [np.frombuffer(m["context"], np.uint32) for m in right]
            docs = np.array([m["doc_id"] for m in right])
            flat = np.concatenate(others)
            order = np.argsort(flat, kind="stable")
            owner = np.repeat(np.arange(len(others)), [len(o) for o in others])[order]
            flat = flat[order]
            plain = np.array([len(np.unique(o)) == len(o) for o in others])
            for m, done in zip(left, settled, strict=True):
                x = np.frombuffer(m["context"], np.uint32)
                earlier = int(np.searchsorted(docs, m["doc_id"]))
                has = self.shared_by(x, flat, owner, earlier, done, plain.all())
                if has is None:
                    continue
                for j, span in self.new_spans(x, m["before"], has, plain, others, right, done):
                    for first in m["firsts"]:
                        a, b = (first + p for p in span)
                        yield m["text_id"], m["doc_id"], a, b, right[j]["doc_id"]

    def settled(self, m: dict) -> np.ndarray:
        """What passages cover of a window at each of its places."""
        done = np.ones(len(m["context"]) // 4, bool)
        for first in m["firsts"]:
            own = np.zeros(len(done), bool)
            mark(own, first, m["spans"] or ())
            done &= own
        return done

    def shared_by(
        self,
        x: np.ndarray,
        flat: np.ndarray,
        owner: np.ndarray,
        earlier: int,
        done: np.ndarray,
        plain: bool,
    ) -> np.ndarray | None:
        """Which of `x` each of the first `earlier` others has; nothing if all of them
        together have too little, or nothing beyond what is done."""
        low = np.searchsorted(flat, x, "left")
        # Of equal values the first is that of the smallest owner.
        some = np.append(flat, 0)[low] == x
        some &= np.append(owner, earlier)[low] < earlier
        if len(x) < self.width or not (some & ~done).any():
            return None
        fresh = first_in_run(x, self.width)
        enough = self.enough(some[None], fresh, np.array([plain]))
        if not (enough & (self.in_runs((some & ~done)[None]) > 0)).any():
            return None
        counts = np.where(some, np.searchsorted(flat, x, "right") - low, 0)
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) + np.repeat(low - ends + counts, counts)
        has = np.zeros((int(owner.max()) + 1, len(x)), bool)
        has[owner[at], np.repeat(np.arange(len(x)), counts)] = True
        return has[:earlier]

    def enough(self, has: np.ndarray, fresh: np.ndarray, plain: np.ndarray) -> np.ndarray:
        """For each row, the runs with as many of the distinct shingles as similar ones
        share at least; `plain` others repeat none, so that their runs have `width`."""
        if fresh.all():
            need = np.where(plain, self.least, -(-self.percent * self.width // 100))
            return self.in_runs(has) >= need[:, None]
        both = (sliding_window_view(has, self.width, axis=1) & fresh).sum(axis=2)
        return 100 * both >= self.percent * fresh.sum(axis=1)

    def new_spans(
        self,
        x: np.ndarray,
        before: int,
        has: np.ndarray,
        plain: np.ndarray,
        others: list[np.ndarray],
        right: list[dict],
        done: np.ndarray,
    ) -> Iterator[tuple[int, tuple[int, int]]]:
        """Passages of `x` like some of the others, one after the other, as long as the next
        has more than those before."""
        enough = self.enough(has, first_in_run(x, self.width), plain[: len(has)])
        j = -1
        while True:
            rows = np.flatnonzero(enough[j + 1 :].any(axis=1)) + j + 1
            new = (enough[rows] & (self.in_runs(has[rows] & ~done) > 0)).any(axis=1)
            again = False
            for j in rows[new].tolist():
                for a, b in self.spans(x, others[j], right[j]["before"] - before, done):
                    again |= not done[a : b + 1].all()
                    done[a : b + 1] = True
                    yield j, (a, b)
                if again:
                    break
            if not again:
                return

    def in_runs(self, marks: np.ndarray) -> np.ndarray:
        """Marks in each run of the least width, row by row."""
        sums = np.zeros((len(marks), marks.shape[1] + 1), np.int32)
        np.cumsum(marks, axis=1, out=sums[:, 1:])
        return sums[:, self.width :] - sums[:, : -self.width]


class Merge:
    """Spans of a text, joined where they overlap, in words."""

    def __init__(self, shingle: int):
        self.shingle = shingle

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for text, doc_id, spans in rows:
            start, end, other = None, None, None
            for s in sorted(spans, key=lambda s: (s["first"], s["last"])):
                if start is not None and s["first"] <= end + self.shingle:
                    end = max(end, s["last"])
                    other = min(other, s["other"])
                    continue
                if start is not None:
                    yield doc_id, text, start, end + self.shingle - start, other
                start, end, other = s["first"], s["last"], s["other"]
            if start is not None:
                yield doc_id, text, start, end + self.shingle - start, other


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 50,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    hashes: int = HASHES,
) -> DataFrame:
    """Passages of `min_words` words or more that an earlier document has too, nearly or
    exactly: `doc_id`, `text_id`, `start_word`, `n_words`, `match_id`.

    Earlier is the smaller id; the first document that has a passage has no row for it.
    Passages are similar when their distinct shingles have a Jaccard similarity of
    `percent` or more (words lower-cased A-Z, white space as one). Overlapping passages
    are one row; `match_id` is an earlier document that has one of them, the smallest of
    those it was compared with. Words at either end that only this document has are left
    out, so a nearly equal passage may be a few words shorter.
    Copies within one document are not repeats. Null, empty and short texts have no
    rows, and rows with a null id are left out. Rows of one id with different texts are
    looked at one by one, and `text_id`, a number of id and words, tells them apart; they
    are not compared with each other. Other columns are not read.

    1. Texts with the same words are one class; all but its first document are repeats
       as a whole.
    2. A few hash functions cut every text into compact windows. Windows of different
       documents with the same least hash meet in a bucket if a run of words that ends or
       starts at the centre agrees as well. Passages without a difference have such runs
       for every function, similar ones for most.
    3. A window is paired with that of the first document of its bucket, so a hot bucket
       gives a pair for each window and no more. The windows of two texts are joined by
       intervals, and the parts where they follow each other are compared: first those of
       one hash function, then those of all where that has left something.
    4. Windows with shingles that earlier documents have, but no passage found covers, go
       on if they have enough of them: first with the next few documents of the bucket, in
       rounds that leave fewer and fewer where many copies differ here and there. What the
       last round leaves is compared with all earlier documents of its bucket, in pairs of
       blocks of bounded size. There, shingles are counted for a whole block at a time, and
       two windows are compared in full only if one has something that is not yet found.

    Staged tables are deleted once nothing reads them any more.
    """
    settings = (min_words, shingle, percent, hashes)
    source = id_and_bytes(docs, id_col, text_col).where("doc_id is not null")
    texts = staged(
        source.mapInArrow(Sketch(*settings), from_arrow_schema(_SKETCH)), "windows"
    )
    keys = texts.where(F.col("n_words") >= min_words).select(
        "doc_id", "text_id", "n_words", "text_key"
    )
    classes = keys.groupBy("text_key").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )
    classes = staged(classes.where("first_id < last_id").drop("last_id"), "classes")
    copies = staged(
        keys.join(classes, "text_key").where("doc_id > first_id").dropDuplicates(["text_id"]),
        "copies",
    )
    members = _members(texts, copies)
    discard(texts, classes)
    spans = _spans(source, members, settings)
    merged = per_row(
        spans.groupBy("text_id", "doc_id").agg(
            F.collect_set(F.struct("first", "last", "other")).alias("spans")
        ),
        "doc_id bigint, text_id bigint, start_word int, n_words int, match_id bigint",
        Merge(shingle),
    )
    whole = copies.select(
        "doc_id",
        "text_id",
        F.lit(0).alias("start_word"),
        "n_words",
        F.col("first_id").alias("match_id"),
    )
    return merged.unionByName(whole)


def _met(rows: DataFrame, by: str) -> DataFrame:
    """Keys that more than one document has."""
    found = rows.groupBy(by).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    return found.where("low < high").select(by)


def _members(texts: DataFrame, copies: DataFrame) -> DataFrame:
    """Windows that meet those of other documents, once for each run that agrees: `key`,
    `doc_id`, `text_id`, `centre`, `reach`."""
    windows = texts.select(
        "doc_id",
        "text_id",
        F.explode(F.arrays_zip("buckets", "centres", "reaches", "runs")).alias("w"),
    ).select(
        F.col("w.buckets").alias("bucket"),
        "doc_id",
        "text_id",
        F.col("w.centres").alias("centre"),
        F.col("w.reaches").alias("reach"),
        F.col("w.runs").alias("runs"),
    )
    # The first step keeps a small share; the next ones read it again. A filter of fixed
    # size spares most windows that meet no other the shuffle.
    met = staged(_met(windows, "bucket"), "met")
    meeting = staged(
        perhaps_in(windows, "bucket", met)
        .join(met, "bucket", "left_semi")
        .join(copies.select("text_id"), "text_id", "left_anti"),
        "meeting",
    )
    run = F.explode(
        F.array(
            F.xxhash64("bucket", F.lit(0), F.shiftrightunsigned("runs", 32)),
            F.xxhash64("bucket", F.lit(1), F.expr("runs & 4294967295")),
        )
    )
    each = meeting.select(run.alias("key"), "doc_id", "text_id", "centre", "reach")
    members = staged(each.join(_met(each, "key"), "key", "left_semi"), "members")
    discard(met, meeting)
    return members


def _blobs(source: DataFrame, members: DataFrame, settings: tuple) -> DataFrame:
    """`text_id`, `low` and the shingles from there, of every text with members."""
    left, right = F.expr("shiftright(reach, 10) & 1023"), F.expr("reach & 1023")
    ranges = members.groupBy("doc_id", "text_id").agg(
        F.min(F.col("centre") - left).alias("low"), F.max(F.col("centre") + right).alias("high")
    )
    wanted = staged(
        ranges.groupBy("doc_id").agg(
            F.collect_list(F.struct("text_id", "low", "high")).alias("wanted")
        ),
        "wanted",
    )
    found = per_row(
        perhaps_in(source, "doc_id", wanted).join(wanted, "doc_id"),
        "text_id bigint, doc_id bigint, low int, blob binary",
        Blobs(*settings),
        step=32,
    )
    # Repeated rows have the same blob.
    blobs = staged(found.dropDuplicates(["text_id"]).drop("doc_id"), "shingles")
    discard(wanted)
    return blobs


def _part(blob: Column, low: Column, first: Column, last: Column) -> Column:
    """The shingles from `first` to `last` of those that start at `low`."""
    return F.substring(blob, (first - low) * 4 + 1, (last - first + 1) * 4)


def _spans(source: DataFrame, members: DataFrame, settings: tuple) -> DataFrame:
    """`text_id`, `doc_id`, `first`, `last` (shingles) and `other` of the copies found."""
    blobs = _blobs(source, members, settings)
    ordered = staged(_ordered(members), "ordered")
    # One hash function finds every passage without a difference; the windows of the others
    # are compared where it has left something.
    first_hash = F.shiftright("reach", 20) == 0
    hubs = ordered.where("rank = 1").select("key", "hub")
    chains = _chains(members.where(first_hash), hubs, settings)
    spans = staged(_verified(chains, blobs, settings), "spans")
    discard(chains)
    # Windows of the first hash function have met the first document of their bucket.
    left = _beyond(members.where(first_hash), ordered, 1).unionByName(
        _beyond(members.where(~first_hash), ordered, 0)
    )
    left = staged(_uncovered(left, spans), "left")
    shared = staged(_shared(members, left, blobs, settings), "shared")
    before = 0
    for most in ROUNDS:
        open_ = staged(_hopeful(left, shared, blobs, spans, settings), "open")
        discard(left)
        if open_.isEmpty():
            break
        hubs = ordered.where(F.col("rank").between(before + 1, most)).select("key", "hub")
        chains = _chains(open_, hubs, settings)
        spans = spans.unionByName(staged(_verified(chains, blobs, settings, spans), "spans"))
        left = staged(_uncovered(_beyond(open_, ordered, most), spans), "left")
        discard(chains, open_)
        before = most
    else:
        open_ = staged(_hopeful(left, shared, blobs, spans, settings), "open")
        discard(left)
        spans = spans.unionByName(_rest(members, open_, blobs, spans, settings))
    discard(blobs, ordered, members, shared, open_)
    return spans


def _beyond(windows: DataFrame, ordered: DataFrame, tried: int) -> DataFrame:
    """The windows with an earlier document in their bucket beyond the first `tried`."""
    next_ = ordered.where(F.col("rank") == tried + 1).select(
        "key", F.col("doc_id").alias("next_doc")
    )
    return (
        windows.join(next_, "key").where("doc_id > next_doc").select(windows.columns)
    )


def _uncovered(windows: DataFrame, spans: DataFrame) -> DataFrame:
    """The windows that do not lie in one passage found."""
    low, high = F.expr("centre - (shiftright(reach, 10) & 1023)"), F.expr("centre + (reach & 1023)")
    inside = F.exists("spans", lambda s: (s["first"] <= low) & (s["last"] >= high))
    return (
        windows.join(_held(spans), "text_id", "left")
        .where(F.col("spans").isNull() | ~inside)
        .select(windows.columns)
    )


def _ordered(members: DataFrame) -> DataFrame:
    """The first documents of each bucket, as many as the rounds need and one more, each
    with the first of its windows there: `key`, `doc_id`, `hub`, `rank`."""
    hub = F.struct("doc_id", "text_id", "centre", "reach")
    by_doc = members.groupBy("key", "doc_id").agg(F.min(hub).alias("hub"))
    order = Window.partitionBy("key").orderBy("doc_id")
    ranked = by_doc.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= ROUNDS[-1] + 1)


def _chains(open_: DataFrame, hubs: DataFrame, settings: tuple) -> DataFrame:
    """Parts of two texts whose windows follow each other."""
    seed = F.struct(
        "centre",
        "reach",
        F.col("hub.centre").alias("hub_centre"),
        F.col("hub.reach").alias("hub_reach"),
    )
    pairs = (
        open_.join(hubs, "key")
        .where(F.col("doc_id") > F.col("hub.doc_id"))
        .groupBy("text_id", "doc_id", F.col("hub.text_id").alias("hub_id"))
        .agg(F.first("hub.doc_id").alias("hub_doc"), F.collect_set(seed).alias("seeds"))
    )
    return staged(
        per_row(
            pairs.select("text_id", "doc_id", "hub_id", "hub_doc", "seeds"),
            "text_id bigint, doc_id bigint, hub_id bigint, hub_doc bigint, first int, last int, "
            "hub_first int, hub_last int, shift int, n_hashes int",
            Chains(*settings),
        ),
        "chains",
    )


def _held(spans: DataFrame) -> DataFrame:
    """The passages found of each text."""
    return spans.groupBy("text_id").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def _verified(
    chains: DataFrame, blobs: DataFrame, settings: tuple, spans: DataFrame | None = None
) -> DataFrame:
    """What of the chains are passages; those that can only tell what `spans` do are left out."""
    own = blobs.select("text_id", F.col("low").alias("own_low"), F.col("blob").alias("own"))
    other = blobs.select(
        F.col("text_id").alias("hub_id"), F.col("low").alias("hub_low"), F.col("blob").alias("hub")
    )
    col = F.col
    rows = (
        chains.join(own, "text_id")
        .withColumn("x", _part(col("own"), col("own_low"), col("first"), col("last")))
        .drop("own", "own_low")
        .join(other, "hub_id")
        .withColumn("y", _part(col("hub"), col("hub_low"), col("hub_first"), col("hub_last")))
        .select("text_id", "doc_id", "hub_doc", "first", "shift", "x", "y")
    )
    if spans is None:
        rows = rows.withColumn("spans", F.lit(None).cast("array<struct<first:int,last:int>>"))
    else:
        rows = rows.join(_held(spans), "text_id", "left")
        rows = rows.select(
            "text_id", "doc_id", "hub_doc", "first", "shift", "x", "y", "spans"
        )
    return per_row(
        rows,
        "text_id bigint, doc_id bigint, first int, last int, other bigint",
        Verify(*settings),
    )


def _shared(
    members: DataFrame, open_: DataFrame, blobs: DataFrame, settings: tuple
) -> DataFrame:
    """Of each text with windows left, the places of shingles that an earlier document of
    these buckets has: `text_id`, `shared`."""
    asked = members.join(open_.select("key").distinct(), "key", "left_semi")
    windows = F.collect_set(F.struct("centre", "reach")).alias("windows")
    texts = asked.groupBy("text_id", "doc_id").agg(windows).join(blobs, "text_id")
    contexts = staged(
        per_row(
            texts.select("text_id", "doc_id", "low", "blob", "windows"),
            "text_id bigint, doc_id bigint, places array<int>, shingles array<int>",
            Contexts(*settings),
            step=64,
        ),
        "contexts",
    )
    each = contexts.select(
        "text_id", "doc_id", F.explode(F.arrays_zip("places", "shingles")).alias("s")
    ).select("text_id", "doc_id", F.col("s.places").alias("at"), F.col("s.shingles").alias("shingle"))
    counted = each.groupBy("shingle").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most")
    )
    earlier = counted.where("least < most").select("shingle", "least")
    return (
        each.join(open_.select("text_id").distinct(), "text_id", "left_semi")
        .join(earlier, "shingle")
        .where("least < doc_id")
        .groupBy("text_id")
        .agg(F.collect_set("at").alias("shared"))
    )


def _hopeful(
    left: DataFrame, shared: DataFrame, blobs: DataFrame, spans: DataFrame, settings: tuple
) -> DataFrame:
    """The windows that can be in a further passage at all: of some run around the centre,
    earlier documents of the buckets have as many distinct shingles as similar runs share,
    and some of these are in no passage found.

    What many texts share but is no passage, like a line or a short quotation, ends here,
    by counting shingles and comparing no two texts.
    """
    windows = F.collect_set(F.struct("centre", "reach")).alias("windows")
    mine = left.groupBy("text_id").agg(windows)
    held = _held(spans.join(mine.select("text_id"), "text_id", "left_semi"))
    hopeful = per_row(
        mine.join(shared, "text_id")
        .join(blobs, "text_id")
        .join(held, "text_id", "left")
        .select("text_id", "low", "blob", "windows", "shared", "spans"),
        "text_id bigint, centre int, reach int",
        Hopeful(*settings),
        step=64,
    )
    return left.join(hopeful, ["text_id", "centre", "reach"], "left_semi").select(left.columns)


def _rest(
    members: DataFrame, open_: DataFrame, blobs: DataFrame, spans: DataFrame, settings: tuple
) -> DataFrame:
    """What no round has covered, compared with all earlier documents of its bucket."""
    left, right = F.expr("shiftright(reach, 10) & 1023"), F.expr("reach & 1023")

    def in_blocks(rows: DataFrame, name: str, more: tuple = ()) -> DataFrame:
        sizes = rows.groupBy("key").agg(F.count("*").alias("n"))
        first = F.col("centre") - left
        context = _part(F.col("blob"), F.col("low"), first, F.col("centre") + right)
        member = F.struct("text_id", "doc_id", "before", "firsts", "context", *more)
        # Where a text repeats itself, equal contexts are one with several places.
        contexts = (
            rows.join(blobs, "text_id")
            .select(
                "key",
                "text_id",
                "doc_id",
                left.alias("before"),
                first.alias("first"),
                context.alias("context"),
            )
            .groupBy("key", "text_id", "doc_id", "before", "context")
            .agg(F.collect_list("first").alias("firsts"))
        )
        if more:
            contexts = contexts.join(_held(spans), "text_id", "left")
        block = F.expr(f"pmod(xxhash64(text_id, context), cast(ceil(n / {BLOCK}) as int))")
        return staged(
            contexts.join(sizes, "key")
            .withColumn("block", block)
            .groupBy("key", "block")
            .agg(F.collect_list(member).alias(name)),
            name,
        )

    wanted = members.join(open_.select("key").distinct(), "key", "left_semi")
    pairs = in_blocks(open_, "asking", ("spans",)).join(
        in_blocks(wanted, "asked").withColumnRenamed("block", "other"), "key"
    )
    # A stated number: the work is in comparing, which few bytes can be much of.
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = (
        pairs.repartition(tasks, "key", "block", F.expr(f"other div {STRIPE}"))
        .sortWithinPartitions("key", "block", "other")
        .select("key", "block", "asking", "asked")
    )
    return per_row(
        pairs,
        "text_id bigint, doc_id bigint, first int, last int, other bigint",
        Rest(*settings),
        step=2,
    )


class Cut:
    """Texts without the words of the spans; what stands before a span is kept as it is."""

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, raw, spans in rows:
            own = text_id(doc_id, text_key(words(raw)))
            spans = [s for s in spans if s["text_id"] == own]
            if not spans:
                continue
            places = [(m.start(), m.end()) for m in _WORD.finditer(raw or b"")]
            parts, at, left = [], 0, len(places)
            for s in sorted(spans, key=lambda s: s["start_word"]):
                first, past = s["start_word"], s["start_word"] + s["n_words"]
                parts.append(raw[at : places[first][0]])
                at = places[past][0] if past < len(places) else len(raw)
                left -= s["n_words"]
            parts.append((raw or b"")[at:])
            yield doc_id, b"".join(parts).decode("utf-8", "replace"), left


def without_passages(
    docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id` and `text` of the documents that have repeated passages, without these,
    and `words_left`."""
    spans = passages.groupBy("doc_id").agg(
        F.collect_list(F.struct("text_id", "start_word", "n_words")).alias("spans")
    )
    spans = staged(spans, "cuts")
    rows = perhaps_in(id_and_bytes(docs, id_col, text_col), "doc_id", spans)
    rows = rows.join(spans, "doc_id")
    return per_row(rows, "doc_id bigint, text string, words_left int", Cut(), step=64)
