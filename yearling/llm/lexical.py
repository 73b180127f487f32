"""Ranked lexical search: best-first over document intervals, bounded by range maxima."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearling.llm.text import per_row
from yearling.sources.staging import staged

#: Bytes of distinct query terms that are searched at a time; more items take more passes.
QUERY_BYTES = 8 << 20

#: Postings of a shard, which one task holds with its tables of range maxima.
SHARD = 1 << 20

#: Interval ends times terms that are looked at together.
STEP = 1 << 18

#: Scale of a term's share of a score, in millionths of its weight.
_TF, _UNIT, _LENGTH = 1_000_000_000, 1000, 8

_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def terms(raw: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all non-ASCII characters; A-Z lower-cased."""
    return raw.translate(_TERM_BYTES).split() if raw else []


class ItemTerms:
    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for item_id, raw in rows:
            yield item_id, sorted({w.decode() for w in terms(raw)})


class Postings:
    """Term frequencies of the wanted terms, a row for each text that has one.

    A task's last rows count its texts (term -1), their terms (-2), and for each wanted
    term the texts that have it.
    """

    def __init__(self, vocabulary: list[str]):
        self.vocabulary = vocabulary

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        number = {w.encode(): i for i, w in enumerate(self.vocabulary)}
        holders = np.zeros(len(number), np.int64)
        n_texts = n_terms = 0
        for doc_id, raw in rows:
            found = terms(raw)
            if not found:
                continue
            n_texts += 1
            n_terms += len(found)
            counts = Counter(found)
            wanted = counts.keys() & number.keys()
            if wanted:
                ids = np.array([number[w] for w in wanted], np.int32)
                often = np.array([counts[w] for w in wanted], np.int32)
                holders[ids] += 1
                yield doc_id, len(found), ids.tobytes(), often.tobytes(), None, None
        for term, n in ((-1, n_texts), (-2, n_terms), *enumerate(holders.tolist())):
            if n:
                yield None, None, None, None, term, n


class Shard:
    """Posting lists of some texts, end to end, with tables of their range maxima.

    `keys` are term * size + place, ascending. `best[j][i]` is the position of the largest
    impact among the 2^j postings from position i; positions within one list stay within it.
    """

    def __init__(self, places, ids, impacts, size: int, step: int):
        self.step = step
        order = np.lexsort((places, ids))
        self.size = size
        self.keys = ids[order].astype(np.int64) * size + places[order]
        self.places = places[order]
        self.impacts = impacts[order]
        present, self.starts = np.unique(ids[order], return_index=True)
        self.rows = {int(t): i for i, t in enumerate(present)}
        self.ends = np.append(self.starts[1:], len(ids))
        longest = int((self.ends - self.starts).max(initial=1))
        level = np.arange(len(ids), dtype=np.int32)
        self.best = [level]
        for j in range(longest.bit_length() - 1):
            left, right = level[: -(1 << j)], level[1 << j :]
            level = np.where(self.impacts[right] > self.impacts[left], right, left)
            self.best.append(level)
        starts = np.cumsum([0, *(len(b) for b in self.best)])
        self.level_at, self.best = starts[:-1], np.concatenate(self.best)

    def positions(self, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
        """For each place and term, the first posting of the term at or behind the place."""
        keys = ids[None, :] * np.int64(self.size) + places[:, None]
        return np.searchsorted(self.keys, keys)

    def largest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Position of the largest impact from `low` to before `high`, -1 if there is none."""
        length = high - low
        some = length > 0
        j = np.frexp(np.where(some, length, 1).astype(np.float64))[1] - 1
        at = self.level_at[j]
        left = self.best[np.where(some, at + low, 0)]
        right = self.best[np.where(some, at + high - (1 << j), 0)]
        found = np.where(self.impacts[right] > self.impacts[left], right, left)
        return np.where(some, found, -1)

    def search(self, item: np.ndarray, weight: np.ndarray, doc_ids: np.ndarray, k: int):
        """The `k` best (score, doc_id) of an item's terms, equal scores by id.

        An interval of places is bounded by the sum of its terms' largest impacts. The
        intervals with the highest bounds are split at the text of their largest impact,
        whose score is then counted, until no bound reaches the k-th score found.
        """
        ids = np.array([t for t in item if t in self.rows], np.int64)
        if not len(ids):
            return []
        weights = weight[ids]
        step = max(1, self.step // len(ids))
        found: list[tuple[int, int]] = []
        least = 1
        low, high, bound, cut = self.bounded(
            ids, weights, np.zeros(1, np.int64), np.full(1, self.size)
        )
        while len(low):
            if len(low) > step:
                first = np.argpartition(-bound, step)
                first, rest = first[:step], first[step:]
            else:
                first, rest = np.arange(len(low)), np.arange(0)
            # Only the better half of the bounds at a time, so that the least score rises.
            if len(first) > 32:
                far = np.median(bound[first])
                rest = np.concatenate([rest, first[bound[first] < far]])
                first = first[bound[first] >= far]
            a, b, p = low[first], high[first], cut[first]
            low, high, bound, cut = low[rest], high[rest], bound[rest], cut[rest]
            scores = self.scores(ids, weights, p)
            good = scores >= least
            found += zip((-scores[good]).tolist(), doc_ids[p[good]].tolist(), strict=True)
            found = sorted(found, key=_placed)[:k]
            if len(found) == k:
                least = max(least, -found[-1][0])
            new = self.bounded(
                ids, weights, np.concatenate([a, p + 1]), np.concatenate([p, b])
            )
            low, high, bound, cut = (
                np.concatenate([x, y]) for x, y in zip((low, high, bound, cut), new, strict=True)
            )
            keep = bound >= least
            low, high, bound, cut = low[keep], high[keep], bound[keep], cut[keep]
        return [(-s, d) for s, d in found]

    def scores(self, ids, weights, places) -> np.ndarray:
        out = np.zeros(len(places), np.int64)
        step = max(1, self.step // len(ids))
        for i in range(0, len(places), step):
            some = places[i : i + step]
            at = np.minimum(self.positions(ids, some), len(self.keys) - 1)
            hit = self.keys[at] == ids[None, :] * np.int64(self.size) + some[:, None]
            out[i : i + len(some)] = np.where(hit, self.impacts[at], 0) @ weights
        return out

    def bounded(self, ids, weights, low, high):
        """The intervals that hold a posting, with bound and place to split at."""
        keep = low < high
        low, high = low[keep], high[keep]
        bounds, cuts = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        step = max(1, self.step // len(ids))
        for i in range(0, len(low), step):
            part = slice(i, i + step)
            best = self.largest(
                self.positions(ids, low[part]), self.positions(ids, high[part])
            )
            impact = np.where(best >= 0, self.impacts[best], 0) * weights
            bounds[part] = impact.sum(axis=1)
            top = impact.argmax(axis=1)
            cuts[part] = self.places[best[np.arange(len(top)), top]]
        keep = bounds > 0
        return low[keep], high[keep], bounds[keep], cuts[keep]


def _placed(hit: tuple) -> tuple:
    """Highest score first, equal ones by id, a null id last."""
    return hit[0], hit[1] is None, hit[1] or 0


class Search:
    """The best texts of every item within each shard of a task's postings."""

    def __init__(self, items: list[tuple], weight: list[int], totals: tuple[int, int], k: int):
        self.items, self.weight, self.totals, self.k = items, weight, totals, k
        self.shard, self.step = SHARD, STEP

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.array(self.weight, np.int64)
        items = [(item_id, np.frombuffer(ids, np.int32)) for item_id, ids in self.items]
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[2]) // 4
                if size >= self.shard:
                    yield self.found(held, items, weight)
                    held, size = [], 0
        if held:
            yield self.found(held, items, weight)
        pa.default_memory_pool().release_unused()

    def found(self, rows: list[tuple], items, weight) -> pa.RecordBatch:
        n_texts, n_terms = self.totals
        # Texts of like length have like impacts, which makes the bounds of intervals close.
        rows = sorted(rows, key=lambda r: r[1])
        doc_ids = np.array([r[0] for r in rows], object)
        ids = [np.frombuffer(r[2], np.int32) for r in rows]
        places = np.repeat(np.arange(len(rows)), [len(x) for x in ids])
        ids = np.concatenate(ids)
        often = np.frombuffer(b"".join(r[3] for r in rows), np.int32).astype(np.int64)
        length = np.array([r[1] for r in rows], np.int64)
        dampened = _LENGTH * (10 + (90 * length * n_texts) // n_terms)
        impacts = (_TF * often) // (_UNIT * often + dampened[places])
        shard = Shard(places, ids, impacts, len(rows), self.step)
        item_ids, scores, docs = [], [], []
        for item_id, wanted in items:
            best = shard.search(wanted, weight, doc_ids, self.k)
            item_ids += [item_id] * len(best)
            scores += [s for s, _ in best]
            docs += [d for _, d in best]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (item_ids, docs, scores)],
            names=["item_id", "doc_id", "score"],
        )


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The `k` best documents of every item: `item_id`, `rank` (from 1), `doc_id`, `score`.

    A term is a maximal run of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased; null and empty texts have none. With N documents that have a term, L their
    terms, n those of one document, df the documents that hold a term and tf its places in
    one, a score sums over the item's distinct terms w * (10^9 tf div (1000 tf + 8 m)),
    where w is floor(1000 ln((2N + 2) / (2 df + 1))) and m is 10 + 90 n N div L. Scores of 0
    are left out, and an item without any other has no row. Equal scores go by `doc_id`, a
    null one last. Rows of one document id are documents of their own; rows of one item id
    are one item with all their terms, and so are the rows without one. Other columns are
    not read.

    1. The items' distinct terms go to every task, `QUERY_BYTES` of them at a time (by the
       hash of the item id), and each such part is one pass over the documents.
    2. A pass keeps the wanted terms' counts of each text and counts df, N and L.
    3. A task makes posting lists of at most `SHARD` postings and a text, tables of their
       range maxima, and searches them for each item. Postings are never shuffled, so a
       term that all documents hold is no task's burden.
    4. The best of all shards are ranked.
    """
    source = items.select(
        F.col(item_col).cast("long").alias("item_id"),
        F.col(item_text_col).cast("binary").alias("raw"),
    )
    wanted = per_row(source, "item_id bigint, terms array<string>", ItemTerms())
    wanted = staged(
        wanted.select("item_id", F.explode("terms").alias("term")).distinct(), "items"
    )
    size = wanted.agg(F.sum(F.octet_length("term") + F.lit(8))).first()[0] or 0
    parts = max(1, -(-size // QUERY_BYTES))
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("raw")
    )
    found = None
    for part in range(parts):
        some = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        best = _best(texts, some, k)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("item_id").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id")
    )
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def _best(texts: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The best of each shard for the items whose (item_id, term) rows are given."""
    rows = wanted.groupBy("item_id").agg(F.sort_array(F.collect_list("term"))).collect()
    vocabulary = sorted({w for _, ws in rows for w in ws})
    number = {w: i for i, w in enumerate(vocabulary)}
    items = [(i, np.array([number[w] for w in ws], np.int32).tobytes()) for i, ws in rows]
    postings = staged(
        per_row(
            texts,
            "doc_id bigint, length long, ids binary, often binary, term int, n bigint",
            Postings(vocabulary),
        ),
        "postings",
    )
    counted = postings.where("term is not null").groupBy("term").agg(F.sum("n"))
    counts = dict(map(tuple, counted.collect()))
    n_texts, n_terms = counts.get(-1, 0), counts.get(-2, 0)
    weight = [
        math.floor(1000 * math.log((2 * n_texts + 2) / (2 * counts.get(i, 0) + 1)))
        for i in range(len(vocabulary))
    ]
    search = Search(items, weight, (n_texts, n_terms), k)
    lists = postings.where("term is null").select("doc_id", "length", "ids", "often")
    return lists.mapInArrow(search, "item_id bigint, doc_id bigint, score bigint")
