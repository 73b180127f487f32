"""Exact duplicates by an exchange of Golomb-coded fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearling.llm.filters import perhaps_in
from yearling.llm.text import id_and_bytes, lower_ascii, per_row
from yearling.sources.staging import staged

#: Bits of a fingerprint, the head of the text's SHA-256. Few bits make short codes;
#: a false meeting only makes a suspect, and suspects are compared byte by byte.
BITS = 48

LEDGER = (
    "part int, owner int, n int, code binary, ids array<bigint>, slots binary, "
    "again binary, digests binary"
)


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct non-negative integers as Rice-coded gaps.

    One byte holds the number of remainder bits, fitted to the mean gap; a gap is its
    quotient in unary, a zero, and its remainder.
    """
    if not len(values):
        return b""
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    width = max(0, int(gaps.mean() * 0.69 + 1).bit_length() - 1)
    quotients = gaps >> width
    starts = np.concatenate(([0], np.cumsum(quotients + 1 + width)))
    bits = np.zeros(starts[-1], np.uint8)
    ones = np.repeat(starts[:-1] - np.concatenate(([0], np.cumsum(quotients)[:-1])), quotients)
    bits[ones + np.arange(len(ones))] = 1
    after = starts[:-1] + quotients + 1
    for k in range(width):
        bits[after + k] = (gaps >> (width - 1 - k)) & 1
    return bytes([width]) + np.packbits(bits).tobytes()


def golomb_decode(code: bytes, n: int) -> np.ndarray:
    """The `n` integers of a code."""
    if not n:
        return np.empty(0, np.int64)
    width = code[0]
    bits = np.unpackbits(np.frombuffer(code, np.uint8, offset=1))
    zeros = np.flatnonzero(bits == 0)
    ends, at = np.empty(n, np.int64), 0
    starts = np.empty(n, np.int64)
    for i in range(n):
        starts[i] = at
        ends[i] = zeros[np.searchsorted(zeros, at)]
        at = ends[i] + 1 + width
    gaps = ends - starts
    for k in range(width):
        gaps = (gaps << 1) | bits[ends + 1 + k]
    return np.cumsum(gaps + 1) - 1


class Ledgers:
    """Per input partition: one row for each owner, with its sorted distinct fingerprints."""

    def __init__(self, owner_bits: int):
        self.owner_bits = owner_bits

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        ids, digests = [], []
        for doc_id, raw in rows:
            ids.append(doc_id)
            digests.append(hashlib.sha256((raw or b"").lower()).digest())
        if not ids:
            return
        part = TaskContext.get().partitionId()
        table = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
        heads = table[:, :8].copy().view(">u8").ravel().astype(np.uint64)
        prints = (heads >> np.uint64(64 - BITS)).astype(np.int64)
        order = np.argsort(prints, kind="stable")
        prints, table = prints[order], table[order]
        shift = BITS - self.owner_bits
        owners = prints >> shift
        cuts = np.flatnonzero(np.diff(owners, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = prints[a:b] & ((1 << shift) - 1)
            distinct, slots, counts = np.unique(own, return_inverse=True, return_counts=True)
            yield (
                part,
                int(owners[a]),
                len(distinct),
                golomb_encode(distinct),
                [ids[i] for i in order[a:b]],
                slots.astype("<u4").tobytes(),
                np.packbits(counts > 1).tobytes(),
                table[a:b].tobytes(),
            )


def _meet(frame: pd.DataFrame) -> pd.DataFrame:
    """An owner's answer: for each partition, a bit for every fingerprint others hold too."""
    sizes = frame["n"].to_numpy()
    if not len(sizes):
        return frame[["part", "owner"]].assign(met=[])
    values = np.concatenate(
        [golomb_decode(c, n) for c, n in zip(frame["code"], sizes, strict=True)]
    )
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    met = np.split(counts[inverse] > 1, np.cumsum(sizes)[:-1])
    return pd.DataFrame(
        {
            "part": frame["part"],
            "owner": frame["owner"],
            "met": [np.packbits(m).tobytes() for m in met],
        }
    )


def _unpack(rows: Iterator[tuple]) -> Iterator[tuple]:
    for n, ids, slots, again, digests, met in rows:
        marks = np.unpackbits(
            np.frombuffer(again, np.uint8) | np.frombuffer(met, np.uint8), count=n
        )
        suspect = marks[np.frombuffer(slots, "<u4")]
        for i, doc_id in enumerate(ids):
            yield doc_id, digests[32 * i : 32 * i + 32], bool(suspect[i])


def _sha(body: Column) -> Column:
    return F.unhex(F.sha2(body.cast("binary"), 256))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of `docs` with the group of its text: `doc_id`, `keep_id`, `group_size`,
    `kept`, `text_sha256`.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty.
    The row with the largest id stays. Repeated rows each count and each give a row; of
    rows that also share the staying id, all are marked kept. A null id never wins over
    another one; a group of null ids alone keeps null. Other columns are not read.

    Each input partition sorts the fingerprints of its texts and sends every owner (a
    range of fingerprints) the distinct ones as Golomb codes: a text that fills a whole
    partition travels as one. Owners answer with bitmaps. Only texts whose fingerprint
    met another one are shuffled, and grouping them by their bytes decides; equal ones
    are merged within each task before that. A filter of fixed size finds them.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    owner_bits = max(1, (tasks - 1).bit_length())
    ledger = staged(
        per_row(id_and_bytes(docs, id_col, text_col), LEDGER, Ledgers(owner_bits)), "ledger"
    )
    met = (
        ledger.select("part", "owner", "n", "code")
        .groupBy("owner")
        .applyInPandas(_meet, "part int, owner int, met binary")
    )
    rows = staged(
        per_row(
            ledger.join(met, ["part", "owner"]).select(
                "n", "ids", "slots", "again", "digests", "met"
            ),
            "doc_id bigint, sha binary, suspect boolean",
            _unpack,
        ),
        "fingerprints",
    )
    text = F.coalesce(lower_ascii(F.col(text_col)), F.lit(""))
    bodies = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("body"))
    texts = (
        perhaps_in(bodies.withColumn("sha", _sha(F.col("body"))), "sha", rows.where("suspect"))
        .groupBy("body")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
        .withColumn("sha", _sha(F.col("body")))
    )
    groups = (
        texts.groupBy("sha")
        .agg(F.max("keep_id").alias("keep_id"), F.max("n").alias("n"), F.count("*").alias("texts"))
        .select(
            "sha",
            "keep_id",
            F.when(F.col("texts") == 1, F.col("n"))
            .otherwise(F.raise_error(F.lit("different texts share a SHA-256")).cast("long"))
            .alias("n"),
        )
    )
    groups = staged(groups, "groups")
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.join(groups, "sha", "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
