"""Words, hashes and Arrow batches shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_C1 = np.uint64(0xFF51AFD7ED558CCD)
_C2 = np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, every other character as it is; null stays null.

    `lower` is much faster than `translate` and the same on ASCII text.
    """
    ascii_only = F.octet_length(column) == F.char_length(column)
    return F.when(ascii_only, F.lower(column)).otherwise(
        F.translate(column, UPPER, UPPER.lower())
    )


def words(raw: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space; `bytes` methods do just that."""
    return raw.lower().split() if raw else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _S33)) * _C1
    x = (x ^ (x >> _S33)) * _C2
    return x ^ (x >> _S33)


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words; a shorter text is one run of all its words."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(size, n)
    out = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        out = mix(out + hashes[k : n - width + 1 + k] + np.uint64(k + 1))
    return out


def per_row(
    df: DataFrame,
    schema: str,
    work: Callable[[Iterator[tuple]], Iterator[tuple]],
    step: int = 512,
) -> DataFrame:
    """Run `work` over the rows of a partition as tuples; its tuples become rows.

    Of an Arrow batch only `step` rows are Python objects at a time. Rows leave in
    batches of bounded count and size, so that long values do not pile up.
    """
    columns = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(RowWork(work, columns, step), schema)


class RowWork:
    """Arrow batches to tuples and back."""

    def __init__(self, work, schema: pa.Schema, step: int, rows: int = 4096, size: int = 8 << 20):
        self.work, self.schema, self.step, self.rows, self.size = work, schema, step, rows, size

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in self.work(tuples(batches, self.step)):
            held.append(row)
            size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if len(held) >= self.rows or size >= self.size:
                yield batch_of(held, self.schema)
                held, size = [], 0
        if held:
            yield batch_of(held, self.schema)
        # Workers live on; what Arrow keeps for later would add to the next operator's.
        pa.default_memory_pool().release_unused()


def tuples(batches: Iterator[pa.RecordBatch], step: int = 512) -> Iterator[tuple]:
    """Rows of the batches, `step` of them as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def crc_remainder(column: str, modulus: int) -> Column:
    """`crc32` of a column as text, modulo; null counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def id_and_bytes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, the text as UTF-8 bytes."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("binary").alias("raw"),
    )
