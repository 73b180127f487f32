"""A filter of fixed size that spares rows a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearling.sources.staging import staged

#: Pages of the filter, 4 KB each, whatever the input.
PAGES = 1024


def _bit(key: Column) -> tuple[Column, Column]:
    """Page and position of a key's bit."""
    code = F.xxhash64(key)
    return F.pmod(code, F.lit(PAGES)), F.pmod(F.floor(code / PAGES), F.lit(32768))


def perhaps_in(rows: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """The rows whose key may be among the keys of `members`: all that are, and a share
    of the others that grows with the number of members.

    The filter is a bit for each hash, in pages that can be broadcast at any size of
    input. What passes it must still be joined, or be harmless.
    """
    marked, bit = _marked(rows, key, members)
    return marked.where(bit).select(rows.columns)


def parted(rows: DataFrame, key: str, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be among the keys of `members`, and those whose is not."""
    marked, bit = _marked(rows, key, members)
    return marked.where(bit).select(rows.columns), marked.where(~bit).select(rows.columns)


def _marked(rows: DataFrame, key: str, members: DataFrame) -> tuple[DataFrame, Column]:
    """The rows beside their page of the filter, and whether their bit is set."""
    page, position = _bit(F.col(key))
    pages = staged(
        members.select(page.alias("_page"), position.alias("_position"))
        .groupBy("_page")
        .agg(F.bitmap_construct_agg("_position").alias("_bits")),
        "filter",
    )
    marked = rows.withColumns({"_page": page, "_position": position})
    marked = marked.join(F.broadcast(pages), "_page", "left")
    byte = F.expr("substring(_bits, cast(_position div 8 as int) + 1, 1)")
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (F.col("_position") % 8).cast("int"))
    return marked, F.coalesce(bit == 1, F.lit(False))
