"""Tokens of every text, encoded and decoded again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame

from yearling.llm.bpe import WORD_BPE, encoded_rows, encoder
from yearling.llm.text import id_and_bytes, per_row


class Digests:
    def __init__(self, path: str):
        self.path = path

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        coder = encoder(self.path)
        for (doc_id, _), ids in encoded_rows(coder, rows):
            yield (
                doc_id,
                len(ids) // 4,
                hashlib.sha256(ids).hexdigest(),
                hashlib.sha256(coder.decode(ids)).hexdigest(),
            )


class Ids:
    def __init__(self, path: str):
        self.path = path

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        coder = encoder(self.path)
        for (doc_id, _), ids in encoded_rows(coder, rows):
            yield doc_id, ids, coder.decode(ids).decode()


def encoded(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = WORD_BPE
) -> DataFrame:
    """`doc_id`, `ids` (unsigned 32-bit, little-endian) and the text decoded from them.

    Null and empty texts have no ids. One row for each row of `docs`, whose other
    columns are not read. No special token is added; one spelt out in a text is encoded
    as such, like the library does.
    """
    source = id_and_bytes(docs, id_col, text_col)
    return per_row(source, "doc_id bigint, ids binary, decoded string", Ids(vocabulary))


def token_digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = WORD_BPE
) -> DataFrame:
    """As `encoded`, with digests in place of the ids and the decoded text: `doc_id`,
    `n_tokens`, `ids_sha256`, `decoded_sha256`."""
    source = id_and_bytes(docs, id_col, text_col)
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return per_row(source, schema, Digests(vocabulary))
