"""From raw documents to packed training sequences, in stages.

Documents are told apart by `doc_id`: rows without one leave at the first stage, and of
rows that repeat one, the first by all its columns stays at the second. Null counts as
the empty text. Columns other than `doc_id`, `text`, `lang` and `n_chars` are carried along
unread.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearling.llm.exact_dedup import exact_groups
from yearling.llm.filters import parted
from yearling.llm.language import UNKNOWN, languages
from yearling.llm.near_dedup import near_groups
from yearling.llm.packing import pack
from yearling.llm.passages import repeated_passages, without_passages
from yearling.sources.staging import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _only(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """The documents with an id that has a row `kept`, with all their columns.

    `marked` has `doc_id` and `kept` for every id. Documents are not shuffled but for those
    that may have to go.
    """
    own = F.col("doc_id").cast(docs.schema["doc_id"].dataType)
    marked = staged(marked.select(own.alias("doc_id"), "kept"), "marked")
    kept = marked.where("kept").select("doc_id")
    some, others = parted(docs, "doc_id", marked.where("not kept or kept is null"))
    left = some.join(kept, "doc_id", "left_semi").select(docs.columns)
    return left.unionByName(others.where(F.col("doc_id").isNotNull()))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go."""
    return _only(docs, languages(docs).withColumn("kept", F.col("lang_pred") != UNKNOWN))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with the same text, the one with the largest id."""
    marked = staged(exact_groups(docs).select("doc_id", "kept"), "kept")
    again = marked.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    again = staged(again.select("doc_id"), "again")
    once = docs.join(again, "doc_id", "left_anti")
    whole = F.struct(*(F.col(c) for c in docs.columns))
    first = (
        docs.join(again, "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min(whole).alias("first"))
        .select("first.*")
    )
    return _only(once.select(docs.columns).unionByName(first), marked)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: five words, similarity 0.8."""
    return _only(docs, near_groups(docs))


def repeated_parts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; `n_chars` follows.

    A document of which no word is left goes.
    """
    cut = staged(without_passages(docs, repeated_passages(docs)), "cut")
    # Texts that are not cut are not shuffled.
    some, others = parted(docs, "doc_id", cut)
    joined = some.join(cut, some["doc_id"] == cut["doc_id"], "left")
    joined = joined.where(cut["words_left"].isNull() | (cut["words_left"] > 0))
    changed = cut["words_left"].isNotNull()
    new = {"text": cut["text"], "n_chars": F.char_length(cut["text"])}
    joined = joined.select(
        *(
            F.when(changed, new[c].cast(kind)).otherwise(some[c]).alias(c) if c in new else some[c]
            for c, kind in docs.dtypes
        )
    )
    return joined.unionByName(others)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts with their place in a sequence of at most 2048 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("substring_dedup", repeated_parts),
    ("packing", packed),
]

#: Language profiles and passages cannot be told in SQL; tests hold the stages against
#: brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is a Parquet table that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
