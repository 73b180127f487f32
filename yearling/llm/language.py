"""Language of a text by rank-order profiles of character n-grams."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearling.llm.text import crc_remainder, per_row

#: N-grams of a profile; n-grams have one to three characters, so three of 21 bits.
PROFILE = 600
#: Distinct n-grams a task holds for one language before it passes them on.
HELD = 500_000
#: Languages beyond which the labels are no languages: profiles go to every task.
LANGUAGES = 5_000

UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter(
        (unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000
    )


def ngrams(raw: bytes | None) -> np.ndarray:
    """Codes of the 1-, 2- and 3-grams of a text in lower case.

    Runs of anything but letters are one blank, and there is one at either end.
    """
    text = (raw or b"").decode("utf-8", "replace").lower()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.where(_letters()[codes], codes, 32)
    codes = np.concatenate(([32], codes, [32]))
    codes = codes[~((codes == 32) & np.concatenate(([False], codes[:-1] == 32)))]
    ones = codes[codes != 32]
    if not len(ones):
        return ones
    twos = codes[:-1] << 21 | codes[1:]
    threes = (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[codes[1:-1] != 32]
    return np.concatenate((ones, twos, threes))


def top(raw: bytes | None, size: int) -> np.ndarray:
    """The most frequent n-grams of a text, first the most frequent; ties by code."""
    grams, counts = np.unique(ngrams(raw), return_counts=True)
    return grams[np.lexsort((grams, -counts))[:size]]


def _counts(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Counts of n-grams by language, summed over many texts before they leave."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    sizes: dict[str, int] = {}

    def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate([g for g, _ in held[lang]])
        counts = np.concatenate([c for _, c in held[lang]])
        distinct, at = np.unique(grams, return_inverse=True)
        return distinct, np.bincount(at, counts).astype(np.int64)

    def out(lang: str) -> Iterator[tuple]:
        for gram, n in zip(*(x.tolist() for x in merged(lang)), strict=True):
            yield lang, gram, n

    for lang, raw in rows:
        found = np.unique(ngrams(raw), return_counts=True)
        held.setdefault(lang, []).append(found)
        sizes[lang] = sizes.get(lang, 0) + len(found[0])
        if sizes[lang] > HELD:
            held[lang] = [merged(lang)]
            sizes[lang] = len(held[lang][0][0])
            if sizes[lang] > HELD // 2:
                yield from out(lang)
                del held[lang], sizes[lang]
    for lang in held:
        yield from out(lang)


def profiles(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE
) -> DataFrame:
    """`lang`, `gram`, `place` (from 0) of the most frequent n-grams of each language,
    over all rows with a text and a language."""
    labelled = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = per_row(
        labelled.select(
            F.col(lang_col).cast("string").alias("lang"),
            F.col(text_col).cast("binary").alias("raw"),
        ),
        "lang string, gram bigint, n bigint",
        _counts,
    )
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return (
        totals.withColumn("place", place)
        .where(F.col("place") <= size)
        .select("lang", "gram", (F.col("place") - 1).alias("place"))
    )


class Nearest:
    """The profile with the least out-of-place distance."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.langs = sorted({lang for lang, _, _ in rows})
        self.grams = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        self.places = np.full((len(self.langs), len(self.grams) + 1), -1, np.int32)
        number = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, place in rows:
            self.places[number[lang], np.searchsorted(self.grams, gram)] = place

    def guess(self, raw: bytes | None) -> tuple[str, float]:
        own = top(raw, self.size)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        at = np.where(self.grams[at] == own, at, len(self.grams))
        places = self.places[:, at]
        moved = np.abs(places - np.arange(len(own), dtype=np.int32))
        distance = np.where(places < 0, self.size, moved).sum(axis=1)
        best = int(np.argmin(distance))
        return self.langs[best], 1.0 - float(distance[best]) / (self.size * len(own))

    def __call__(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, held_out, raw in rows:
            yield doc_id, held_out, *self.guess(raw)


def languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    size: int = PROFILE,
    modulus: int = 4,
    held_out: int = 2,
) -> DataFrame:
    """The predicted language of every row: `doc_id`, `held_out`, `lang_pred`, `score`.

    Profiles are learned from all rows with a text and a language whose `crc32` of the
    id as text, modulo `modulus`, is not `held_out`. A prediction reads the text alone.
    The score is one less the distance's share of the largest one. Of equally near
    languages the first by name wins. Texts that are null or have no letter, and all
    texts if there is nothing to learn from, give `und` and 0. A null id counts as the
    empty text in `crc32`. Repeated rows each give a row; other columns are not read.
    """
    remainder = crc_remainder(id_col, modulus)
    learned = profiles(docs.where(remainder != held_out), text_col, lang_col, size)
    rows = learned.limit(LANGUAGES * size + 1).collect()
    if len(rows) > LANGUAGES * size:
        raise ValueError(f"more than {LANGUAGES} languages; are these labels?")
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (remainder == held_out).alias("held_out"),
        F.col(text_col).cast("binary").alias("raw"),
    )
    return per_row(
        source,
        "doc_id bigint, held_out boolean, lang_pred string, score double",
        Nearest([tuple(r) for r in rows], size),
    )
