"""Quality rules, evaluated once and kept as bits, and policies over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a window that may repeat.
WINDOW = 8

#: Each rule's name and when a text fails it, over the measurements. A rule's bit is its
#: place here; new rules go to the end, so that old ledgers stay readable.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("capitals", "2 * n_upper > n_letters"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    ("few_letters", "2 * n_letters < word_chars"),
]

#: Rules that a text must pass, by version of the policy. Versions are never changed.
POLICIES: dict[int, list[str]] = {
    1: ["few_words", "repeated_windows"],
    2: [name for name, _ in RULES],
}

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
]


def mask(rules: list[str]) -> int:
    places = {name: place for place, (name, _) in enumerate(RULES)}
    return sum(1 << places[name] for name in rules)


def _joined(hashes: str, n: str, apart: int) -> Column:
    """Hash of each element with the one `apart` places on."""
    return F.expr(
        f"zip_with(slice({hashes}, 1, size({hashes}) - {apart}), "
        f"slice({hashes}, {apart + 1}, size({hashes}) - {apart}), (x, y) -> xxhash64(x, y))"
    )


def measure(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`doc_id` and the measurements of every row.

    Each step is a projection of its own, so that arrays are computed once. Windows are
    told apart by 64-bit hashes; only texts in which one occurs twice are sorted.
    """
    text = F.col("body")
    steps = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("body"),
    ).select(
        "doc_id",
        F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).alias(
            "n_symbols"
        ),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, r"\p{Lu}+", ""))).alias(
            "n_upper"
        ),
        F.char_length(F.regexp_replace(text, r"[^\p{L}]+", "")).alias("n_letters"),
    )
    plain = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines"]
    plain += ["n_upper", "n_letters"]
    steps = steps.select(
        "doc_id",
        F.size("words").alias("n_words"),
        F.char_length(F.array_join("words", "")).alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        "n_upper",
        "n_letters",
        F.when(
            F.size("words") > WINDOW, F.transform("words", lambda x: F.xxhash64(x))
        ).alias("h"),
    )
    for apart in (1, 2, 4):
        steps = steps.select(*plain, _joined("h", "n_words", apart).alias("h"))
    again = F.size(F.array_distinct("h")) < F.size("h")
    steps = steps.select(
        *plain,
        F.when(
            again, F.expr("sort_array(transform(h, (x, i) -> struct(x as x, i as i)))")
        ).alias("s"),
    )
    steps = steps.select(
        *plain,
        F.expr(
            "sort_array(array_distinct(flatten(zip_with("
            "slice(s, 1, size(s) - 1), slice(s, 2, size(s) - 1), "
            "(a, b) -> if(a.x = b.x, array(a.i, b.i), cast(array() as array<int>))))))"
        ).alias("at"),
    )
    covered = F.expr(
        f"aggregate(zip_with(slice(at, 1, size(at) - 1), slice(at, 2, size(at) - 1), "
        f"(a, b) -> least({WINDOW}, b - a)), {WINDOW}, (x, y) -> x + y)"
    )
    steps = steps.select(*plain, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))
    return steps.select("doc_id", *(F.col(c).cast("long").alias(c) for c in MEASURES))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: `doc_id`, the measurements, and `failures` with a
    bit for every rule the text fails.

    Null and empty texts have no words and fail `few_words` alone. Other columns are not
    read; repeated rows each give a row.
    """
    bits = sum(
        (F.when(F.expr(failed), F.lit(1 << place)).otherwise(F.lit(0)))
        for place, (_, failed) in enumerate(RULES)
    )
    return measure(docs, id_col, text_col).withColumn("failures", bits.cast("long"))


def verdict(version: int) -> Column:
    """Whether a ledger row passes a version of the policy."""
    return F.col("failures").bitwiseAND(mask(POLICIES[version])) == 0


def ablations(rows: DataFrame, version: int) -> DataFrame:
    """What each rule of a policy decides: `rule`, `failed` (rows that fail it),
    `failed_alone` (rows it alone removes) and `kept_without` it.

    The ledger is summed to one count for each pattern of bits; the texts are not read.
    """
    own = mask(POLICIES[version])
    patterns = rows.groupBy(F.col("failures").bitwiseAND(own).alias("bits")).agg(
        F.count("*").alias("n")
    )
    rules = F.array(
        *(
            F.struct(F.lit(name).alias("rule"), F.lit(mask([name])).cast("long").alias("bit"))
            for name in POLICIES[version]
        )
    )
    each = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.*")
    n = F.col("n")
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, n).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), n).otherwise(0)).alias("failed_alone"),
        F.sum(F.when((F.col("bits") == 0) | (F.col("bits") == F.col("bit")), n).otherwise(0)).alias(
            "kept_without"
        ),
    )
