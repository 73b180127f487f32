import pytest
from conftest_llm import prose

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside.
CLASHING = [
    "kept", "keep_id", "part", "owner", "bucket", "raw", "n", "row", "words", "set_key", "w", "h",
    "s", "word", "held_out", "_text", "body", "sha", "component", "length", "words_left", "spans",
]


@pytest.fixture
def table(spark):
    """Documents from {id: text} or (id, text) pairs."""

    def make(texts, lang="en"):
        pairs = texts.items() if isinstance(texts, dict) else texts
        rows = [(i, t, lang, "s", len(t or "")) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def awkward(table):
    """Nulls, empty, blank, long and repeated texts, and columns with clashing names."""
    long = prose(5, 30_000)
    df = table(
        [
            (1, None),
            (2, ""),
            (3, " \n\t "),
            (4, "One"),
            (5, "one"),
            (5, "one"),
            (6, long),
            (7, "x" * 50_000),
            (8, prose(1, 80) + ". Released under the MIT License."),
            (9, prose(1, 80) + ". Released under the MIT License!"),
            (10, "Été 中文 \U0001f600 ΣΑΣ á"),
            (11, "12345 67890 !!!"),
            (12, "word " * 400),
            (None, "no id"),
            (None, None),
        ]
    )
    for name in CLASHING:
        df = df.selectExpr("*", f"concat('x', doc_id) as `{name}`")
    return df
