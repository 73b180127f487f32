"""The queries of this package, and SQL to check them where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearling.llm.conversations import (
    digests_of_ends,
    prefix_trie,
    sequences,
    with_shared_starts,
)
from yearling.llm.exact_dedup import exact_groups
from yearling.llm.language import languages
from yearling.llm.lexical import ranked
from yearling.llm.licences import CONTAINED, NOTICES, SHINGLE, licence_matches
from yearling.llm.near_dedup import near_groups
from yearling.llm.packing import pack
from yearling.llm.pages import main_text
from yearling.llm.passages import repeated_passages
from yearling.llm.ppm import log_probabilities
from yearling.llm.quality import ledger, verdict
from yearling.llm.tokens import token_digests
from yearling.llm.vectors import linked_vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_matches(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_probabilities(table(spark, sf_dir, "documents"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~verdict(1)).alias("base_failed"),
        (verdict(1) & verdict(2)).alias("kept"),
        "failures",
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    trie = prefix_trie(with_shared_starts(sequences(table(spark, sf_dir, "conversations"))))
    several = trie.nodes.where("n_ends > 1").join(
        digests_of_ends(
            trie.ends.join(
                trie.nodes.where("n_ends > 1").select("node"), "node", "left_semi"
            )
        ),
        "node",
    )
    alone = F.when(F.col("n_ends") == 1, F.col("end_first").cast("string")).otherwise("")
    others = trie.nodes.where("n_ends <= 1").withColumn("ids_sha256", F.sha2(alone, 256))
    return others.unionByName(several).select(
        F.col("first").alias("conv_id"),
        "depth",
        F.col("parent_first").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.col("ids_sha256").alias("ends_sha256"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licence_scan": op1_licence_scan,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_html_extraction": op3_html_extraction,
    "op4_language_id": op4_language_id,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_quality_rules": op9_quality_rules,
    "op10_near_dedup": op10_near_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_ranked_search": op12_ranked_search,
    "op13_embedding_dedup": op13_embedding_dedup,
}

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

_NOTICES = ", ".join(
    "('{}', '{}', '{}')".format(*(x.replace("'", "''") for x in notice)) for notice in NOTICES
)

ORACLE: dict[str, str] = {
    "op1_licence_scan": rf"""
WITH n AS (SELECT * FROM (VALUES {_NOTICES}) AS v(template, licence, body)),
tw AS (
  SELECT template, licence, regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}]+') AS w FROM n
),
t AS (
  SELECT DISTINCT template, licence, unnest(list_transform(range(1, len(w) - {SHINGLE - 2}),
    lambda i: array_to_string(w[i:i+{SHINGLE - 1}], ' '))) AS g FROM tw
),
sizes AS (
  SELECT template, licence, count(*) AS n_shingles,
    CAST(power(2, ceil(log2(count(*)))) AS BIGINT) AS tier FROM t GROUP BY 1, 2
),
dw AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents
  WHERE text IS NOT NULL
),
s AS (
  SELECT doc_id, i - 1 AS i, array_to_string(w[i:i+{SHINGLE - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {SHINGLE - 2})) AS i FROM dw)
),
hits AS (
  SELECT DISTINCT doc_id, t.template, t.licence, n_shingles, i, g,
    greatest(1, tier // 2) AS stride, tier + greatest(1, tier // 2) - 1 AS width
  FROM s JOIN t USING (g) JOIN sizes ON sizes.template = t.template
),
placed AS (
  SELECT *, unnest(range(
    CAST(greatest(0, ceil((i - width + 1) / stride)) AS BIGINT), i // stride + 1)) * stride AS start
  FROM hits
),
counted AS (
  SELECT doc_id, template, licence, n_shingles, start, count(DISTINCT g) AS n_matched
  FROM placed GROUP BY ALL
),
close AS (
  SELECT a.template, b.template AS rival FROM t a JOIN t b USING (g)
  JOIN sizes ON sizes.template = a.template
  WHERE a.licence <> b.licence
  GROUP BY a.template, b.template, n_shingles HAVING count(*) >= {CONTAINED} * n_shingles
),
own AS (
  SELECT close.template, rival, t.g, count(*) OVER (PARTITION BY close.template, rival) AS n_own
  FROM close JOIN t ON t.template = close.template
  WHERE NOT EXISTS (SELECT 1 FROM t u WHERE u.template = rival AND u.g = t.g)
),
need AS (SELECT DISTINCT template, rival, n_own FROM own),
told AS (
  SELECT placed.doc_id, placed.template, start, rival, count(DISTINCT placed.g) AS n_told
  FROM placed JOIN own ON own.template = placed.template AND own.g = placed.g GROUP BY ALL
),
missed AS (
  SELECT DISTINCT c.doc_id, c.template, c.start
  FROM counted c JOIN need ON need.template = c.template
  LEFT JOIN told ON told.doc_id = c.doc_id AND told.template = c.template
    AND told.start = c.start AND told.rival = need.rival
  WHERE 2 * coalesce(n_told, 0) < n_own
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY doc_id, template ORDER BY n_matched DESC, start) AS place
  FROM counted ANTI JOIN missed USING (doc_id, template, start)
  WHERE n_matched >= {CONTAINED} * n_shingles
)
SELECT doc_id, template, licence, n_shingles, n_matched, n_matched / n_shingles AS containment,
  start AS window_start FROM ranked WHERE place = 1
""",
    "op6_exact_dedup": f"""
WITH t AS (SELECT doc_id, {_LOWER} AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM t JOIN g USING (body)
""",
    "op9_quality_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS n_letters
  FROM d
),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w)
),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS p FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS k FROM win
    ) WHERE k > 1
  ) GROUP BY doc_id
),
m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(length(array_to_string(w, '')), 0) AS word_chars,
    n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(l) AS n_lines, n_upper, n_letters
  FROM w LEFT JOIN rep USING (doc_id)
),
f AS (
  SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN 2 * n_upper > n_letters THEN 8 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_letters < word_chars THEN 64 ELSE 0 END AS failures
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failures & 3 <> 0 AS base_failed, failures = 0 AS kept, CAST(failures AS BIGINT) AS failures
FROM f
""",
    "op10_near_dedup": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 3
      THEN list_transform(range(1, len(w) - 1), lambda i: concat_ws(' ', w[i], w[i+1], w[i+2]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS same
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * same >= 85 * (a.n + b.n - same)
),
r AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.other
),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
""",
    "op11_prefix_trie": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL
),
o AS (
  SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST,
    sha256(strlen(role) || ':' || role || text)) AS turns FROM t GROUP BY conv_id
),
h AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
      lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)),
    4294967295::BIGINT) % 6 AS h
  FROM o
),
r AS (
  SELECT h.conv_id, list_concat(coalesce(list_slice(o.turns, 1, h), []),
    list_slice(h.turns, h + 1, len(h.turns))) AS turns
  FROM h LEFT JOIN o ON o.conv_id = h.conv_id - h.conv_id % 100
),
p AS (
  SELECT conv_id, d, CASE WHEN d = 0 THEN [] ELSE list_slice(turns, 1, d) END AS prefix,
    len(turns) = d AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)
),
n AS (
  SELECT prefix, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), ''))
      AS ends_sha256
  FROM p GROUP BY prefix, d
),
e AS (
  SELECT *, unnest(range(0, depth + 1)) AS up,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(prefix[depth].text) END AS saves
  FROM n
),
s AS (
  SELECT CASE WHEN up = 0 THEN [] ELSE list_slice(prefix, 1, up) END AS prefix, up AS depth,
    sum(saves) AS saved, count(*) FILTER (depth = up + 1) AS n_children,
    max(depth) AS deepest FROM e GROUP BY 1, 2
),
leaf AS (
  SELECT CASE WHEN up = 0 THEN [] ELSE list_slice(e.prefix, 1, up) END AS prefix, up AS depth,
    count(*) AS n_leaves
  FROM e JOIN s ON s.prefix = e.prefix AND s.depth = e.depth WHERE s.n_children = 0 GROUP BY 1, 2
)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, s.n_children, leaf.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.prefix = n.prefix AND s.depth = n.depth
JOIN leaf ON leaf.prefix = n.prefix AND leaf.depth = n.depth
LEFT JOIN n q ON n.depth > 0 AND q.depth = n.depth - 1
  AND q.prefix = CASE WHEN n.depth = 1 THEN [] ELSE list_slice(n.prefix, 1, n.depth - 1) END
""",
    "op12_ranked_search": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER},
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
),
h AS (SELECT row_number() OVER () AS r, doc_id, t FROM d WHERE len(t) > 0),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM h),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM h) GROUP BY r, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, c GROUP BY term, n_docs
),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER},
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
),
s AS (
  SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) //
    (1000 * tf + 8 * (10 + (90 * len(t) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN p USING (term) JOIN h USING (r), c
  GROUP BY item_id, doc_id, r
),
k AS (
  SELECT item_id, CAST(row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
""",
    "op13_embedding_dedup": """
WITH RECURSIVE e AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
),
g AS (
  SELECT * FROM e WHERE label IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
),
l AS (
  SELECT a.r, b.r AS other FROM g a JOIN g b
    ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
),
n AS (SELECT r, count(*) AS n_links FROM l GROUP BY r),
c AS (
  SELECT r, r AS other FROM e
  UNION
  SELECT c.r, l.other FROM c JOIN l ON l.r = c.other
),
m AS (SELECT c.r, min(o.vec_id) AS component_id FROM c JOIN e o ON o.r = c.other GROUP BY c.r)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id,
  e.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM e JOIN m USING (r) LEFT JOIN n USING (r)
""",
}
