"""Ranked search against a count of every score."""

import math
import random
import re

import pytest
from conftest_llm import lower, prose

from yearling.llm import lexical
from yearling.llm.lexical import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def found_terms(text):
    return TERM.findall(lower(text))


def brute(docs, items, k=10):
    held = [(i, found_terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n_docs, length = len(held), sum(len(t) for _, t in held)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(found_terms(t))
    out = []
    for item, ws in wanted.items():
        best = []
        for doc_id, t in held:
            m = 10 + 90 * len(t) * n_docs // length
            score = 0
            for w in ws:
                tf = t.count(w)
                if tf:
                    df = sum(w in set(x) for _, x in held)
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += weight * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                best.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (s, _, _, doc_id) in enumerate(sorted(best, key=lambda b: b[:3])[:k], 1):
            out.append((item, rank, doc_id, -s))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def items(spark):
    return lambda pairs: spark.createDataFrame(pairs, "item_id bigint, text string")


def corpus(n, seed=3):
    rng = random.Random(seed)
    docs = [(i, prose(rng.randint(0, 30), rng.choice([1, 5, 40, 200]), "abc")) for i in range(n)]
    return docs + [(n, None), (n + 1, ""), (n + 2, " -- "), (3, docs[3][1]), (None, docs[5][1])]


def test_equals_every_score_counted(table, items):
    docs = corpus(120)
    wanted = [(i, prose(100 + i, 12, "abc")) for i in range(12)] + [(40, docs[7][1])]
    found = ranked(table(docs), items(wanted))
    assert told(found) == brute(docs, wanted)


@pytest.mark.parametrize(("shard", "step", "query"), [(50, 1 << 18, 8 << 20), (1 << 20, 16, 200)])
def test_small_shards_and_steps_change_nothing(monkeypatch, table, items, shard, step, query):
    docs = corpus(60)
    wanted = [(i, prose(100 + i, 10, "abc")) for i in range(6)]
    monkeypatch.setattr(lexical, "QUERY_BYTES", query)
    monkeypatch.setattr(lexical, "SHARD", shard)
    monkeypatch.setattr(lexical, "STEP", step)
    assert told(ranked(table(docs).repartition(2), items(wanted))) == brute(docs, wanted)


def test_ties_go_by_id_and_stop_at_k(table, items):
    docs = [(i, "alpha beta") for i in range(30, 0, -1)] + [(99, "gamma")]
    found = told(ranked(table(docs), items([(1, "Alpha"), (2, "absent"), (3, "gamma alpha")])))
    one = [r for r in found if r[0] == 1]
    assert sorted(r[2] for r in one) == list(range(1, 11))
    assert not [r for r in found if r[0] == 2]
    assert found == brute(docs, [(1, "Alpha"), (3, "gamma alpha")])


def test_terms_are_runs_of_letters_digits_and_other_characters(table, items):
    docs = [(1, "É2e-mail x_Y"), (2, "ÉTÉ"), (3, "été"), (4, "x y mail"), (5, "a")]
    wanted = [(1, "é2E Mail"), (2, "été"), (3, " "), (4, "x"), (5, None), (6, "É2e")]
    assert told(ranked(table(docs), items(wanted))) == brute(docs, wanted)


def test_rows_of_one_item_are_one_item(table, items):
    docs = corpus(20)
    wanted = [(1, docs[2][1]), (1, docs[9][1]), (None, docs[4][1]), (2, None), (2, "")]
    assert told(ranked(table(docs), items(wanted))) == brute(docs, wanted)


def test_a_long_text_and_a_long_item(table, items):
    docs = [*corpus(10), (50, prose(8, 60_000, "abcdefgh"))]
    wanted = [(1, prose(8, 5_000, "abcdefgh")), (2, prose(9, 20, "abcdefgh"))]
    table = table(docs)
    found = told(ranked(table, items(wanted)))
    assert found[0][:3] == (1, 1, 50)
    assert [r[:3] for r in found if r[0] == 2 and r[1] == 1] == [(2, 1, 50)]


def test_empty_tables_and_other_columns(awkward, items):
    wanted = items([(1, "one word"), (2, "mit license")])
    names = ["item_id", "rank", "doc_id", "score"]
    assert ranked(awkward, wanted).columns == names
    plain = awkward.select("doc_id", "text")
    clash = wanted.selectExpr("*", "'x' as term", "'x' as terms", "1 as score", "2 as doc_id")
    assert told(ranked(awkward, clash)) == told(ranked(plain, wanted))
    assert told(ranked(awkward.limit(0), wanted)) == []
    assert told(ranked(awkward, wanted.limit(0))) == []
    assert told(ranked(awkward.selectExpr("doc_id", "cast(null as string) as text"), wanted)) == []
