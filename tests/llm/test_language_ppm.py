import itertools
import math
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest_llm import prose, words

from yearling.llm import ppm
from yearling.llm.language import languages, ngrams
from yearling.llm.ppm import START, Trie, codes, log_probabilities

DATA = "/root/testdata/sf0.01/documents.parquet"


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_ngrams():
    found = {"".join(chr(c >> s & 0x1FFFFF) for s in (42, 21, 0)).strip("\0") for c in ngrams(b"Ab, 1 c")}
    assert found == {"a", "b", "c", " a", "ab", "b ", " c", "c ", " ab", "ab ", " c "}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DATA)
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    found = languages(docs).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    held_out = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held_out) >= 0.98 * len(held_out)


def plain_ngrams(text):
    """Counts of 1- to 3-grams, letter by letter."""
    kept = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower())
    line = f" {' '.join(kept.split(' '))} "
    while "  " in line:
        line = line.replace("  ", " ")
    found = Counter(c for c in line if c != " ")
    if found:
        found.update(line[i : i + 2] for i in range(len(line) - 1))
        found.update(x for i in range(len(line) - 2) if (x := line[i : i + 3])[1] != " ")
    return found


def plain_order(counts, size):
    def code(gram):
        return sum(ord(c) << 21 * k for k, c in enumerate(reversed(gram)))

    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:size]


@pytest.mark.parametrize("size", [7, 600])
def test_predictions_equal_brute_force(spark, size):
    rows = [tuple(r) for r in pq.read_table(DATA, columns=["doc_id", "text", "lang"]).slice(0, 250)
            .to_pandas().astype(object).itertuples(index=False)]
    rows += [(9001, "ÀÉ ß 中文 ab", "xx"), (9002, "中文 中 ab", "xx"), (9003, None, "xx"),
             (9004, "12", None), (9005, "", "yy"), (9006, "zz zz", "yy"), (9007, "zz ab", None)]
    rows = [(i, t if isinstance(t, str) else None, x) for i, t, x in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    totals = {}
    for doc_id, text, lang in rows:
        if text is not None and lang is not None and remainder(doc_id, 4) != 2:
            totals.setdefault(lang, Counter()).update(plain_ngrams(text))
    known = {
        lang: {g: i for i, g in enumerate(plain_order(c, size))} for lang, c in totals.items() if c
    }
    expected = {}
    for doc_id, text, _ in rows:
        own = plain_order(plain_ngrams(text), size)
        far = {
            lang: sum(abs(p[g] - i) if g in p else size for i, g in enumerate(own))
            for lang, p in known.items()
        }
        best = min(sorted(far), key=far.get) if own else "und"
        score = 1 - far[best] / (size * len(own)) if own else 0.0
        expected[doc_id] = (best, pytest.approx(score, abs=1e-12))
    found = {r.doc_id: (r.lang_pred, r.score) for r in languages(docs, size=size).collect()}
    assert len(found) == len(rows) and found == expected


def test_texts_without_letters_and_unlabelled(table):
    # 0 to 9 are in training but for 2, 4 and 8 or so; labels do not matter in prediction.
    docs = table({i: prose(i, 50) for i in range(10)}).unionByName(
        table({20: "12 !", 21: None, 22: "éè", 23: prose(3, 9)}, lang=None)
    )
    found = {r.doc_id: (r.lang_pred, r.score) for r in languages(docs).collect()}
    assert found[20] == found[21] == ("und", 0.0)
    assert found[22][0] == found[23][0] == "en"
    alone = languages(table({1: "a text"}, lang=None)).first()
    assert (alone.lang_pred, alone.score) == ("und", 0.0)


def levels(bodies, order, share):
    grams = np.concatenate([codes(b, order) for b in bodies])
    out = []
    for k in range(order + 1):
        own, n = np.unique(grams & ((1 << 9 * (k + 1)) - 1), return_counts=True)
        kept = n * share >= n.sum() if k else n > 0
        out.append((own[kept], n[kept]))
    return out


@pytest.mark.parametrize("share", [1 << 20, 12, 4])
def test_probabilities_sum_to_one(share):
    """Exclusion loses nothing, with all nodes and with the rare ones left out."""
    trie = Trie(levels([b"abracadabra", b"banana", b"", b"abcab" * 20], 3, share))
    for context in itertools.product([START, 97, 98, 99, 120], repeat=3):
        code = 0
        for symbol in context:
            code = code << 9 | symbol
        grams = np.array([code << 9 | s for s in range(257)])
        assert (10 ** trie.lengths(grams)).sum() == pytest.approx(1)


def brute_trie(bodies, order):
    """The same model, symbol by symbol."""
    seen = [Counter() for _ in range(order + 1)]
    for body in bodies:
        symbols = [START] * order + list(body) + [256]
        for i in range(order, len(symbols)):
            for k in range(order + 1):
                seen[k][tuple(symbols[i - k : i]), symbols[i]] += 1
    tables = [{} for _ in seen]
    for k, counts in enumerate(seen):
        for (context, s), n in counts.items():
            tables[k].setdefault(context, {})[s] = n

    def length(context, symbol):
        excluded, total = set(), 0.0
        for k in range(order, -1, -1):
            own = tables[k].get(context[len(context) - k :])
            if own is None:
                continue
            left = {s: n for s, n in own.items() if s not in excluded}
            whole = sum(left.values()) + len(left)
            if symbol in left:
                return total + math.log10(left[symbol] / whole)
            if left:
                total += math.log10(len(left) / whole)
            excluded |= set(own)
        return total - math.log10(257 - len(tables[0].get((), {})))

    def score(body):
        symbols = [START] * order + list(body) + [256]
        return sum(
            length(tuple(symbols[i - order : i]), symbols[i]) for i in range(order, len(symbols))
        )

    return score


def test_scores_equal_brute_force(table):
    texts = {i: prose(i % 7, 1 + i % 30, "abcde") + "é"[: i % 2] for i in range(40)}
    texts |= {40: None, 41: "", 42: "UPPER upper zzz", 43: "\n\t"}
    train = [i for i in texts if remainder(i, 5) != 1]
    low = {i: (t or "").encode().lower() for i, t in texts.items()}
    score = brute_trie([low[i] for i in train], 3)
    count = Counter()
    for i in train:
        count.update([*words(texts[i]), None])
    total, distinct = sum(count.values()), len(count)
    for r in log_probabilities(table(texts).repartition(3), order=3).collect():
        tokens = [*words(texts[r.doc_id]), None]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        assert r.held_out == (r.doc_id not in train)
        assert (r.n_tokens, r.train_tokens) == (len(tokens), total)
        assert r.n_known == sum(1 for w in tokens if count[w])
        assert r.base_score == pytest.approx(base)
        assert r.score == pytest.approx(score(low[r.doc_id]))


def test_rare_words_are_joined(table, monkeypatch):
    monkeypatch.setattr(ppm, "SHARE", 20)
    texts = {i: prose(i, 40, "abc") for i in range(30)}
    found = {r.doc_id: r.base_score for r in log_probabilities(table(texts)).collect()}
    monkeypatch.undo()
    for r in log_probabilities(table(texts)).collect():
        assert found[r.doc_id] == pytest.approx(r.base_score)


@pytest.mark.parametrize(("cached", "wanted"), [(1 << 22, 1_000_000), (20, 1), (1, 50)])
def test_every_counted_gram_scores(table, monkeypatch, cached, wanted):
    """What goes to every task, and how many texts are looked up together, changes nothing."""
    monkeypatch.setattr(ppm, "SHARE", 20)
    monkeypatch.setattr(ppm, "GRAM_SHARE", cached, raising=False)
    monkeypatch.setattr(ppm, "WANTED", wanted, raising=False)
    monkeypatch.setattr(ppm, "TOGETHER", 300)
    texts = {i: prose(i % 9, 40, "abc") + f" {prose(i, 5)}é" for i in range(30)} | {40: None}
    train = [i for i in texts if remainder(i, 5) != 1]
    low = {i: (t or "").encode().lower() for i, t in texts.items()}
    score = brute_trie([low[i] for i in train], 6)
    for r in log_probabilities(table(texts).repartition(3)).collect():
        assert r.score == pytest.approx(score(low[r.doc_id]))


def test_better_than_words_on_held_out_texts():
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet").to_pandas()
    low = {i: t.encode().lower() for i, t in zip(texts.doc_id, texts.text, strict=True)}
    train = [b for i, b in low.items() if remainder(i, 5) != 1]
    test = [b for i, b in low.items() if remainder(i, 5) == 1][:500]
    trie = Trie(levels(train, ppm.ORDER, ppm.SHARE))
    count = Counter(w for b in train for w in [*b.split(), None])
    total, distinct = sum(count.values()), len(count)
    base = sum(
        math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1)))
        for b in test
        for w in [*b.split(), None]
    )
    assert trie.scores(test).sum() > base


class Asked(dict):
    """Counts how often each word is looked up."""

    def __init__(self, *args):
        super().__init__(*args)
        self.asked = Counter()

    def get(self, word, default=None):
        self.asked[word] += 1
        return super().get(word, default)


@pytest.mark.parametrize("end", [{}, {b"": -0.25}])
def test_words_of_texts_scored_together_are_looked_up_once(end):
    fields = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
    bodies = [b" a b a\n", b"", b"b\x1cb b c a c", b"\t ", "é é a".encode()]
    frequent = Asked({b"a": -1.0, b"b": -2.0} | end)
    scores = ppm.Scores(None, None, 6, 4, pa.schema([("rest", fields)]))
    found = scores.base(bodies, frequent)
    # The empty word also stands for the end.
    assert max(n for word, n in frequent.asked.items() if word) == 1
    for i, body in enumerate(bodies):
        tokens = Counter([*body.split(), b""])
        known = {w: n for w, n in tokens.items() if w in frequent}
        assert found["n_tokens"][i] == tokens.total()
        assert found["known"][i] == sum(known.values())
        assert found["base"][i] == pytest.approx(sum(frequent[w] * n for w, n in known.items()))
        rest = {r["word"]: r["n"] for r in found["rest"][i].as_py()}
        assert rest == {w: n for w, n in tokens.items() if w not in frequent}


def test_word_counts_of_batches():
    texts = [b"B b a", None, b"  ", "a É".encode()]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["raw"])
    rows = [r for b in ppm._word_counts(iter([batch, batch])) for r in b.to_pylist()]
    total = Counter()
    for r in rows:
        total[r["word"]] += r["n"]
    assert total == {b"b": 4, b"a": 4, "É".encode(): 2, b"": 8}


def test_grams_are_summed():
    grams, sums = ppm._summed(np.array([1, 5, 9, 1, 9, 2]), np.array([1, 2, 3, 4, 5, 6]))
    assert (grams.tolist(), sums.tolist()) == ([1, 2, 5, 9], [5, 6, 2, 8])
    assert [len(x) for x in ppm._summed(np.empty(0, int), np.empty(0, int))] == [0, 0]
    distinct, place = ppm._distinct(np.array([7, -3, 7, 0]))
    assert (distinct.tolist(), place.tolist()) == ([-3, 0, 7], [2, 0, 2, 1])
