import pathlib
import random

import numpy as np
import pytest
from conftest_llm import prose, words
from hypothesis import given, settings
from hypothesis import strategies as st

from yearling.llm import passages
from yearling.llm.passages import compact_windows, repeated_passages, without_passages
from yearling.sources.staging import shared_folder


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=60), st.integers(1, 9), st.booleans())
def test_windows_cover_every_run_by_its_minimum(values, width, spread):
    values = np.array(values, np.uint64)
    values = (values << np.uint64(50)) if spread else values << np.uint64(60) >> np.uint64(2)
    lefts, centres, rights = compact_windows(values, width)
    for left, centre, right in zip(lefts, centres, rights, strict=True):
        assert left <= centre <= right
        assert values[left : right + 1].min() == values[centre]
    for a in range(len(values) - width + 1):
        b = a + width - 1
        assert any(
            left <= a and b <= right and a <= c <= b
            for left, c, right in zip(lefts, centres, rights, strict=True)
        )


def test_few_windows():
    values = passages.mix(np.arange(100_000, dtype=np.uint64))
    assert len(compact_windows(values, 46)[1]) < 2.2 * 100_000 / 47


def covered(found, texts):
    marks = {i: bytearray(len(words(t))) for i, t in texts.items()}
    for r in found:
        marks[r.doc_id][r.start_word : r.start_word + r.n_words] = b"\1" * r.n_words
    return marks


def repeats(texts, size=50):
    """Words in exact runs that a document with a smaller id has."""
    seen, marks = set(), {}
    for i in sorted(texts):
        w = words(texts[i])
        runs = [tuple(w[a : a + size]) for a in range(len(w) - size + 1)]
        marks[i] = bytearray(len(w))
        for a, run in enumerate(runs):
            if run in seen:
                marks[i][a : a + size] = b"\1" * size
        seen.update(runs)
    return marks


def test_exact_passages_equal_brute_force(table):
    rng = random.Random(6)
    shared = [prose(1000 + k, 50 + 7 * k) for k in range(8)]
    texts = {}
    for i in range(120):
        parts = [prose(i, rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(shared), prose(500 + i, rng.randint(1, 60))]
        texts[i] = " \n".join(parts)
    texts |= {200: texts[7], 201: texts[7].upper(), 202: None, 203: "", 204: prose(1, 49)}
    found = repeated_passages(table(texts).repartition(4)).collect()
    assert covered(found, texts) == repeats(texts)
    assert all(r.match_id < r.doc_id for r in found)


def test_a_passage_in_a_third_of_all_texts(table, monkeypatch):
    monkeypatch.setattr(passages, "BLOCK", 16)
    hot = prose(77, 60)
    texts = {i: prose(i, 40) + " " + (hot if i % 3 == 0 else prose(900 + i, 60)) for i in range(300)}
    found = repeated_passages(table(texts).repartition(5)).collect()
    assert covered(found, texts) == repeats(texts)
    assert len(found) == 99


def test_a_line_in_many_texts_is_no_passage(table, monkeypatch):
    monkeypatch.setattr(passages, "BLOCK", 8)
    line = prose(5, 40)
    texts = {i: prose(i, 50) + " " + line + " " + prose(400 + i, 50) for i in range(60)}
    assert repeated_passages(table(texts)).collect() == []


def test_nearly_equal_passages(table):
    rng, texts, near = random.Random(3), {}, []
    for k in range(40):
        w = prose(2000 + k, 160).split()
        texts[2 * k] = prose(k, 30) + " " + " ".join(w)
        for at in (20 + k, 90 + k):
            w[at] = f"changed{rng.random()}"
        texts[2 * k + 1] = prose(100 + k, 30) + " " + " ".join(w)
        near.append(2 * k + 1)
    found = covered(repeated_passages(table(texts)).collect(), texts)
    assert all(sum(found[i]) > 0.5 * 160 for i in near)
    assert all(not any(found[i]) for i in texts if i not in near)


def test_rounds_stop_when_nothing_matches(table, monkeypatch):
    """Members of one bucket that are no copies end up compared in pairs of blocks."""
    monkeypatch.setattr(passages, "BLOCK", 4)
    line = prose(8, 40)
    texts = {i: prose(i, 60) + " " + line + " " + prose(700 + i, 60) for i in range(40)}
    texts |= {100: texts[3] + " more", 101: texts[9].replace(" ", "\n")}
    found = repeated_passages(table(texts)).collect()
    assert covered(found, texts) == repeats(texts)


def test_cutting(table):
    passage = prose(1, 60)
    texts = {1: f"A  b. {passage}\n\nEnd.", 2: f"Start,\t{passage} énd  x", 3: passage.upper()}
    docs = table(texts)
    found = repeated_passages(docs)
    cut = {r.doc_id: (r.text, r.words_left) for r in without_passages(docs, found).collect()}
    assert cut == {2: ("Start,\ténd  x", 3), 3: ("", 0)}


def test_within_one_document_is_no_repeat(table):
    assert repeated_passages(table({1: (prose(1, 60) + " ") * 3})).collect() == []


@pytest.mark.parametrize("n", [40, 49, 50, 51])
def test_the_shortest_passage(table, n):
    shared = prose(4, n)
    found = repeated_passages(table({1: "a " + shared + " b", 2: "c " + shared + " d"})).collect()
    # 49 words beside one that differs are 45 of 47 shingles, 40 words 36 of 56.
    assert [(r.doc_id, r.start_word, r.n_words) for r in found] == ([(2, 1, n)] if n > 40 else [])


def test_a_hot_passage_twice_in_one_text(table, monkeypatch):
    """Both places are found, whatever blocks the members come to."""
    monkeypatch.setattr(passages, "BLOCK", 2)
    hot = prose(77, 130)
    texts = {i: prose(i, 40) + " " + hot + " " + prose(900 + i, 60) for i in range(20)}
    texts |= {i: f"{texts[i]} {hot} {prose(800 + i, 30)}" for i in range(1, 20)}
    found = repeated_passages(table(texts)).collect()
    assert covered(found, texts) == repeats(texts)


def test_similar_to_two_that_are_not_similar(table):
    """The passage that meets a similar one first is still compared with the others."""
    w = prose(31, 60).split()
    first, third = [*w], [*w]
    first[20], third[40] = "one", "three"
    texts = {1: " ".join(first), 2: " ".join(w), 3: " ".join(third)}
    texts = {i: f"{prose(i, 40)} {t} {prose(60 + i, 40)}" for i, t in texts.items()}
    found = {r.doc_id: r for r in repeated_passages(table(texts)).collect()}
    assert (found[2].match_id, found[3].match_id) == (1, 2)
    assert found[2].n_words >= 50 and found[3].n_words >= 50


@pytest.mark.parametrize("n", [50, 55, 60])
def test_one_change_in_the_middle(table, n):
    """All are found; up to what stands alone at the ends, all of a passage is."""
    texts, near = {}, []
    for k in range(120):
        w = prose(5000 + k, n).split()
        texts[2 * k] = f"{prose(k, 20)} {' '.join(w)} {prose(300 + k, 20)}"
        w[n // 2 - 5 * (k % 2)] = "changed"
        texts[2 * k + 1] = f"{prose(600 + k, 20)} {' '.join(w)} {prose(900 + k, 20)}"
        near.append(2 * k + 1)
    found = covered(repeated_passages(table(texts)).collect(), texts)
    assert all(sum(found[i][20 : 20 + n]) >= n - 1 for i in near)
    assert all(not any(found[i]) for i in texts if i not in near)


def plain_spans(x, y, width, percent):
    """Whether each run of `x` is similar to one of `y`, by sets."""
    others = [set(y[j : j + width]) for j in range(len(y) - width + 1)]
    return [
        any(100 * len(own & o) >= percent * len(own | o) for o in others)
        for own in (set(x[i : i + width]) for i in range(len(x) - width + 1))
    ]


@pytest.mark.parametrize("seed", range(60))
def test_spans_are_those_of_similar_runs(seed, monkeypatch):
    """With and without repeated shingles, and by few searches for common ones."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 1 << 32, rng.integers(16, 60)).astype(np.uint32)
    y = x.copy()
    for _ in range(rng.integers(1, 4)):
        at, more = rng.integers(0, len(y)), rng.integers(0, 1 << 32, rng.integers(0, 5))
        y = np.concatenate((y[:at], more.astype(np.uint32), y[at + rng.integers(0, 4) :]))
    y = np.roll(y, rng.integers(0, 20)) if seed % 3 == 0 else y
    x = np.concatenate((x, x[:6])) if seed % 4 == 1 else x
    y = np.concatenate((y, y[:6])) if seed % 4 == 2 else y
    verify = passages.Verify(20, 5, 80, 5)
    monkeypatch.setattr(verify, "aligned", lambda *_: [])
    searched, isin = [], np.isin
    monkeypatch.setattr(np, "isin", lambda a, b: searched.append(1) or isin(a, b))
    found = verify.spans(x, y)
    assert len(searched) == (len(x) >= verify.width <= len(y))
    if len(x) < verify.width or len(y) < verify.width:
        assert not found
        return
    similar = plain_spans(x.tolist(), y.tolist(), verify.width, 80)
    shared, covered = isin(x, y), np.zeros(len(x), bool)
    for a, b in found:
        covered[a : b + 1] = True
    for i, is_similar in enumerate(similar):
        run = slice(i, i + verify.width)
        assert not is_similar or covered[run][shared[run]].all()
    # Every passage starts and ends with a similar run.
    for a, b in found:
        assert shared[a] and shared[b]
        starts = [i for i, s in enumerate(similar) if s and i <= a < i + verify.width]
        assert starts and any(s for s in similar[max(0, b - verify.width + 1) : b + 1])


def member(doc_id, context, spans=None):
    context = np.array(context, np.uint32).tobytes()
    return {"text_id": doc_id, "doc_id": doc_id, "before": 0, "firsts": [0], "context": context,
            "spans": spans}


@pytest.mark.parametrize("seed", range(20))
def test_blocks_find_what_pairs_find(seed):
    """All that is shared in some similar run is covered, by whatever other."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 32, 60).astype(np.uint32)
    base[40:45] = base[:5] if seed % 3 == 0 else base[40:45]
    contexts = []
    for _ in range(24):
        one = base[rng.integers(0, 12) : 60 - rng.integers(0, 12)].copy()
        for at in rng.integers(0, len(one), rng.integers(0, 4)):
            one[at : at + 3] = rng.integers(0, 40, len(one[at : at + 3]))
        contexts.append(one)
    rest = passages.Rest(20, 5, 80, 5)
    members = [member(i, c) for i, c in enumerate(contexts)]
    rows = [(1, 0, members, members[k : k + 8]) for k in (0, 8, 16)]
    got = [np.zeros(len(c), bool) for c in contexts]
    for _, doc_id, a, b, other in rest(iter(rows)):
        assert other < doc_id
        got[doc_id][a : b + 1] = True
    w = rest.width
    for i, x in enumerate(contexts):
        for y in contexts[:i]:
            for k, similar in enumerate(plain_spans(x.tolist(), y.tolist(), w, 80)):
                assert not similar or got[i][k : k + w][np.isin(x[k : k + w], y)].all()


def test_blocks_compare_little_once_all_is_found(monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 32, 80).astype(np.uint32)
    contexts = []
    for k in range(60):
        one = base.copy()
        one[k : k + 2] = rng.integers(0, 1 << 32, 2)
        contexts.append(one)
    compared, spans = [], passages.Verify.spans
    monkeypatch.setattr(
        passages.Verify, "spans", lambda *a: compared.append(1) or spans(*a)
    )
    rest = passages.Rest(50, 5, 80, 5)
    members = [member(i, c) for i, c in enumerate(contexts)]
    rows = [(1, 0, members, members[k : k + 20]) for k in (0, 20, 40)]
    found = {r[1] for r in rest(iter(rows))}
    assert found == set(range(1, 60))
    assert len(compared) < 4 * 60


def test_tables_that_nothing_reads_are_deleted(table, spark):
    folder = pathlib.Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    shared = prose(4, 60)
    texts = {i: f"{prose(i, 30)} {shared} {prose(50 + i, 30)}" for i in range(6)}
    found = repeated_passages(table(texts))
    left = {p.name.split("-")[0] for p in set(folder.iterdir()) - before}
    assert not left & {"windows", "met", "meeting", "members", "ordered", "shingles", "chains"}
    assert len(found.collect()) == 5
