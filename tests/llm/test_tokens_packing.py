import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from yearling.llm.bpe import WORD_BPE, encoder, library_words
from yearling.llm.packing import best_fit, pack, pack_lengths, reduce_by_dominance
from yearling.llm.tokens import encoded, token_digests

LIBRARY = Tokenizer.from_file(WORD_BPE)
LIBRARY.no_truncation()
LIBRARY.no_padding()
LETTERS = (
    " abcdefghijklmnopqrstuvwxyzABCXYZ0123456789'éüñÖßΣςİ"
    "中文語한́̀\x1c\x85\xa0 \n\t!?.<|>&\U0001f600ſﬁ"
)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def random_texts(n):
    rng = random.Random(2)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 80))) for _ in range(n)]
    texts += [t + "<|endoftext|>" + t + "'s<|startoftext|>" for t in texts[: n // 20]]
    texts += ["<|ENDOFTEXT|> x", "a" * 5000, "th" * 3000 + "in", "don't we'll I'VE", "KK"]
    return texts


def test_encoder_equals_the_library():
    coder, texts = encoder(WORD_BPE), random_texts(4000)
    raws = [t.encode() for t in texts]
    for text, ids in zip(texts, coder.encode_many(raws), strict=True):
        want = ids_of(text)
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert ids == coder.encode(text.encode())
        assert coder.decode(ids).decode() == LIBRARY.decode(want, skip_special_tokens=False)


def test_words_of_packing_equal_the_library():
    coder, texts = library_words(WORD_BPE), random_texts(4000)
    for text, ids in zip(texts, coder.encode_many([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(text), text


@pytest.mark.parametrize("coder_of", [encoder, library_words])
def test_letters_of_any_script_are_not_split(coder_of, monkeypatch):
    text = "Größe, élan! ΟΔΟΣ 中文 naïve Cafe\u0301 İz e\u0301"
    coder, split = coder_of(WORD_BPE), []
    whole = type(coder).encode_word

    def encode_word(self, word):
        split.append(word)
        return whole(self, word)

    monkeypatch.setattr(type(coder), "encode_word", encode_word)
    coder.known.clear()
    [ids] = coder.encode_many([text.encode()])
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(text)
    # Only words that are more than their letters in lower case.
    assert sorted(split) == sorted(["cafe\u0301", "İz", "e\u0301"])


def test_every_token_encodes_to_itself():
    coder = encoder(WORD_BPE)
    for text, r in list(coder.rank.items())[::7]:
        if len(text) > 1 and ord(text[-1]) >= coder.END:
            a, b = coder.halves[r]
            assert coder.compatible(a, b) is False
            assert coder.merge(text) == [r]


def test_digests(table):
    texts = dict(enumerate([None, "", *random_texts(60)]))
    for r in token_digests(table(texts)).collect():
        ids = ids_of(texts[r.doc_id])
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids),
            hashlib.sha256(packed).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )
    first = encoded(table({1: "Hello there"})).first()
    assert np.frombuffer(first.ids, "<u4").tolist() == ids_of("Hello there")


def optimum(items, capacity):
    """The least number of bins, by search."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in sorted({b: j for j, b in enumerate(bins)}.values()):
            if bins[k] >= items[i]:
                place(i + 1, [*bins[:k], bins[k] - items[i], *bins[k + 1 :]])
        place(i + 1, [*bins, capacity - items[i]])

    place(0, [])
    return best[0]


def test_reduction_keeps_an_optimum():
    rng = random.Random(8)
    for _ in range(150):
        capacity = rng.randint(8, 30)
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        counts = dict(Counter(items))
        fixed = reduce_by_dominance(counts, capacity)
        rest = [length for length, n in counts.items() for _ in range(n)]
        bins = sum(times for times, _ in fixed)
        assert bins + (optimum(rest, capacity) if rest else 0) == optimum(items, capacity)


def test_every_piece_is_placed_once():
    rng = random.Random(9)
    for _ in range(100):
        capacity = rng.randint(5, 60)
        counts = {rng.randint(1, capacity): rng.randint(1, 50) for _ in range(12)}
        placed = Counter()
        for times, pattern in pack_lengths(counts, capacity):
            assert times > 0 and sum(length * n for length, n in pattern) <= capacity
            for length, n in pattern:
                placed[length] += times * n
        assert placed == counts
    assert best_fit({}, 10) == []


def test_packing_is_exact(table):
    rng = random.Random(4)
    texts = {i: " ".join(["the"] * rng.choice([0, 1, 5, 30, 99, 100, 250])) for i in range(300)}
    texts |= {300: None, 301: "the " * 2047, 302: "the " * 2048, 303: "the cat " * 5000}
    found = pack(table(texts).repartition(5)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, text in texts.items():
        ids = ids_of(text) + [0]
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 2048)))
        for r in own:
            part = np.array(ids[r.start : r.start + 2048], "<u4")
            assert (r.start, r.length) == (2048 * r.piece, len(part))
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in found)
    assert len(sequences) == pytest.approx(-(-total // 2048), abs=1)
