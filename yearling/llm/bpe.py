"""Byte-pair encoding by backtracking over longest matches, and decoding by offsets."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

#: The vocabulary used unless another one is given.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

#: Words but letters, and parts of words, that an encoder remembers; beyond that it starts afresh.
REMEMBERED, PARTS_REMEMBERED = 150_000, 500_000

#: Marks that the split pattern makes a token of their own after letters.
MARKS = ".,;:!?"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabularies of this kind."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class Words:
    """Words of texts and the parts that the split pattern makes of them, with their ids
    remembered; `merged` gives the ids of a part that is not."""

    def __init__(self, spec: dict):
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # In the library \s means the Unicode property.
        self.pieces = regex.compile(
            split.replace("[^\\s", "[^\\p{White_Space}").replace("\\s", "\\p{White_Space}")
        )
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        cut = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.cut = regex.compile(f"({cut})") if cut else None
        self.symbols = dict(enumerate(byte_symbols()))
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def merged(self, text: str) -> Iterable[bytes]:
        """Ids, one by one, of a part as a string of symbols."""
        raise NotImplementedError

    def encode_part(self, part: str) -> bytes:
        """Ids of what the split pattern leaves together."""
        ids = self.parts.get(part)
        if ids is None:
            text = part
            if not (part.isascii() and part.isprintable()):
                text = "".join(map(self.symbols.__getitem__, part.encode()))
            ids = b"".join(self.merged(text))
            if len(self.parts) >= PARTS_REMEMBERED:
                self.parts.clear()
            self.parts[part] = ids
        return ids

    def encode_word(self, text: str) -> bytes:
        """Ids of text without ASCII white space around it, as unsigned 32-bit integers."""
        ids: list[bytes] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                ids.append(self.special[part].to_bytes(4, "little"))
                continue
            if not part.isascii():
                # Character by character, as the library does: no final sigma.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            ids.extend(map(self.encode_part, self.pieces.findall(part.lower())))
        return b"".join(ids)

    def letters_ids(self, letters: str) -> bytes | None:
        """Ids of letters alone, which are one part unless they change in other ways than
        by their case; then none."""
        if not letters.isascii():
            if not unicodedata.is_normalized("NFC", letters):
                return None
            letters = letters.replace("Σ", "σ")
        lower = letters.lower()
        if not lower.isalpha():
            return None
        return self.parts.get(lower) or self.encode_part(lower)

    def ids_of(self, word: str) -> bytes:
        """Ids of a word. Letters, as most words are, and letters with a mark after them are
        remembered as parts; any other word is remembered whole."""
        ids = None
        if word.isalpha():
            ids = self.letters_ids(word)
        elif word[-1] in MARKS and word[:-1].isalpha():
            ids = self.letters_ids(word[:-1])
            ids = ids and ids + self.encode_part(word[-1])
        ids = ids or self.known.get(word)
        if ids is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            ids = self.known[word] = self.encode_word(word)
        return ids

    def encode(self, raw: bytes | None) -> bytes:
        """Ids of a text. No token spans white space, so words are encoded once each."""
        words = raw.split() if raw else ()
        return b"".join(self.ids_of(word.decode("utf-8", "replace")) for word in words)

    def encode_many(self, raws: list[bytes | None]) -> list[bytes]:
        """Ids of several texts; every distinct word of them is looked up once.

        Letters are lower-cased first, for fewer distinct words, unless a text could
        hold a special token.
        """
        texts = [(raw if b"<|" in raw else raw.lower()) if raw else b"" for raw in raws]
        texts = pa.array(texts, pa.binary()).cast(pa.string())
        split = pc.ascii_split_whitespace(texts)
        found = split.flatten().dictionary_encode()
        distinct = found.dictionary.to_pylist()
        ids = [self.ids_of(word) if word else b"" for word in distinct]
        pool = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        words = found.indices.to_numpy()
        lengths = sizes[words]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        places = np.repeat(starts[words] - ends[:-1], lengths) + np.arange(ends[-1])
        tokens = pool[places] if len(places) else pool
        cuts = ends[split.offsets.to_numpy()].tolist()
        return [tokens[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Encoder(Words):
    """Encodes and decodes like the tokenizers library, for BPE with word ends.

    A pre-token becomes a string of single symbols; the last symbol carries the word
    end. Aho-Corasick over the reversed tokens gives the longest token that starts at
    each position, in one pass. Tokens are then taken greedily; a token may follow
    another only if merging the two texts anew would give just these two (the pair is
    compatible). If not, the next shorter token is tried, and if none is left, the last
    token is taken back. Each position fails at most once, so the work is linear. Most
    texts need no second try; for them one pass that yields only the longest tokens does.
    """

    #: Added to a symbol's code to mark the end of a word.
    END = 0x4000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        super().__init__(spec)

        vocab = model["vocab"]
        names = {token: self._inner(token, suffix) for token in vocab}
        ids = {names[token]: number for token, number in vocab.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [(names[a], names[b], names[a + b]) for a, b in merges]
        # Ranks: symbols first, then tokens in the order of their merges.
        results = {text for _, _, text in made}
        ranked = [t for t in ids if t not in results] + [text for _, _, text in made]
        self.rank = {text: r for r, text in enumerate(ranked)}
        if len(self.rank) != len(ranked):
            raise ValueError(f"two merges of {path} make the same token")
        self.ids = [ids[text] for text in ranked]
        self.packed = [number.to_bytes(4, "little") for number in self.ids]
        self.lengths = [len(text) for text in ranked]
        self.pairs = {(self.rank[a], self.rank[b]): self.rank[t] for a, b, t in made}
        self.halves = [(r, r) for r in range(len(ranked))]
        for a, b, text in made:
            self.halves[self.rank[text]] = (self.rank[a], self.rank[b])
        self.shorter = [self._prefix(text) for text in ranked]
        self.forward, self.matches = ahocorasick.Automaton(), ahocorasick.Automaton()
        for text, r in self.rank.items():
            self.forward.add_word(text, r)
            self.matches.add_word(text[::-1], r)
        self.forward.make_automaton()
        self.matches.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}

        largest = max([*vocab.values(), *self.special.values()])
        texts = [b" "] * (largest + 1)
        for token, number in [*vocab.items(), *self.special.items()]:
            texts[number] = token.encode() + b" "
        self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        self.buffer = np.frombuffer(b"".join(texts), np.uint8)

    def _inner(self, token: str, suffix: str) -> str:
        if not token.endswith(suffix) or token == suffix:
            return token
        token = token[: -len(suffix)]
        return token[:-1] + chr(ord(token[-1]) + self.END)

    def _prefix(self, text: str) -> int:
        for n in range(len(text) - 1, 0, -1):
            if text[:n] in self.rank:
                return self.rank[text[:n]]
        return -1

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges, run on the text of both tokens, end with just these two.

        Undo the later merge of the two, again and again. If the inner neighbours at the
        cut could have merged before that merge was made, the pair is not stable.
        """
        key = (a, b)
        known = self.fits.get(key)
        if known is not None:
            return known
        limit, answer = len(self.ids), True
        while True:
            joined = self.pairs.get((a, b))
            if joined is not None and joined < limit:
                answer = False
                break
            if a > b:
                limit, a = a, self.halves[a][1]
                if a == limit:
                    limit, b = b + 1, self.halves[b][0]
                    if b + 1 == limit:
                        break
            else:
                limit, b = b + 1, self.halves[b][0]
                if b + 1 == limit:
                    limit, a = a, self.halves[a][1]
                    if a == limit:
                        break
        if len(self.fits) > 1_000_000:
            self.fits.clear()
        self.fits[key] = answer
        return answer

    def merge(self, text: str) -> list[int]:
        """Ranks of the tokens of a string of symbols."""
        whole = self.rank.get(text)
        if whole is not None:
            return [whole]
        fast = self._greedy(text)
        if fast:
            return fast
        n, last = len(text), len(text) - 1
        longest = [-1] * n
        size = [0] * n
        lengths, fits = self.lengths, self.fits
        for end, r in self.matches.iter(text[::-1]):
            if lengths[r] > size[last - end]:
                size[last - end], longest[last - end] = lengths[r], r
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token, before = 0, longest[0], -1
        while at < n:
            end = at + lengths[token]
            if not dead[end]:
                fit = before < 0 or fits.get((before, token))
                if fit is None:
                    fit = self.compatible(before, token)
                if fit:
                    out.append(token)
                    at, before = end, token
                    token = longest[at] if at < n else -1
                    continue
            token = self.shorter[token]
            if token < 0:
                dead[at] = 1
                token = out.pop()
                at -= lengths[token]
                before = out[-1] if out else -1
                # Taken back: the position is dead, so a shorter one is tried.
        return out

    def _greedy(self, text: str) -> list[int]:
        """The longest tokens from left to right, if they are compatible as they are."""
        out: list[int] = []
        before, length, fits = -1, 0, self.fits
        for end, r in self.forward.iter_long(text):
            if before >= 0:
                fit = fits.get((before, r))
                if fit is None:
                    fit = self.compatible(before, r)
                if not fit:
                    return []
            out.append(r)
            length += self.lengths[r]
            if length != end + 1:
                return []
            before = r
        return out if length == len(text) else []

    def merged(self, text: str) -> Iterable[bytes]:
        text = text[:-1] + chr(ord(text[-1]) + self.END)
        return map(self.packed.__getitem__, self.merge(text))

    def decode(self, ids: bytes) -> bytes:
        """The decoded text in UTF-8: each token's slice of one buffer, by its offsets."""
        numbers = np.frombuffer(ids, "<u4")
        if not len(numbers):
            return b""
        parts = []
        for a in range(0, len(numbers), 65536):
            some = numbers[a : a + 65536]
            starts = self.offsets[some]
            sizes = self.offsets[some + 1] - starts
            ends = np.cumsum(sizes)
            places = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])
            parts.append(self.buffer[places].tobytes())
        return b"".join(parts)[:-1]


class LibraryWords(Words):
    """Encodes words by the merges of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            super().__init__(json.load(file))
        self.model = Tokenizer.from_file(path).model
        self.packed: dict[int, bytes] = {}

    def merged(self, text: str) -> list[bytes]:
        out = []
        for token in self.model.tokenize(text):
            number = token.id
            packed = self.packed.get(number)
            if packed is None:
                packed = self.packed[number] = number.to_bytes(4, "little")
            out.append(packed)
        return out


def encoded_rows(
    coder: Words, rows: Iterable[tuple], size: int = 4 << 20
) -> Iterator[tuple[tuple, bytes]]:
    """Each row, whose last value is a text, and its ids; texts are taken together up to
    a size."""
    held: list[tuple] = []
    waiting = 0
    for row in rows:
        held.append(row)
        waiting += len(row[-1] or b"")
        if waiting >= size:
            yield from zip(held, coder.encode_many([r[-1] for r in held]), strict=True)
            held, waiting = [], 0
    if held:
        yield from zip(held, coder.encode_many([r[-1] for r in held]), strict=True)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    return Encoder(path)


@lru_cache(maxsize=4)
def library_words(path: str) -> LibraryWords:
    """As `encoder`, by the library's merges and without decoding."""
    return LibraryWords(path)
