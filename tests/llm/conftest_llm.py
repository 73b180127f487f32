"""Texts and brute-force helpers."""

import random


def prose(seed: int, n: int, letters: str = "abcdefghijklmnop") -> str:
    rng = random.Random(seed)
    return " ".join(
        "".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n)
    )


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def words(text):
    return [w.decode() for w in lower(text).encode().split()]


def shingles(text, size):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([" ".join(w)])
    return frozenset(" ".join(w[i : i + size]) for i in range(len(w) - size + 1))


def components(ids, linked):
    """The smallest id reachable from each."""
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least
