"""Word shingles of many texts at once, as hashes in NumPy arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(ODD), -1, 2**64))
_BREAKS = np.zeros(256, bool)
_BREAKS[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in a row, and the text it belongs to. White space separates words."""
    coded = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join([b"", *coded, b""]), np.uint8)
    gap = _BREAKS[data]
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    # Differences of sums of byte * base^-position, moved back to position 0, are hashes of the bytes between.
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(INVERSE, len(data)))])
    hashes = mix((sums[ends] - sums[starts]) * powers(ODD, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))
    sizes = np.array([len(c) + 1 for c in coded], np.int64)
    owner = np.searchsorted(np.cumsum(sizes), starts - 1, side="right")
    return hashes, owner


def shingle_hashes(texts: Sequence[str], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of the texts in a row, and the text it belongs to.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    hashes, owner = word_hashes(texts)
    n = len(hashes)
    total = np.zeros(n, np.uint64)
    full = np.ones(n, bool)
    for k in range(words):
        ahead, same = np.zeros(n, np.uint64), np.zeros(n, bool)
        if n > k:
            ahead[: n - k], same[: n - k] = hashes[k:], owner[k:] == owner[: n - k]
        total = total * ODD + np.where(same, mix(ahead + np.uint64(k)), np.uint64(0))
        full &= same
    first = np.ones(n, bool)
    first[1:] = owner[1:] != owner[:-1]
    take = full | (first & ~full)
    return mix(total[take]), owner[take]


def bags(texts: Sequence[str], words: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts: text, hash and count, ordered by text and hash."""
    hashes, owner = shingle_hashes(texts, words)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(hashes)))


def occurrences(texts: Sequence[str], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Multisets as sets: text and key of every shingle, where the key of the n-th equal shingle holds n as well."""
    owner, hashes, counts = bags(texts, words)
    ends = np.cumsum(counts)
    nth = (np.arange(len(owner) and ends[-1]) - np.repeat(ends - counts, counts)).astype(np.uint64)
    return np.repeat(owner, counts), mix(np.repeat(hashes, counts) + nth * ODD)


def pairwise_similarity(texts: Sequence[str], words: int = 5, columns: int = 4096) -> np.ndarray:
    """Weighted Jaccard similarity of the shingle multisets of every two texts; texts without words are like none.

    Shared occurrences are counted by products of 0/1 matrices, ``columns`` keys at a time.
    """
    owner, keys = occurrences(texts, words)
    n = len(texts)
    sizes = np.bincount(owner, minlength=n).astype(np.float64)
    _, at, held = np.unique(keys, return_inverse=True, return_counts=True)
    both = held[at] > 1
    owner, at = owner[both], at[both]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    number = np.cumsum(np.concatenate([[0], at[1:] != at[:-1]])) if len(at) else at
    shared = np.zeros((n, n), np.float32)
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, columns):
        a, b = np.searchsorted(number, [low, low + columns])
        part = np.zeros((n, columns), np.float32)
        part[owner[a:b], number[a:b] - low] = 1
        shared += part @ part.T
    np.fill_diagonal(shared, sizes)  # keys of one text only were left out above
    return shared / np.maximum(sizes[:, None] + sizes[None, :] - shared, 1)
