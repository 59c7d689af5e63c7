"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE, INVERSE = U(0x9E3779B97F4A7C15), U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = U(0xD6E8FEB86659FD93)

#: ASCII letters and digits and every byte of a longer UTF-8 sequence belong to words.
IN_WORD = np.array([chr(b).isalnum() or b >= 0x80 for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that each bit depends on all."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, dtype=U)
    out[:1] = 1
    return np.cumprod(out, dtype=U)


#: Powers of the base and its inverse for up to this many bytes are kept.
KEPT = 1 << 21
TABLES: dict[int, np.ndarray] = {}


def kept_powers(base: np.uint64, n: int) -> np.ndarray:
    """``powers``, from a table unless they are very many."""
    if n > KEPT:
        return powers(base, n)
    held = TABLES.get(int(base))
    if held is None or len(held) < n:
        TABLES[int(base)] = held = powers(base, min(KEPT, 2 * n))
    return held[:n]


def words(docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the number of words of each text."""
    encoded = [t.lower().encode() for t in docs]
    a = np.frombuffer(b" ".join(encoded) + b" ", dtype=np.uint8)
    inside = IN_WORD[a]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    start, end = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, U), np.cumsum((a.astype(U) + U(1)) * kept_powers(BASE, len(a)), dtype=U)])
    back = kept_powers(INVERSE, len(a))
    hashes = mix((sums[end] - sums[start]) * back[start] + (end - start).astype(U))
    borders = np.cumsum([len(b) + 1 for b in encoded])
    return hashes, np.diff(np.searchsorted(start, borders), prepend=0)


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of k words of each text: (text number, hash, mean weight of the words).

    A text of fewer than k words is one shingle of all its words, a text without words has none.
    """
    ends = np.cumsum(counts)
    first = ends - counts
    size = np.minimum(counts, k)
    n = np.where(counts > 0, counts - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + first[doc]
    length = size[doc]
    total, weight = length.astype(U), np.zeros(len(at))
    whole = length == k
    for j in range(k):
        if len(hashes):
            i = np.minimum(at + j, len(hashes) - 1)
            word = hashes[i]
            step, more = (total ^ word) * STEP + (word >> U(7)), weight + weights[i]
            if not whole.all():
                there = whole | (j < length)
                step, more = np.where(there, step, total), np.where(there, more, weight)
            total, weight = step, more
    return doc, mix(total), weight / np.maximum(length, 1)


def weighted_sets(docs: list[str], k: int, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted: (text number, hash, count x mean idf of its words)."""
    hashes, counts = words(docs)
    doc, h, w = shingles(hashes, counts, k, idf[buckets(hashes, len(idf))])
    order = np.argsort(h)  # equal hashes of a text have equal weights
    order = order[np.argsort(doc[order].astype(np.uint16) if len(docs) < 1 << 16 else doc[order], kind="stable")]
    doc, h, w = doc[order], h[order], w[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    return doc[at], h[at], w[at] * tf


def buckets(hashes: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each word in a table of n (a power of two)."""
    return (hashes >> U(64 - int(n).bit_length() + 1)).astype(np.int64)
