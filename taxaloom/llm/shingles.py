"""Shingle sets of whole texts and their minwise signatures, as numpy arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from .common import LOWER

U = np.uint64
#: Base of the running byte hash, odd, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
#: Texts are hashed together up to this many bytes.
SLICE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.full(n, b, U)) for b in (_BASE, _INVERSE))


def _slice_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    joined = (b" ".join(texts) + b" ").translate(LOWER)
    raw = np.frombuffer(joined, np.uint8)
    power, inverse = _powers(max(SLICE * 2, 1 << (len(raw) - 1).bit_length()))
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    running = np.cumsum((raw.astype(U) + U(1)) * power[: len(raw)])
    before = np.where(start > 0, running[start - 1], U(0))
    word = mix((running[end - 1] - before) * inverse[start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))
    stops = np.cumsum([len(t) + 1 for t in texts])
    first = np.searchsorted(start, np.concatenate([[0], stops[:-1]]))
    return word, first, np.searchsorted(start, stops)


def slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    part: list[bytes] = []
    size = 0
    for t in texts:
        if part and size + len(t) > SLICE:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t) + 1
    if part:
        yield part


def words_in(texts: list[bytes]) -> list[np.ndarray]:
    """64-bit hashes of the words of each whole text, in order."""
    out = []
    for part in slices(texts):
        word, first, last = _slice_words(part)
        out += [word[a:b] for a, b in zip(first, last, strict=True)]
    return out


def _slice_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    word, first, last = _slice_words(texts)
    many = len(word) - k + 1
    if many > 0:
        grams = word[:many] * U(3)
        for j in range(1, k):
            grams = mix(grams) + word[j : j + many] * U(2 * j + 3)
        grams = mix(grams)
    out = []
    for a, b in zip(first, last, strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:  # the whole short sequence is one shingle
            whole = hashlib.blake2b(word[a:b].tobytes(), digest_size=8, person=b"short")
            out.append(np.frombuffer(whole.digest(), U))
        else:
            out.append(np.zeros(0, U))
    return out


def sets_of(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct ``k``-word shingles of each whole text.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A text of fewer
    words has its sequence as one shingle; without words the set is empty.
    """
    return [x for part in slices(texts) for x in _slice_sets(part, k)]


def digest_of(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


@lru_cache(maxsize=2)
def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1)
    return rng.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32)


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """``n`` minwise values: two sets agree in each with a chance of their Jaccard similarity."""
    by, plus = _multipliers(n)
    x = (shingles >> U(32)).astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(least, (x[i : i + 1024, None] * by + plus).min(axis=0), out=least)
    return least


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * |x and y| >= percent * |x or y|, of sorted distinct values."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < percent * len(y):
        return False
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)
