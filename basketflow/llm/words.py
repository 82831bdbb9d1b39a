"""Words between ASCII white space, hashed for many texts at once."""

from __future__ import annotations

import numpy as np

_GAP = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of MurmurHash3)."""
    h = np.asarray(h, dtype=np.uint64)
    h = (h ^ (h >> np.uint64(33))) * _A
    h = (h ^ (h >> np.uint64(33))) * _B
    return h ^ (h >> np.uint64(33))


def odd(n: int, seed: int) -> np.ndarray:
    """``n`` odd multipliers."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def hash_words(texts: list[str], fold: bool = False, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word and the number of words of each text; ``fold`` lower-cases A-Z."""
    raw = [t.encode() for t in texts]
    b = np.frombuffer(b" " + b" ".join(raw) + b" ", dtype=np.uint8)
    inside = ~_GAP[b]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begins, ends = change[0::2], change[1::2]
    text_ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([[0], np.searchsorted(begins, text_ends)])).astype(np.int64)
    if not len(begins):
        return np.zeros(0, np.uint64), counts
    sizes = ends - begins
    at = np.flatnonzero(inside)
    starts = np.cumsum(sizes) - sizes
    powers = np.cumprod(np.full(int(sizes.max()), odd(1, seed)[0], dtype=np.uint64))
    letters = (_LOWER[b[at]] if fold else b[at]).astype(np.uint64) + np.uint64(1)
    letters *= powers[np.arange(len(at)) - np.repeat(starts, sizes)]
    return mixed(np.add.reduceat(letters, starts) + sizes.astype(np.uint64)), counts


def windows(words: np.ndarray, counts: np.ndarray, size: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``size`` words in a row, and the index of the first; windows lie within one text."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, dtype=np.uint64)
    for k, factor in enumerate(odd(size, seed)):
        total += words[k : k + n] * factor
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.flatnonzero(text[:n] == text[size - 1 :])
    return mixed(total[first]), first


def shingle_sets(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted within each, and how many each text has.

    Words are lower-cased in A-Z. A text of fewer than ``size`` words has its whole sequence as one shingle,
    one without words has none.
    """
    words, counts = hash_words(texts, fold=True)
    hashes, first = windows(words, counts, size)
    text_of = np.repeat(np.arange(len(counts)), counts)
    owners = text_of[first]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        starts = (np.cumsum(counts) - counts)[short]
        whole = np.zeros(len(short), dtype=np.uint64)
        for k, factor in enumerate(odd(size, 5)[: size - 1]):
            has = counts[short] > k
            whole[has] += words[starts[has] + k] * factor
        hashes = np.concatenate([hashes, mixed(whole + counts[short].astype(np.uint64))])
        owners = np.concatenate([owners, short])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], np.bincount(owners[new], minlength=len(texts)).astype(np.int64)
