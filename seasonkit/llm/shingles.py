"""Vectorised word shingles: NumPy over the joined bytes of a batch of texts.

A word is a run of ASCII letters, ASCII digits and non-ASCII bytes; ASCII letters count without
case. A shingle is ``SHINGLE_WORDS`` words in a row, or all words of a shorter text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SHINGLE_WORDS = 5
#: Bytes of text worked on at once; a longer text is a batch of its own.
BATCH_BYTES = 500_000

_rng = np.random.default_rng(20240229)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[ord("0") : ord("9") + 1] = _IN_WORD[ord("a") : ord("z") + 1] = _IN_WORD[ord("A") : ord("Z") + 1] = True
_IN_WORD[128:] = True
_BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]
_BASE = np.uint64(0xD6E8FEB86659FD93)
_PLACE = _rng.integers(1, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def batches(lengths: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Slices of texts of these lengths, of about ``BATCH_BYTES`` each."""
    start, size, i = 0, 0, -1
    for i, n in enumerate(lengths):
        if size and size + n > BATCH_BYTES:
            yield start, i
            start, size = i, 0
        size += n
    if start <= i:
        yield start, i + 1


def shingle_hashes(texts: list[bytes], k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of every shingle of every text, in order."""
    joined = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, dtype=np.int64)
    inside = _IN_WORD[joined]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    first, last = edge[::2], edge[1::2]  # the joined bytes end in a separator
    if not len(first):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    value = _BYTE_VALUE[joined] * _powers(len(joined), _BASE)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(value, dtype=np.uint64)])
    word = mix((total[last] - total[first]) * _powers(len(joined), _INVERSE)[first] + (last - first).astype(np.uint64) * _ODD)
    owner = np.searchsorted(ends, first, side="right")
    counts = np.bincount(owner, minlength=len(texts))
    padded = np.concatenate([word, np.zeros(k, dtype=np.uint64)])
    in_text = np.arange(len(word)) - (np.cumsum(counts) - counts)[owner]
    width = np.minimum(counts[owner] - in_text, k)
    keep = (width == k) | (in_text == 0)
    at, width = np.flatnonzero(keep), width[keep]
    sums = np.zeros(len(at), dtype=np.uint64)
    for j in range(k):
        sums += np.where(width > j, padded[at + j] * _PLACE[j], np.uint64(0))
    return owner[at], mix(sums + width.astype(np.uint64))


def distinct_shingles(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, times) of the distinct shingles of each text, sorted by text, then hash."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(owner)))
