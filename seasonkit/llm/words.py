"""Words of texts as 64-bit hashes, by whole arrays of characters."""

from __future__ import annotations

import unicodedata

import numpy as np

SLICE = 1 << 20
ALONE = 0x2E80
_SPACE, _WORD, _MARK, _ALONE = range(4)


def _kind(ch: str) -> int:
    if ch.isspace() or ch < " ":
        return _SPACE
    return _WORD if ch.isalnum() or unicodedata.category(ch)[0] == "M" else _MARK


def _folded(ch: str) -> int:
    low = ch.lower()
    return ord("0") if ch.isdigit() else ord(low) if len(low) == 1 else ord(ch)


_KIND = np.array([_kind(chr(c)) for c in range(ALONE)] + [_ALONE], dtype=np.uint8)
_FOLD = np.array([_folded(chr(c)) for c in range(ALONE)], dtype=np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """A hash of each 64-bit number."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _pieces(texts: list[str]):
    """(text number, piece) with long texts cut at spaces, so that arrays stay small."""
    for i, t in enumerate(texts):
        at = 0
        while len(t) - at > SLICE:
            cut = t.find(" ", at + SLICE)
            if cut < 0:
                break
            yield i, t[at:cut]
            at = cut
        yield i, t[at:] if at else t


def _hashed(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer("\n".join(pieces).encode("utf-32-le", "replace"), dtype=np.uint32)
    kind = _KIND[np.minimum(raw, ALONE)]
    new = kind > 0
    new[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _ALONE)
    starts = np.flatnonzero(new)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    used = np.flatnonzero(kind > 0)
    low = raw[used]
    low = np.where(low < ALONE, _FOLD[np.minimum(low, ALONE - 1)], low).astype(np.uint64)
    first = np.flatnonzero(new[used])
    place = np.arange(len(used)) - np.repeat(first, np.diff(np.append(first, len(used))))
    letters = mix(low | (place.astype(np.uint64) << np.uint64(21)))
    ends = np.cumsum([len(p) + 1 for p in pieces])
    return mix(np.add.reduceat(letters, first)), np.searchsorted(ends, starts, side="right")


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and the number of its text.

    A word is a run of letters and digits, or of other marks; case is ignored and all digits
    are alike. From U+2E80 on each character is a word.
    """
    hashes, owners, group, of, size = [], [], [], [], 0

    def flush():
        h, piece = _hashed(group)
        hashes.append(h)
        owners.append(np.array(of, dtype=np.int64)[piece])

    for i, piece in _pieces(texts):
        group.append(piece)
        of.append(i)
        size += len(piece)
        if size >= SLICE:
            flush()
            group, of, size = [], [], 0
    if group:
        flush()
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(owners)
