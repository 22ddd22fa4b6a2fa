"""Sets of word shingles as 64-bit hashes, for whole blocks of texts at once."""

from __future__ import annotations

import numpy as np

from tilewright.llm.common import mix64

WORDS = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_PLACE = mix64(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
_NTH = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)) | np.uint64(1)


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with A-Z in lower case, and the number of words of each text."""
    data = _LOWER[data]
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = at[:-1][at[:-1] < len(data)]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, at))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    body = np.flatnonzero(inside)
    begin = np.flatnonzero(first[body])
    lengths = np.diff(np.append(begin, len(body)))
    place = np.arange(len(body)) - np.repeat(begin, lengths)
    value = _BYTE[data[body]]
    if lengths.max() > 4096:
        value = value ^ mix64((place >> 12).astype(np.uint64))
    value *= _PLACE[place & 4095]
    return mix64(np.add.reduceat(value, begin) + lengths.astype(np.uint64)), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, repeats included, and their number in each text.

    A text of fewer words is one shingle, without words it has none.
    """
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    starts = np.cumsum(counts) - counts
    pick = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    left = np.repeat(np.minimum(counts, size), n)
    out = np.zeros(len(pick), np.uint64)
    for j in range(size):
        out += np.where(left > j, padded[pick + j] * _NTH[j], np.uint64(0))
    return mix64(out + left.astype(np.uint64) * _NTH[63]), n


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int = WORDS) -> tuple[list[np.ndarray], np.ndarray]:
    """The sorted distinct shingle hashes of each text, and their numbers."""
    hashes, n = shingle_hashes(*word_hashes(data, at), size)
    ends = np.cumsum(n)
    sets = [np.unique(hashes[e - k : e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
    return sets, np.fromiter(map(len, sets), np.int64, len(sets))
