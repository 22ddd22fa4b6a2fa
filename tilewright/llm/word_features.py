"""Hashed features of words, for whole blocks of texts at once."""

from __future__ import annotations

import numpy as np

from tilewright.llm.common import mix64
from tilewright.llm.shingles import _BYTE, _LOWER, _NTH, _PLACE, _SPACE, word_hashes

#: Classes of bytes: letters by case, digits, and each other printable ASCII byte by itself.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[48:58] = 3
_CLASS[128:] = 2
#: Capitals among the code points of two bytes in UTF-8 (Latin, Greek, Cyrillic, Armenian).
_CAPITAL = np.array([chr(c).isupper() for c in range(1 << 11)])


class Words:
    """The words of a block: where they begin and end, their text, their hashes and shapes."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data = data
        inside = ~_SPACE[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = at[:-1][at[:-1] < len(data)]
        first[cuts] = inside[cuts]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:]
        self.begin, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.counts = np.diff(np.searchsorted(self.begin, at))
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)
        self.hashes = word_hashes(data, at)[0]

    def prefixes(self, size: int) -> np.ndarray:
        """Hashes of the first size bytes in lower case; 0 for words without more than these."""
        long = np.flatnonzero(self.end - self.begin > size)
        out = np.zeros(len(self.begin), np.uint64)
        value = np.full(len(long), size, np.uint64)
        for j in range(size):
            value += _BYTE[_LOWER[self.data[self.begin[long] + j]]] * _PLACE[j]
        out[long] = mix64(value ^ np.uint64(0x632BE59BD9B4E019))
        return out

    def leads(self) -> np.ndarray:
        """The bytes that begin a code point."""
        return (self.data & 0xC0) != 0x80

    def classes(self) -> np.ndarray:
        """The class of each byte; the bytes of a capital of two bytes count as capitals."""
        out = _CLASS[self.data]
        lead = np.flatnonzero((self.data[:-1] >= 0xC2) & (self.data[:-1] < 0xE0)) if len(self.data) > 1 else np.zeros(0, np.int64)
        capital = lead[_CAPITAL[(self.data[lead].astype(np.int64) & 31) << 6 | self.data[lead + 1] & 63]]
        out[capital] = 1
        out[capital + 1] = 1
        return out

    def shapes(self) -> np.ndarray:
        """A hash of each word's classes with runs drawn together."""
        if not len(self.begin):
            return np.zeros(0, np.uint64)
        kind = self.classes()
        inside = np.zeros(len(self.data) + 1, np.int32)
        inside[self.begin] += 1
        inside[self.end] -= 1
        body = np.cumsum(inside)[:-1] > 0
        turn = body.copy()
        turn[1:] &= kind[1:] != kind[:-1]
        turn[self.begin] = True
        spots = np.flatnonzero(turn)
        starts = np.searchsorted(spots, self.begin)
        place = np.arange(len(spots)) - np.repeat(starts, np.diff(np.append(starts, len(spots))))
        value = _BYTE[kind[spots]] * _NTH[np.minimum(place, 62)]
        return mix64(np.add.reduceat(value, starts))

    def mean(self, flag: np.ndarray) -> np.ndarray:
        """The share of each text's words with the flag; 0 without words."""
        total = np.bincount(self.text, weights=flag, minlength=len(self.counts))
        return total / np.maximum(self.counts, 1)

    def repeats(self) -> np.ndarray:
        """Words equal to the one before."""
        out = np.zeros(len(self.hashes), bool)
        out[1:] = (self.hashes[1:] == self.hashes[:-1]) & (self.text[1:] == self.text[:-1])
        return out
