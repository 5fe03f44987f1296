"""Words of many texts at once: where they lie, and 64-bit hashes of words and shingles."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: An odd base of the polynomial hash, its inverse modulo 2^64, and odd mixing factors.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0xBF58476D1CE4E5B9)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of a word after lowering: digits, a-z, and all bytes outside ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; kept and doubled as needed."""
    table = _powers.get(base)
    if table is None or len(table) < count:
        size = 1 << max(16, (count - 1).bit_length())
        table = np.full(size, np.uint64(base))
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        _powers[base] = table
    return table[:count]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * MIX
    return values ^ (values >> np.uint64(31))


@dataclass
class Words:
    """Words of a chunk of texts: bytes, start and end of each, its text, and its hash."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``width`` words in a row, and which of them lie within one text."""
        count = len(self.hashes) - width + 1
        if count <= 0:
            return np.empty(0, np.uint64), np.empty(0, bool)
        total = np.zeros(count, np.uint64)
        for i, factor in enumerate(powers(int(MIX), width + 1)[1:]):
            total += self.hashes[i:i + count] * factor
        return mixed(total), self.text[:count] == self.text[width - 1:]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def words_of(data: np.ndarray, text_ends: np.ndarray) -> Words:
    """The words of the texts that end at ``text_ends`` in ``data``, A-Z lowered."""
    low = LOWER[data]
    inside = WORD_BYTE[low]
    first = np.zeros(len(low) + 1, bool)  # where a text begins a word cannot go on
    first[0] = True
    first[text_ends] = True
    before = np.concatenate(([False], inside))
    after = np.concatenate((inside, [False]))
    starts = np.flatnonzero(after & (~before | first))
    ends = np.flatnonzero(before & (~after | first))
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(low)), out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(low) + 1)[starts])
    return Words(low, starts, ends, np.searchsorted(text_ends, starts, "right"), hashes)
