"""A word-level FM-index of one shard of texts (numpy, all queries at a time).

Suffixes are sorted by packed words and then by doubling; every text ends with a terminator of
its own, so a comparison never runs past a text. The transform is kept as a wavelet matrix of
bit vectors with ranks. Suffix positions are sampled every ``RATE`` words and at text starts.
"""

from __future__ import annotations

import numpy as np

RATE = 16


class Bits:
    """A bit vector that counts its ones before any position."""

    def __init__(self, bits: np.ndarray):
        self.size = len(bits)
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
        padded[: len(packed)] = packed
        self.words = padded.view(np.uint64)
        self.before = np.zeros(len(self.words), dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words)[:-1], out=self.before[1:])

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of position i."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)


def suffix_order(codes: np.ndarray, ends: np.ndarray, n_words: int) -> np.ndarray:
    """Order of all suffixes. ``codes``: words from 0 on, -1 at the terminators in ``ends``."""
    n, texts = len(codes), len(ends)
    symbols = codes.astype(np.int64) + texts
    symbols[ends] = np.arange(texts)
    width = max(1, int(n_words + texts).bit_length())
    packed = max(1, 62 // width)
    key = symbols.copy()
    for j in range(1, packed):
        key <<= width
        key[: max(0, n - j)] |= symbols[j:]
    order = np.argsort(key)
    ranks = np.empty(n, dtype=np.int64)
    key = key[order]
    slots = np.arange(n)
    suffixes, depth = order, packed
    while True:
        fresh = np.ones(len(key), dtype=bool)
        np.not_equal(key[1:], key[:-1], out=fresh[1:])
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, len(key)))
        ranks[suffixes] = np.repeat(slots[starts], sizes)
        tied = np.repeat(sizes > 1, sizes)
        if not tied.any():
            return order
        slots, suffixes = slots[tied], suffixes[tied]
        key = (ranks[suffixes] << 32) | ranks[suffixes + depth]
        turn = np.argsort(key)
        key, suffixes = key[turn], suffixes[turn]
        order[slots] = suffixes
        depth *= 2


class FMIndex:
    """Counts and finds phrases of word codes in the texts given by ``codes`` and ``bounds``."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray, n_words: int):
        counts = np.diff(bounds)
        self.starts = bounds[:-1] + np.arange(len(counts))
        ends = bounds[1:] + np.arange(len(counts))
        text = np.full(len(codes) + len(counts), -1, dtype=np.int32)
        inside = np.ones(len(text), dtype=bool)
        inside[ends] = False
        text[inside] = codes
        self.size = len(text)
        order = suffix_order(text, ends, n_words)
        symbols = text + 1
        self.below = np.zeros(n_words + 2, dtype=np.int64)
        np.cumsum(np.bincount(symbols, minlength=n_words + 1), out=self.below[1:])
        row = symbols[order - 1]
        row[order == 0] = 0
        sampled = (order % RATE == 0) | (row == 0)
        self.sampled, self.samples = Bits(sampled), order[sampled]
        self.levels: list[tuple[int, int, Bits]] = []
        for shift in range(max(1, n_words.bit_length()) - 1, -1, -1):
            bits = (row >> shift) & 1 == 1
            left = row[~bits]
            self.levels.append((shift, len(left), Bits(bits)))
            row = np.concatenate([left, row[bits]])
        first = np.ones(len(row), dtype=bool)
        first[1:] = row[1:] != row[:-1]
        self.bottom = np.zeros(n_words + 1, dtype=np.int64)
        self.bottom[row[first]] = np.flatnonzero(first)

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands in front of row i of the transform."""
        for shift, zeros, bits in self.levels:
            one = (symbols >> shift) & 1 == 1
            ones = bits.ones(i)
            i = np.where(one, zeros + ones, i - ones)
        return i - self.bottom[symbols]

    def step(self, rows: np.ndarray) -> np.ndarray:
        """Rows of the suffixes that begin one word earlier."""
        symbols, i = np.zeros(len(rows), dtype=np.int64), rows
        for shift, zeros, bits in self.levels:
            one, ones = bits.at(i), bits.ones(i)
            symbols |= one.astype(np.int64) << shift
            i = np.where(one, zeros + ones, i - ones)
        return self.below[symbols] + i - self.bottom[symbols]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of rows that begin with each phrase; a code below 0 occurs nowhere."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            going = np.flatnonzero((lengths >= back) & (low < high))
            codes = phrases[going, lengths[going] - back].astype(np.int64)
            high[going[codes < 0]] = 0
            low[going[codes < 0]] = 0
            going, codes = going[codes >= 0], codes[codes >= 0] + 1
            both = self.rank(np.tile(codes, 2), np.concatenate([low[going], high[going]]))
            both += np.tile(self.below[codes], 2)
            low[going], high[going] = both[: len(going)], both[len(going) :]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where in the texts the suffixes of these rows begin."""
        found = np.empty(len(rows), dtype=np.int64)
        waiting, steps = np.arange(len(rows)), 0
        while len(waiting):
            here = self.sampled.at(rows)
            found[waiting[here]] = self.samples[self.sampled.ones(rows[here])] + steps
            waiting, rows, steps = waiting[~here], self.step(rows[~here]), steps + 1
        return found
