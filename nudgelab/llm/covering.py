"""A covering code over 64-bit words whose codewords serve as anchors.

The code is a product of perfect cyclic codes over disjoint ranges of bits: a word of such a range
lies within the code's covering radius of exactly one codeword, found through its syndrome. An
anchor is one codeword of each range.

Words x and y at distance t have a word z between them, at most ceil(t / 2) bits from either. The
anchor nearest to z is within the covering radius plus ceil(t / 2) of both, so a word that goes to
the nearest anchors of *all* words within ceil(t / 2) of it meets every partner at some anchor.
These anchors depend, but for an exclusive or, on the syndromes alone, and are tabulated once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np

WORD_BITS = 64


@dataclass(frozen=True)
class CyclicCode:
    """A perfect binary cyclic code of ``length`` bits that corrects ``radius`` errors."""

    length: int
    generator: int
    """Generator polynomial, bit i for x^i."""
    radius: int

    @property
    def checks(self) -> int:
        return self.generator.bit_length() - 1

    @cached_property
    def single(self) -> np.ndarray:
        """Syndrome of every single bit: x^i modulo the generator."""
        out, rest = [], 1
        for _ in range(self.length):
            out.append(rest)
            rest <<= 1
            if rest >> self.checks:
                rest ^= self.generator
        return np.array(out, dtype=np.int64)

    @cached_property
    def leaders(self) -> np.ndarray:
        """The error pattern of every syndrome."""
        out = np.full(1 << self.checks, -1, dtype=np.int64)
        for weight in range(self.radius + 1):
            for bits in combinations(range(self.length), weight):
                place = int(np.bitwise_xor.reduce(self.single[list(bits)], initial=0))
                if out[place] >= 0:
                    raise ValueError("two patterns share a syndrome: the code is not perfect")
                out[place] = sum(1 << b for b in bits)
        if (out < 0).any():
            raise ValueError("a syndrome has no pattern: the code is not perfect")
        return out

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), dtype=np.int64)
        for i, s in enumerate(self.single):
            out ^= ((words >> i) & 1) * s
        return out

    def offsets(self, flips: int) -> list[list[np.ndarray]]:
        """For every syndrome and every f up to ``flips``: word XOR codeword for the codewords
        nearest to some word exactly f flips away and to none that is closer."""
        out = []
        patterns = [
            (np.array([sum(1 << b for b in bits) for bits in combinations(range(self.length), f)]),
             np.array([int(np.bitwise_xor.reduce(self.single[list(bits)], initial=0))
                       for bits in combinations(range(self.length), f)]))
            for f in range(flips + 1)
        ]
        for syndrome in range(1 << self.checks):
            seen, levels = np.zeros(0, dtype=np.int64), []
            for flipped, moved in patterns:
                reached = np.unique(flipped ^ self.leaders[syndrome ^ moved])
                levels.append(np.setdiff1d(reached, seen))
                seen = np.union1d(seen, reached)
            out.append(levels)
        return out


#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 and x^3 + x + 1, the binary Golay and Hamming codes.
GOLAY = CyclicCode(23, 0b110001110101, 3)
HAMMING = CyclicCode(7, 0b1011, 1)


class Anchors:
    """The anchors of 64-bit words for pairs at most ``threshold`` bits apart."""

    def __init__(self, threshold: int, codes: tuple[CyclicCode, ...] = (GOLAY, GOLAY, HAMMING)):
        if sum(c.length for c in codes) > WORD_BITS:
            raise ValueError("the codes need more bits than a word has")
        self.codes, self.reach = codes, (threshold + 1) // 2
        self.tables = []
        for code in codes:
            offsets = code.offsets(self.reach)
            levels = []
            for f in range(self.reach + 1):
                widest = max(len(o[f]) for o in offsets)
                table = np.full((len(offsets), widest), -1, dtype=np.int64)
                for row, o in zip(table, offsets, strict=True):
                    row[: len(o[f])] = o[f]
                levels.append(table)
            self.tables.append(levels)

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, anchors): the anchors of ``words[places[k]]``, none twice."""
        numbers = np.zeros((len(words), 1), dtype=np.int64)
        spent = np.zeros((1,), dtype=np.int64)
        start = 0
        for code, levels in zip(self.codes, self.tables, strict=True):
            part = (words >> np.uint64(start)).astype(np.int64) & ((1 << code.length) - 1)
            syndromes = code.syndromes(part)
            data = code.length - code.checks
            grown, costs = [], []
            for f, level in enumerate(levels):
                allowed = spent + f <= self.reach
                if not level.shape[1] or not allowed.any():
                    continue
                offset = level[syndromes]
                index = np.where(offset < 0, -1, (part[:, None] ^ offset) >> code.checks)
                before = numbers[:, allowed]
                both = (before[:, :, None] << data) | index[:, None, :]
                both = np.where((before[:, :, None] < 0) | (index[:, None, :] < 0), -1, both)
                grown.append(both.reshape(len(words), -1))
                costs.append(np.repeat(spent[allowed] + f, level.shape[1]))
            numbers, spent = np.concatenate(grown, axis=1), np.concatenate(costs)
            start += code.length
        places, columns = np.nonzero(numbers >= 0)
        return places, numbers[places, columns]
