"""Shingle sets of whole texts and their fast similarity sketches (numpy).

The sketch throws the elements of a set into ``size`` bins, round after round with
fresh hash functions, and keeps the smallest value of a bin in the first round that
reaches it; round ``size + i`` sends every element to bin i, so all bins fill. Two
sets agree in a bin with probability equal to their Jaccard similarity, and agreements
concentrate about that mean.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from nudgelab.llm.words import Words, mix, windows

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Cells of the sketch matrix that are filled at a time.
CELLS = 1_000_000


def _salt(number: int) -> np.uint64:
    return np.uint64(number * 0x9E3779B97F4A7C15 % (1 << 64))


@dataclass
class Sets:
    """Distinct shingle hashes: ``bounds[i]:bounds[i + 1]`` are those of text i, ascending."""

    values: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)


def shingle_sets(words: Words, width: int) -> Sets:
    """Distinct ``width``-word shingles of every text; a shorter text is one shingle."""
    hashes = words.hashes()
    folded, at = windows(hashes, words.bounds, width)
    starts = np.searchsorted(at, words.bounds)
    counts = np.diff(words.bounds)
    found: list[np.ndarray] = []
    for i, n in enumerate(counts):
        if n >= width:
            found.append(np.unique(folded[starts[i] : starts[i + 1]]))
        elif n:
            value = np.full(1, n, dtype=np.uint64)
            for x in hashes[words.bounds[i] : words.bounds[i + 1]]:
                value = mix(value * _GOLD + x)
            found.append(value)
        else:
            found.append(np.zeros(0, dtype=np.uint64))
    bounds = np.zeros(len(found) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in found], out=bounds[1:])
    return Sets(np.concatenate(found) if found else np.zeros(0, np.uint64), bounds)


def digests(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per set, equal exactly for equal sets (up to chance collisions)."""
    out = []
    for salt in (1, 2):
        sums = np.zeros(len(sets.sizes), dtype=np.uint64)
        full = sets.sizes > 0
        if full.any():
            sums[full] = np.add.reduceat(
                mix(sets.values + _salt(salt)), sets.bounds[:-1][full]
            )
        out.append(mix(sums + np.uint64(salt)).view(np.int64))
    return out[0], out[1]


def sketch(sets: Sets, size: int) -> np.ndarray:
    """One row of ``size`` values per set; rows of empty sets hold EMPTY."""
    out = np.full((len(sets.sizes), size), EMPTY, dtype=np.uint64)
    step = max(1, CELLS // size)
    for first in range(0, len(out), step):
        _fill(out[first : first + step], sets, first, size)
    return out


def _fill(out: np.ndarray, sets: Sets, first: int, size: int) -> None:
    """Rounds of bin placement for the sets from ``first`` on, as many as ``out`` has rows."""
    bounds = sets.bounds[first : first + len(out) + 1]
    values = sets.values[bounds[0] : bounds[-1]]
    rows = np.repeat(np.arange(len(out)), np.diff(bounds))
    flat = out.reshape(-1)
    for turn in range(2 * size):
        if not len(values):
            return
        # The round is in the high bits: what an earlier round has put down is always smaller.
        hashed = mix(values + _salt(turn + 1))
        if turn < size:
            bins = ((hashed >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
            cells = rows * size + bins.astype(np.int64)
        else:
            cells = rows * size + (turn - size)
        open_ = flat[cells] == EMPTY
        cells, hashed = cells[open_], hashed[open_]
        keys = (np.uint64(turn) << np.uint64(48)) | (mix(hashed + _GOLD) >> np.uint64(16))
        np.minimum.at(flat, cells, keys)
        done = np.ones(len(out), dtype=bool)
        done[rows] = False
        unfilled = (out == EMPTY).any(axis=1) & ~done
        if not unfilled.all():
            keep = unfilled[rows]
            values, rows = values[keep], rows[keep]


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band of ``rows`` sketch values; the band's number is part of the key."""
    parts = sketches[:, : bands * rows].reshape(len(sketches), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]) * _GOLD
    for j in range(rows):
        keys = mix(keys + parts[:, :, j])
    return keys.view(np.int64)
