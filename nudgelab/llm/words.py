"""Words of whole text columns as flat numpy arrays over Arrow buffers.

One pass over the bytes of a batch finds all words of all its texts; nothing is
done per row in Python. Null texts have no words. A batch is cut into pieces of
bounded size first (a text longer than a piece is a piece of its own), so memory
follows the piece and the longest text, never the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 3_000_000

_SPACE = np.ones(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@dataclass
class Words:
    """Words of some texts: ``bounds[i]:bounds[i + 1]`` are those of text i."""

    codes: np.ndarray
    """Index into ``vocabulary`` of every word."""
    vocabulary: pa.Array
    """Distinct words as bytes."""
    bounds: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, equal in all tasks."""
        return vocabulary_hashes(self.vocabulary)[self.codes]

    def owners(self) -> np.ndarray:
        """Text number of every word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def vocabulary_hashes(vocabulary: pa.Array) -> np.ndarray:
    if not len(vocabulary):
        return np.zeros(0, dtype=np.uint64)
    return pd.util.hash_array(vocabulary.to_numpy(zero_copy_only=False), categorize=False)


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = PIECE_BYTES):
    """Cut batches so that no piece but a single text holds more than ``most`` bytes."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy())
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch
        pa.default_memory_pool().release_unused()


def give_back() -> None:
    """Return freed memory to the system: workers live on, and a peak would stay theirs for good."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim is not None:
        trim(0)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, one after another, and where each text begins and ends."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def edges(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``mask`` that stay inside one text."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = offsets[(offsets > 0) & (offsets < len(mask))]
    before = np.empty(len(mask), dtype=bool)
    before[0] = False
    before[1:] = mask[:-1]
    before[inner] = False
    after = np.empty(len(mask), dtype=bool)
    after[-1] = False
    after[:-1] = mask[1:]
    after[inner - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def split(texts: pa.Array, alnum: bool = False, lower: bool = True) -> Words:
    """Words of every text.

    A word is a longest run of bytes other than space and 0x09-0x0D, or with
    ``alnum`` of digits, ASCII letters and bytes from 0x80; ``lower`` lower-cases
    A-Z before that.
    """
    data, offsets = text_bytes(texts)
    if lower or alnum:
        data = _LOWER[data]
    mask = (_ALNUM if alnum else _SPACE)[data]
    starts, ends = edges(mask, offsets)
    inside = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=inside[1:])
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(inside), pa.py_buffer(data[mask])]
    ).dictionary_encode()
    bounds = np.searchsorted(starts, offsets)
    return Words(words.indices.to_numpy(), words.dictionary, bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def windows(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside one text, and the first word of each."""
    n = max(0, len(hashes) - width + 1)
    valid = np.ones(len(hashes), dtype=bool)
    ends = bounds[1:]
    for j in range(1, width):
        at = ends - j
        valid[at[at >= bounds[:-1]]] = False
    folded = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n] + np.uint64(j + 1))
    at = np.flatnonzero(valid[:n])
    return folded[at], at
