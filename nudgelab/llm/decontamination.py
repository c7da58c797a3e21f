"""Benchmark passages in documents, found in an FM-index per shard of documents.

A task indexes its documents in shards of ``SHARD_BYTES`` of text (a longer text is a shard of its
own): every word of every text, whatever the benchmark holds. All benchmark windows are searched
backwards in the index, occurrences are located by sampled suffix positions, and overlapping or
touching ones are merged to spans. A document lies in one shard, so nothing is shuffled.

The benchmark is a stated query set. It is read in blocks of ``BLOCK_ITEMS`` items, each its own
broadcast of at most ``BLOCK_ITEMS`` items. A task holds one block at a time: with several, it lets
go of a block after each search and reads it again from the executor's disk for the next shard.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nudgelab.llm.common import as_batch, id_and_text, quoted
from nudgelab.llm.fmindex import FMIndex
from nudgelab.llm.words import Words, edges, give_back, pieces, split, text_bytes
from nudgelab.llm.words import _ALNUM as WORD_BYTES
from nudgelab.llm.words import _LOWER as LOWER

WINDOW = 10
SHARD_BYTES = 4_000_000
BLOCK_ITEMS = 20_000

_MATCHES = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<first:long,last:long>>"


@dataclass
class Phrases:
    """Windows of some benchmark items; window i belongs to item ``owners[i]``."""

    vocabulary: pa.Array
    codes: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray
    items: list[str | None]


def phrases_of(items: list[str | None], texts: list[str], window: int) -> Phrases:
    """All windows of the items; an item of fewer words is one window, one of none has no window."""
    words = split(pa.array(texts, pa.string()), alnum=True)
    rows, lengths, owners = [], [], []
    for i, (a, b) in enumerate(itertools.pairwise(words.bounds)):
        own = words.codes[a:b]
        if 0 < len(own) < window:
            rows.append(np.concatenate([own, np.full(window - len(own), -1, own.dtype)])[None])
            lengths.append([len(own)])
        elif len(own):
            rows.append(np.lib.stride_tricks.sliding_window_view(own, window))
            lengths.append([window] * len(rows[-1]))
        else:
            continue
        owners.append([i] * len(lengths[-1]))
    codes = np.concatenate(rows) if rows else np.zeros((0, window), np.int32)
    flat = lambda lists: np.array([x for y in lists for x in y], dtype=np.int64)
    return Phrases(words.vocabulary, codes, flat(lengths), flat(owners), items)


def benchmark_blocks(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> list:
    """Broadcast phrases of the benchmark, block by block; rows without words have none."""
    rows = benchmark.select(
        F.col(quoted(id_col)).cast("string").alias("item"),
        F.col(quoted(text_col)).cast("string").alias("text"),
    ).where("text is not null")
    context, blocks = benchmark.sparkSession.sparkContext, []
    incoming = rows.toLocalIterator()
    while part := list(itertools.islice(incoming, BLOCK_ITEMS)):
        found = phrases_of([r.item for r in part], [r.text for r in part], window)
        blocks.append(context.broadcast(vars(found)))
    return blocks


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Return (doc_id, n_words, n_hit, items, spans), one row per document row.

    Words are runs of digits, letters and bytes from 0x80 after lower-casing A-Z. ``n_hit`` counts
    the words inside any occurrence of a window, ``items`` holds the ids (as text, sorted) of the
    items that occur, and ``spans`` the merged runs of hit words, first and last word from 0 on.
    Null and empty texts have no words; a null id stays null; repeated rows are answered alike;
    item rows that share an id are one item; the windows of an item without an id are hit like any
    other, but the item is not listed; an empty benchmark hits nothing. Other columns are not read.
    """
    blocks = benchmark_blocks(benchmark, window, item_col, item_text_col)
    return id_and_text(docs, id_col, text_col).mapInArrow(_match_batches(blocks), _MATCHES)


def contaminated(items: Column) -> Column:
    return F.size(items) > 0


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
    length_col: str = "n_chars", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``docs`` with all hit spans cut out of the texts, all other columns as they were.

    A span reaches from its first to the end of its last word. Rows whose text holds no word after
    a cut are dropped; ``length_col``, if there, is set to the new length of a cut text. Rows that
    hold no benchmark passage stay as they are, null and empty texts included.
    """
    blocks = benchmark_blocks(benchmark, window, item_col, item_text_col)
    return docs.mapInArrow(_cut_batches(blocks, text_col, length_col), docs.schema)


@dataclass
class Hits:
    """Per word whether it is hit, and the (text, item) pairs that were found."""

    words: Words
    hit: np.ndarray
    found: set[tuple[int, str]]


def _one_at_a_time(blocks) -> Iterator[Phrases]:
    for block in blocks:
        yield Phrases(**block.value)
        if len(blocks) > 1 and getattr(block, "_path", None):
            # The broadcast's file stays on the executor's disk; what was read of it goes.
            vars(block).pop("_value", None)


def find(texts: pa.Array, blocks) -> Hits:
    """Index the texts and search all phrases of all blocks in them."""
    words = split(texts, alnum=True)
    depth = np.zeros(len(words.codes) + len(words.bounds), dtype=np.int64)
    found: set[tuple[int, str]] = set()
    index = FMIndex(words.codes, words.bounds, len(words.vocabulary)) if len(words.codes) else None
    for phrases in _one_at_a_time(blocks) if index else ():
        known = pc.index_in(phrases.vocabulary, value_set=words.vocabulary)
        known = np.append(pc.fill_null(known, -1).to_numpy(zero_copy_only=False), -1)
        low, high = index.search(known[phrases.codes], phrases.lengths)
        counts = high - low
        if not counts.any():
            continue
        window = np.repeat(np.arange(len(counts)), counts)
        first = np.repeat(np.cumsum(counts) - counts, counts)
        at = index.locate(np.repeat(low, counts) + np.arange(len(window)) - first)
        np.add.at(depth, at, 1)
        np.add.at(depth, at + phrases.lengths[window], -1)
        text = np.searchsorted(index.starts, at, side="right") - 1
        pairs = np.unique(np.stack([text, phrases.owners[window]]), axis=1)
        found.update((int(t), phrases.items[i]) for t, i in pairs.T if phrases.items[i] is not None)
    inside = np.ones(len(depth) - 1, dtype=bool)
    inside[words.bounds[1:] + np.arange(len(words.bounds) - 1)] = False
    return Hits(words, (np.cumsum(depth)[:-1] > 0)[inside], found)


def runs(hit: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of hit words inside one text: first word, end, and the text's number."""
    starts, ends = edges(hit, bounds)
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def _match_batches(blocks):
    span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())), ("spans", pa.list_(span)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", SHARD_BYTES):
            hits = find(piece.column("text"), blocks)
            give_back()
            bounds = hits.words.bounds
            total = np.concatenate([[0], np.cumsum(hits.hit)])
            items: list[list[str]] = [[] for _ in range(piece.num_rows)]
            spans: list[list[dict]] = [[] for _ in range(piece.num_rows)]
            for text, item in hits.found:
                items[text].append(item)
            for a, b, text in zip(*runs(hits.hit, bounds), strict=True):
                spans[text].append({"first": a - bounds[text], "last": b - 1 - bounds[text]})
            yield as_batch(
                {
                    "doc_id": piece.column("doc_id"), "n_words": np.diff(bounds),
                    "n_hit": total[bounds[1:]] - total[bounds[:-1]],
                    "items": [sorted(x) for x in items], "spans": spans,
                },
                schema,
            )

    return run


def _cut_batches(blocks, text_col: str, length_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text_col, SHARD_BYTES):
            texts = piece.column(text_col)
            hits = find(texts, blocks)
            give_back()
            if not hits.hit.any():
                yield piece
                continue
            data, offsets = text_bytes(texts)
            starts, ends = edges(WORD_BYTES[LOWER[data]], offsets)
            gone = np.zeros(len(data) + 1, dtype=np.int32)
            first, stop, owner = runs(hits.hit, hits.words.bounds)
            gone[starts[first]] += 1
            gone[ends[stop - 1]] -= 1
            stay = np.cumsum(gone)[:-1] == 0
            total = np.concatenate([[0], np.cumsum(hits.hit)])
            bounds = hits.words.bounds
            emptied = set(np.flatnonzero(np.diff(bounds) == total[bounds[1:]] - total[bounds[:-1]]))
            new = texts.to_pylist()
            touched = sorted(set(owner.tolist()))
            for i in touched:
                own = slice(offsets[i], offsets[i + 1])
                new[i] = data[own][stay[own]].tobytes().decode()
            at = piece.schema.get_field_index(text_col)
            piece = piece.set_column(at, piece.schema.field(at), pa.array(new, texts.type))
            if length_col in piece.schema.names:
                at = piece.schema.get_field_index(length_col)
                sizes = piece.column(at).to_pylist()
                for i in touched:
                    sizes[i] = len(new[i])
                kind = piece.column(at).type
                piece = piece.set_column(at, piece.schema.field(at), pa.array(sizes, kind))
            dropped = np.zeros(piece.num_rows, dtype=bool)
            dropped[[i for i in touched if i in emptied]] = True
            yield piece.filter(pa.array(~dropped))

    return run
