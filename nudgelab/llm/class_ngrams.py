"""Brown class-based bigrams over words.

P(w | v) = P(class(w) | class(v)) * P(w | class(w)). Every word seen at least ``LEAST_COUNT`` times
in the training texts is put into one of ``CLASSES`` classes by exchange: a word moves to the class
that raises the likelihood of the class bigrams most, until a sweep over all words brings no more
rise. Rarer and unseen words belong to classes of word shapes, the end of a text to a class of its
own. Every word's own count enters its emission probability.

Texts are coded once: a block of texts becomes one row with its distinct words and the codes of all
its words. A block's words fall into parts by their 64-bit hash, and one packed row for each block
and part is shuffled: the task of a part counts its words over all blocks, numbers them by falling
frequency and answers every block in the block's own order. Bigram counts of all numbers stay
distributed in chunks. What travels in a turn is one byte for every exchanged word, its class.

Words are told apart by their hash; among V distinct words two share one with probability V^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nudgelab.llm.common import arrow_batches, as_batch, held_out, id_and_text
from nudgelab.llm.words import give_back, mix, pieces, split, vocabulary_hashes
from nudgelab.session import discard, materialize

CLASSES = 48
SHAPES = 32
#: Training words seen so often are exchanged between classes; the rest shows how unseen words behave.
LEAST_COUNT = 5
#: Turns of a sweep, each for the words of one part; a sweep with a turn undone doubles them.
PARTS, MOST_PARTS = 4, 16
#: A sweep that raises the log likelihood by less (natural logarithm a training token) is the last,
#: if it also moved no more than this share of the words.
LEAST_RISE, FEW_MOVED = 1e-3, 0.03
#: Parts of the vocabulary, which are the chunks of the bigram table: 64, and more from 128 blocks.
CHUNKS, CHUNK_BLOCKS = 64, 2
#: Words that a task exchanges at once, at most.
AT_ONCE = 256
BLOCK_BYTES = 8_000_000
#: Counts added to every word of a class, and weight of the class unigrams in the transitions.
ADDED, BACKOFF = 0.5, 5.0

_CODED = "block long, ids array<long>, train array<boolean>, bounds binary, codes binary, words binary"


def _pack(values: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True)
    return np.frombuffer(raw, dtype=kind)


def _words_of(data: bytes) -> pa.Array:
    raw = _unpack(data, np.uint8).tobytes()
    return pa.array(raw.split(b"\n") if raw else [], pa.binary())


def _numbers(values: np.ndarray) -> bytes:
    """Non-negative or small numbers, packed in as few bytes as they need."""
    most = int(max(values.max(), -values.min())) if len(values) else 0
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + _pack(values.astype(kind))


def _unnumbered(data: bytes) -> np.ndarray:
    return _unpack(data[1:], np.dtype(f"i{data[0]}")).astype(np.int64)


def coded_texts(rows: DataFrame) -> DataFrame:
    """One row per block of (doc_id, text, train) rows, written to the shared folder.

    The words of a block are in ascending order of their hash.
    """
    kinds = [("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())),
             ("bounds", pa.binary()), ("codes", pa.binary()), ("words", pa.binary())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, piece in enumerate(pieces(batches, "text", BLOCK_BYTES), first):
            words = split(piece.column("text"))
            if not len(words.codes):
                words.vocabulary = pa.array([], pa.binary())
            order = np.argsort(word_hashes(words.vocabulary), kind="stable")
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            joined = b"\n".join(words.vocabulary.take(pa.array(order)).to_pylist())
            give_back()
            yield as_batch(
                {
                    "block": [number], "ids": [piece.column("doc_id").to_pylist()],
                    "train": [piece.column("train").to_pylist()],
                    "bounds": [_numbers(words.bounds)], "codes": [_numbers(place[words.codes])],
                    "words": [_pack(np.frombuffer(joined, np.uint8))],
                },
                schema,
            )

    return materialize(rows.mapInArrow(run, _CODED))


def word_hashes(words: pa.Array) -> np.ndarray:
    return mix(vocabulary_hashes(words))


def _blocks(batch: pa.RecordBatch):
    """(block, words, codes, bounds, train) of every block of a batch."""
    for i in range(batch.num_rows):
        get = lambda c: batch.column(c)[i].as_py()  # noqa: B023, E731
        yield (get("block"), _words_of(get("words")), _unnumbered(get("codes")),
               _unnumbered(get("bounds")), np.array(get("train"), dtype=bool))


def _trained(bounds: np.ndarray, train: np.ndarray) -> np.ndarray:
    return np.repeat(train, np.diff(bounds))


def shapes(words: pa.Array) -> np.ndarray:
    """The shape class of every word: its length, digits, other scripts and closing sign."""
    if not len(words):
        return np.zeros(0, dtype=np.int64)
    text = words.cast(pa.string(), safe=False) if pa.types.is_binary(words.type) else words
    flag = lambda pattern: pc.match_substring_regex(text, pattern).to_numpy(zero_copy_only=False)
    size = np.minimum(pc.binary_length(words).to_numpy(zero_copy_only=False) - 1, 15) // 4
    return size.astype(np.int64) + 4 * flag("[0-9]") + 8 * flag("[^\\x00-\\x7F]") + 16 * flag("[^a-z0-9\\x80-\\x{10FFFF}]")


def word_counts(coded: DataFrame) -> DataFrame:
    """(word, n) of all training words; the model itself counts by hash."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, codes, bounds, train in _blocks(batch):
                n = np.bincount(codes[_trained(bounds, train)], minlength=len(words))
                kept = words.take(pa.array(np.flatnonzero(n)))
                yield as_batch({"word": kept, "n": n[n > 0]}, schema)

    rows = coded.select("block", "codes", "bounds", "train", "words").mapInArrow(run, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


class Symbols:
    """Numbers: exchanged words, then shapes, then the end of a text.

    A word's number is its rank by falling frequency inside its part, times the number of parts,
    plus the part. Parts differ a little in size, so the last ranks may belong to no word.
    """

    def __init__(self, sizes: np.ndarray):
        self.parts = len(sizes)
        self.words = int(sizes.max(initial=0)) * self.parts
        ranks, parts = np.divmod(np.arange(self.words), self.parts)
        self.frequent = np.flatnonzero(ranks < sizes[parts]) if self.words else np.zeros(0, np.int64)
        self.end = self.words + SHAPES
        self.size = self.end + 1


def part_bounds(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins among ascending hashes; parts are equal ranges of the hash."""
    width = (1 << 64) // parts + 1
    starts = np.array([min(p * width, (1 << 64) - 1) for p in range(parts)], dtype=np.uint64)
    return np.append(np.searchsorted(hashes, starts), len(hashes))


_ASKED = "block long, part int, hashes binary, n binary, shapes binary"
_ANSWERED = "block long, part int, n binary, symbols binary, told binary"


def answered_words(coded: DataFrame, parts: int) -> DataFrame:
    """(block, part, n, symbols): training counts and numbers of a block's words of one part, in
    the block's order; a number below 0 is -1 less the word's shape. Written to the shared folder.

    A row with block -1 tells of the part: hashes, counts and numbers of its exchanged words, and
    the counts of the others by shape. A part holds the words of all blocks in one range of hashes.
    """
    asking = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("hashes", pa.binary()),
                        ("n", pa.binary()), ("shapes", pa.binary())])
    answering = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("n", pa.binary()),
                           ("symbols", pa.binary()), ("told", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, codes, bounds, train in _blocks(batch):
                hashes, kinds = word_hashes(words), shapes(words)
                n = np.bincount(codes[_trained(bounds, train)], minlength=len(words))
                cuts = part_bounds(hashes, parts)
                for p in np.flatnonzero(np.diff(cuts)).tolist():
                    part = slice(cuts[p], cuts[p + 1])
                    yield as_batch(
                        {"block": [block], "part": [p], "hashes": [hashes[part].tobytes()],
                         "n": [_numbers(n[part])], "shapes": [_numbers(kinds[part])]}, asking,
                    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, rows in _by_part(batches):
            blocks = [r["block"] for r in rows]
            given = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
            own = np.concatenate([_unnumbered(r["n"]) for r in rows])
            hashes, at, back = np.unique(np.concatenate(given), return_index=True, return_inverse=True)
            n = np.bincount(back, weights=own, minlength=len(hashes)).astype(np.int64)
            kinds = np.concatenate([_unnumbered(r["shapes"]) for r in rows])[at]
            frequent = np.flatnonzero(n >= LEAST_COUNT)
            frequent = frequent[np.lexsort((hashes[frequent], -n[frequent]))]
            symbols = -1 - kinds
            symbols[frequent] = np.arange(len(frequent)) * parts + p
            rare = (n > 0) & (n < LEAST_COUNT)
            told = [
                hashes[frequent].view(np.int64), n[frequent], symbols[frequent],
                np.bincount(kinds[rare], weights=n[rare], minlength=SHAPES).astype(np.int64),
                np.bincount(kinds[rare], minlength=SHAPES),
            ]
            yield as_batch(
                {"block": [-1], "part": [p], "n": [b""], "symbols": [b""], "told": [_pack(np.concatenate(told))]},
                answering,
            )
            give_back()
            start = 0
            for block, mine in zip(blocks, given, strict=True):
                own_words = back[start : start + len(mine)]
                start += len(mine)
                yield as_batch(
                    {"block": [block], "part": [p], "n": [_numbers(n[own_words])],
                     "symbols": [_numbers(symbols[own_words])], "told": [None]}, answering,
                )

    asked = coded.select("block", "codes", "bounds", "train", "words").mapInArrow(ask, _ASKED)
    dealt = asked.repartition(parts, "part").sortWithinPartitions("part")
    return materialize(dealt.mapInArrow(answer, _ANSWERED))


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """The rows of each part, from batches that are sorted by it."""
    part, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["part"] != part:
                yield part, held
                held = []
            part = row["part"]
            held.append(row)
    if held:
        yield part, held


def _told(data: bytes) -> tuple[np.ndarray, ...]:
    """Hashes, counts and numbers of a part's exchanged words; counts and words of the rare shapes."""
    values = _unpack(data, np.int64)
    words, rare = values[: len(values) - 2 * SHAPES], values[len(values) - 2 * SHAPES :]
    return *words.reshape(3, -1), rare[:SHAPES], rare[SHAPES:]


def numbered_words(answers: DataFrame) -> DataFrame:
    """(hash, n, symbol) of the words to exchange."""
    schema = pa.schema([("hash", pa.int64()), ("n", pa.int64()), ("symbol", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for told in batch.column("told"):
                hashes, n, symbol, _, _ = _told(told.as_py())
                yield as_batch({"hash": hashes, "n": n, "symbol": symbol}, schema)

    return answers.where("block = -1").select("told").mapInArrow(run, "hash long, n long, symbol long")


def part_totals(answers: DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Exchanged words of every part, counts and words of the rare shapes, and all counts.

    One short row for each part comes to the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, told in zip(batch.column("part"), batch.column("told"), strict=True):
                _, n, _, rare, kinds = _told(told.as_py())
                short = np.concatenate([[len(n), n.sum() + rare.sum()], rare, kinds])
                yield pa.RecordBatch.from_pydict({"part": pa.array([part.as_py()], pa.int32()), "sums": [_pack(short)]})

    rows = answers.where("block = -1").select("part", "told").mapInArrow(run, "part int, sums binary").collect()
    table = np.zeros((parts, 2 + 2 * SHAPES), dtype=np.int64)
    for r in rows:
        table[r["part"]] = _unpack(bytes(r["sums"]), np.int64)
    return table[:, 0], table[:, 2 : 2 + SHAPES].sum(axis=0), table[:, 2 + SHAPES :].sum(axis=0), int(table[:, 1].sum())


def linked_blocks(coded: DataFrame, answers: DataFrame, symbols: Symbols) -> DataFrame:
    """The blocks with symbols and training counts in place of words, written to the shared folder."""
    linking = pa.schema([("ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("bounds", pa.binary()),
                         ("codes", pa.binary()), ("own", pa.binary()), ("n", pa.binary())])
    first = symbols.words

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i].as_py()  # noqa: B023, E731
                found = sorted(get("found") or (), key=lambda r: r["part"])
                none = [np.zeros(0, np.int64)]
                own = np.concatenate(none + [_unnumbered(r["symbols"]) for r in found])
                n = np.concatenate(none + [_unnumbered(r["n"]) for r in found])
                own = np.where(own < 0, first - 1 - own, own)
                give_back()
                yield as_batch(
                    {"ids": [get("ids")], "train": [get("train")], "bounds": [get("bounds")],
                     "codes": [get("codes")], "own": [_numbers(own)], "n": [_numbers(n)]}, linking,
                )

    found = answers.where("block >= 0").groupBy("block").agg(
        F.collect_list(F.struct("part", "n", "symbols")).alias("found")
    )
    kinds = "ids array<long>, train array<boolean>, bounds binary, codes binary, own binary, n binary"
    rows = coded.drop("words").join(found, "block", "left").drop("block")
    return materialize(rows.mapInArrow(link, kinds))


def _linked(batch: pa.RecordBatch):
    """(row number, symbols, counts, codes, bounds, train) of every linked block of a batch."""
    for i in range(batch.num_rows):
        get = lambda c: _unnumbered(batch.column(c)[i].as_py())  # noqa: B023, E731
        yield (i, get("own"), get("n"), get("codes"), get("bounds"),
               np.array(batch.column("train")[i].as_py(), dtype=bool))


def chain(symbols: np.ndarray, bounds: np.ndarray, end: int) -> np.ndarray:
    """All texts as one run of symbols, with ``end`` in front of, between and behind them."""
    out = np.full(len(symbols) + len(bounds), end, dtype=np.int64)
    inside = np.ones(len(out), dtype=bool)
    inside[bounds + np.arange(len(bounds))] = False
    out[inside] = symbols
    return out


_SIDES = ("after", "before")
_CHUNK = "chunk int, " + ", ".join(f"{s}_{c} binary" for s in _SIDES for c in ("sizes", "others", "counts"))


def _packed_cells(cells: np.ndarray, counts: np.ndarray, chunk: int, size: int, chunks: int) -> list[bytes]:
    """Ascending cells (own symbol * size + other) of one chunk: cells of each own symbol, their
    other symbols as differences, and their counts."""
    own = np.arange(chunk, size, chunks)
    sizes = np.diff(np.append(np.searchsorted(cells, own * size), len(cells)))
    others = cells - np.repeat(own * size, sizes)
    return [_numbers(sizes), _numbers(np.diff(others, prepend=0)), _numbers(counts)]


def _cells(sizes: bytes, others: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``_packed_cells`` packed, with the other symbols themselves."""
    return _unnumbered(sizes), np.cumsum(_unnumbered(others)), _unnumbered(counts)


def _sides(batch: pa.RecordBatch, row: int, sides: tuple[str, ...] = _SIDES) -> list[tuple]:
    get = lambda c: batch.column(c)[row].as_py()
    return [_cells(*(get(f"{s}_{c}") for c in ("sizes", "others", "counts"))) for s in sides]


def bigram_table(linked: DataFrame, symbols: Symbols, chunks: int = CHUNKS) -> DataFrame:
    """Training bigrams: a row for each chunk with its cells by first and by second symbol.

    A chunk holds every ``chunks``-th symbol. Blocks are counted first, and the counts of a chunk
    are merged as they come.
    """
    size = symbols.size
    parting = pa.schema([("chunk", pa.int32()), ("side", pa.int32()), ("sizes", pa.binary()),
                         ("others", pa.binary()), ("counts", pa.binary())])
    schema = pa.schema([("chunk", pa.int32()), *[(f"{s}_{c}", pa.binary()) for s in _SIDES
                                                 for c in ("sizes", "others", "counts")]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, own_of, _, codes, bounds, train in _linked(batch):
                if not train.any():
                    continue
                kept = _trained(bounds, train)
                ends = np.concatenate([[0], np.cumsum(np.diff(bounds)[train])])
                row = chain(own_of[codes[kept]], ends, symbols.end)
                for side, (own, other) in enumerate(((row[:-1], row[1:]), (row[1:], row[:-1]))):
                    # The chunk in front, so that one sort orders cells by chunk, own and other symbol.
                    number = (own % chunks) * (size // chunks + 1) + own // chunks
                    cells, counts = np.unique(number * size + other, return_counts=True)
                    place, others = np.divmod(cells, size)
                    part, rank = np.divmod(place, size // chunks + 1)
                    cuts = np.searchsorted(part, np.arange(chunks + 1))
                    cells = (rank * chunks + part) * size + others
                    del number, place, rank, others
                    give_back()
                    for c in np.flatnonzero(np.diff(cuts)).tolist():
                        mine = slice(cuts[c], cuts[c + 1])
                        packed = _packed_cells(cells[mine], counts[mine], c, size, chunks)
                        names = ("sizes", "others", "counts")
                        yield as_batch(
                            {"chunk": [c], "side": [side]} | {k: [v] for k, v in zip(names, packed, strict=True)},
                            parting,
                        )

    def add(parts: list) -> tuple[np.ndarray, np.ndarray]:
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cells = np.concatenate([c for c, _ in parts])
        counts = np.concatenate([n for _, n in parts])
        order = np.argsort(cells, kind="stable")
        cells, counts = cells[order], counts[order]
        heads = np.flatnonzero(np.diff(cells, prepend=-1))
        return cells[heads], np.add.reduceat(counts, heads)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: int | None = None
        held: tuple[list, list] = ([], [])

        def whole() -> pa.RecordBatch:
            packed = [x for parts in held for x in _packed_cells(*add(parts), chunk, size, chunks)]
            return as_batch({"chunk": [chunk]} | {f.name: [x] for f, x in zip(list(schema)[1:], packed, strict=True)}, schema)

        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i].as_py()  # noqa: B023, E731
                if chunk is not None and get("chunk") != chunk:
                    yield whole()
                    held = ([], [])
                    give_back()
                chunk = get("chunk")
                sizes, others, counts = _cells(get("sizes"), get("others"), get("counts"))
                parts = held[get("side")]
                parts.append((np.repeat(np.arange(chunk, size, chunks) * size, sizes) + others, counts))
                if len(parts) > 1 and sum(len(x) for x, _ in parts[1:]) > len(parts[0][0]):
                    parts[:] = [add(parts)]
        if chunk is not None:
            yield whole()

    kinds = "chunk int, side int, sizes binary, others binary, counts binary"
    counted = linked.select("own", "n", "codes", "bounds", "train").mapInArrow(count, kinds)
    dealt = counted.repartition(chunks, "chunk").sortWithinPartitions("chunk")
    return materialize(dealt.mapInArrow(merge, _CHUNK))


def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.where(x > 0, x, 1.0))


def class_bigrams(
    table: DataFrame, classes: np.ndarray, size: int, total: int, chunks: int
) -> np.ndarray:
    """How often each class follows each class; one packed row per task comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(total * total)
        for batch in batches:
            for i, chunk in enumerate(batch.column("chunk").to_pylist()):
                [(sizes, others, n)] = _sides(batch, i, _SIDES[:1])
                own = classes[np.arange(chunk, size, chunks)].astype(np.int32) * total
                sums += np.bincount(np.repeat(own, sizes) + classes[others], weights=n, minlength=total * total)
        yield pa.RecordBatch.from_pydict({"sums": [_pack(sums)]})

    columns = [f"{_SIDES[0]}_{c}" for c in ("sizes", "others", "counts")]
    found = table.select("chunk", *columns).mapInArrow(run, "sums binary").collect()
    out = np.zeros(total * total)
    for row in found:
        out += _unpack(bytes(row["sums"]), np.float64)
    return out.reshape(total, total)


def likelihood(pairs: np.ndarray) -> float:
    """The part of the log likelihood that depends on the classes."""
    return float(
        _entropy(pairs).sum() - _entropy(pairs.sum(axis=1)).sum() - _entropy(pairs.sum(axis=0)).sum()
    )


def exchange(
    own: list[int], after: np.ndarray, before: np.ndarray, loops: np.ndarray,
    classes: np.ndarray, pairs: np.ndarray, movable: int,
) -> list[tuple[int, int]]:
    """Move each word to its best class, one after another; returns (symbol, new class).

    ``after[i]`` and ``before[i]`` count word i's neighbours by class, itself left out, and
    ``loops[i]`` counts it next to itself. ``pairs`` is updated along the way.
    """
    moved = []
    index = np.arange(movable)
    for i, symbol in enumerate(own):
        old, r, p, s = int(classes[symbol]), after[i], before[i], loops[i]
        pairs[old] -= r
        pairs[:, old] -= p
        pairs[old, old] -= s
        rows, columns = pairs[:movable], pairs[:, :movable].T
        gain = (_entropy(rows + r) - _entropy(rows)).sum(axis=1)
        gain += (_entropy(columns + p) - _entropy(columns)).sum(axis=1)
        corner, to, at = pairs[index, index], r[:movable], p[:movable]
        gain += _entropy(corner + to + at + s) + _entropy(corner)
        gain -= _entropy(corner + to) + _entropy(corner + at)
        # The sums of the other classes do not depend on where the word goes.
        out, into = pairs.sum(axis=1)[:movable] + at, pairs.sum(axis=0)[:movable] + to
        gain -= _entropy(out + r.sum() + s) - _entropy(out)
        gain -= _entropy(into + p.sum() + s) - _entropy(into)
        new = int(np.argmax(gain))
        if gain[new] <= gain[old] + 1e-9:
            new = old
        pairs[new] += r
        pairs[:, new] += p
        pairs[new, new] += s
        if new != old:
            moved.append((symbol, new))
    return moved


def best_classes(
    rows: tuple, columns: tuple, loops: np.ndarray, old: np.ndarray, pairs: np.ndarray, movable: int
) -> np.ndarray:
    """The best class of each word of a batch, each as ``exchange`` would find it in ``pairs``.

    ``rows`` and ``columns`` are the non-zero neighbour counts (word, class, count) behind and in
    front of the words, themselves left out.
    """
    n, total = len(old), len(pairs)
    dense = []
    for word, other, count in (rows, columns):
        flat = np.bincount(word * total + other, weights=count, minlength=n * total)
        dense.append(flat.reshape(n, total))
    gain = np.zeros((n, movable))
    for (word, other, count), across, table in (
        (rows, dense[1], pairs[:movable].T), (columns, dense[0], pairs[:, :movable])
    ):
        if not len(word):
            continue
        # Entries of one class and count share their row, but for what the word itself adds.
        keys, at_key = np.unique(count.astype(np.int64) * total + other, return_inverse=True)
        lines = table[keys % total]
        change = (_entropy(lines + (keys // total)[:, None]) - _entropy(lines))[at_key]
        own = table[other, old[word]] - count
        change[np.arange(len(word)), old[word]] = _entropy(own + count) - _entropy(own)
        same = np.flatnonzero(other == old[word])
        base = table[other[same]] - across[word[same], :movable]
        base[np.arange(len(same)), old[word[same]]] -= loops[word[same]] + count[same]
        change[same] = _entropy(base + count[same, None]) - _entropy(base)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        gain[word[starts]] += np.add.reduceat(change, starts, axis=0)
    each, s = np.arange(n), loops[:, None]
    to, at = dense[0][:, :movable], dense[1][:, :movable]
    corner = np.tile(np.diagonal(pairs)[:movable], (n, 1))
    corner[each, old] -= to[each, old] + at[each, old] + loops
    gain += _entropy(corner + to + at + s) + _entropy(corner)
    gain -= _entropy(corner + to) + _entropy(corner + at)
    for axis, sums in ((1, dense[0]), (0, dense[1])):
        mass = sums.sum(axis=1) + loops
        side = np.tile(pairs.sum(axis=axis)[:movable], (n, 1))
        side[each, old] -= mass
        gain -= _entropy(side + mass[:, None]) - _entropy(side)
    new = np.argmax(gain, axis=1)
    return np.where(gain[each, new] > gain[each, old] + 1e-9, new, old)


def _moves(
    classes: np.ndarray, pairs: np.ndarray, words: int, total: int, chunks: int
):
    """New classes of the words of each chunk, in the order of their ranks."""

    def contexts(own, sizes, others, counts):
        sizes = sizes[: len(own)]
        row = np.repeat(np.arange(len(own)), sizes)
        others, counts = others[: len(row)], counts[: len(row)]
        loop = others == own[row]
        loops = np.bincount(row[loop], weights=counts[loop], minlength=len(own))
        flat = row[~loop] * total + classes[others[~loop]]
        dense = np.bincount(flat, weights=counts[~loop], minlength=len(own) * total)
        found = np.flatnonzero(dense)
        return found // total, found % total, dense[found], loops

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, chunk in enumerate(batch.column("chunk").to_pylist()):
                own = np.arange(chunk, words, chunks)
                if not len(own):
                    continue
                behind, front = _sides(batch, i)
                *after, loops = contexts(own, *behind)
                *before, _ = contexts(own, *front)
                mine, held, start = classes[own].astype(np.int64), pairs.copy(), 0
                # The frequent words one by one, rarer ones in growing batches.
                while start < len(own):
                    stop = min(len(own), start + 1 + min(start // 8, AT_ONCE - 1))
                    sides = []
                    for word, other, count in (after, before):
                        a, b = np.searchsorted(word, [start, stop])
                        sides.append((word[a:b] - start, other[a:b], count[a:b]))
                    old = mine[start:stop]
                    new = best_classes(*sides, loops[start:stop], old, held, CLASSES)
                    for k, sign in ((old, -1), (new, 1)):
                        (w, j, r), (v, m, p) = sides
                        np.add.at(held, (k[w], j), sign * r)
                        np.add.at(held, (m, k[v]), sign * p)
                        np.add.at(held, (k, k), sign * loops[start:stop])
                    mine[start:stop], start = new, stop
                yield pa.RecordBatch.from_pydict(
                    {"chunk": pa.array([chunk], pa.int32()), "classes": [_pack(mine.astype(np.uint8))]}
                )

    return run


@dataclass
class ClassModel:
    """Classes of the exchanged words and all log10 probabilities but the words' own counts."""

    symbols: Symbols
    coded: DataFrame | None
    """The blocks with their words, if they were kept."""
    numbered: DataFrame
    """(hash, n, symbol) of the exchanged words."""
    linked: DataFrame
    classes: np.ndarray
    moves: np.ndarray
    """log10 P(class | class in front)."""
    emission_base: np.ndarray
    """log10 of the denominator of P(word | class)."""
    train_tokens: int
    train_words: int
    train_texts: int
    history: list[float]
    sweeps: int

    @property
    def frequent_n(self) -> np.ndarray:
        """Training counts by symbol, 0 for numbers without a word; all come to the driver."""
        out = np.zeros(self.symbols.words, dtype=np.int64)
        for r in self.numbered.select("symbol", "n").collect():
            out[r["symbol"]] = r["n"]
        return out


def fit(coded: DataFrame, keep: bool = True) -> ClassModel:
    """Cluster the words and estimate the model from the training rows of ``coded``.

    Turns go round the quarters of the parts of the vocabulary; a task exchanges the words of one
    part against its own copy of the counts. A turn that does not raise the likelihood is taken
    back, and the next sweep has more turns; from ``MOST_PARTS`` on its moves are tried in halves. The last sweep is the first that raises the likelihood
    by less than ``LEAST_RISE`` and moves few words. Without ``keep`` the coded blocks are removed once they are linked.
    """
    row = coded.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.expr("size(filter(train, x -> x))")), F.lit(0))
    ).first()
    texts, chunks = row[1], max(CHUNKS, row[0] // CHUNK_BLOCKS)
    answers = answered_words(coded, chunks)
    sizes, rare_n, rare_words, counted = part_totals(answers, chunks)
    tokens, distinct = counted + texts, int(sizes.sum() + rare_words.sum()) + (1 if texts else 0)
    symbols, total = Symbols(sizes), CLASSES + SHAPES + 1
    words = symbols.words
    linked = linked_blocks(coded, answers, symbols)
    if not keep:
        discard(coded)
    numbered = materialize(numbered_words(answers))
    discard(answers)
    classes = np.concatenate(
        [np.arange(words) % CLASSES, CLASSES + np.arange(SHAPES + 1)]
    ).astype(np.uint8)
    table = bigram_table(linked, symbols, chunks)
    pairs = class_bigrams(table, classes, symbols.size, total, chunks)
    history, parts, sweeps = [likelihood(pairs)], PARTS, 0
    while words:
        began, undone, sweeps, earlier = history[-1], False, sweeps + 1, classes
        for part in range(parts):
            moved = table.where(F.col("chunk") % parts == part).mapInArrow(
                _moves(classes, pairs, words, total, chunks), "chunk int, classes binary"
            ).collect()
            waiting = [moved]
            while waiting:
                tried = waiting.pop(0)
                following = classes.copy()
                for r in tried:
                    following[r["chunk"] : words : chunks] = _unpack(bytes(r["classes"]), np.uint8)
                if np.array_equal(following, classes):
                    continue
                after = class_bigrams(table, following, symbols.size, total, chunks)
                if likelihood(after) > history[-1]:
                    classes, pairs = following, after
                    history.append(likelihood(pairs))
                    continue
                undone = True
                # With turns as small as they get, the moves are tried in halves.
                if parts >= MOST_PARTS and len(tried) > 1:
                    waiting += [tried[::2], tried[1::2]]
        changed = np.count_nonzero(classes != earlier)
        small = history[-1] - began < LEAST_RISE * tokens and changed <= FEW_MOVED * sizes.sum()
        if small and (not undone or parts >= MOST_PARTS):
            break
        parts = min(2 * parts, MOST_PARTS) if undone else parts
    discard(table)
    mass, kinds = np.zeros(total), np.zeros(total)
    mass[:CLASSES] = pairs.sum(axis=0)[:CLASSES]
    kinds[:CLASSES] = np.bincount(classes[symbols.frequent], minlength=CLASSES)
    mass[CLASSES : CLASSES + SHAPES] = rare_n
    kinds[CLASSES : CLASSES + SHAPES] = rare_words + 1  # the unseen words of a shape
    unigrams = (pairs.sum(axis=0) + 1) / (pairs.sum() + total)
    moves = (pairs + BACKOFF * unigrams) / (pairs.sum(axis=1, keepdims=True) + BACKOFF)
    base = np.log10(np.maximum(mass + ADDED * kinds, ADDED))
    return ClassModel(symbols, coded if keep else None, numbered, linked, classes, np.log10(moves), base,
                      int(tokens), int(distinct), int(texts), history, sweeps)


def class_table(model: ClassModel) -> DataFrame:
    """(word, class, n) of the exchanged words of a model that kept its coded blocks."""
    classes = model.classes
    spelling = pa.schema([("hash", pa.int64()), ("word", pa.binary())])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("words"):
                words = _words_of(packed.as_py())
                yield as_batch({"hash": word_hashes(words).view(np.int64), "word": words}, spelling)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = classes[batch.column("symbol").to_numpy()].astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {"word": batch.column("word"), "class": pa.array(found), "n": batch.column("n")}
            )

    spelled = model.coded.select("words").mapInArrow(spell, "hash long, word binary").distinct()
    return (
        spelled.join(model.numbered, "hash")
        .select(F.col("word").cast("string").alias("word"), "symbol", "n")
        .mapInArrow(run, "word string, class int, n long")
    )


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, bounds[:-1][full])
    return out


def _score_blocks(model: ClassModel):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base_score", pa.float64()), ("score", pa.float64()),
    ])
    end, classes, moves, base = model.symbols.end, model.classes, model.moves, model.emission_base
    train_texts, spread = model.train_texts, np.log10(model.train_tokens + model.train_words + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, own, n, codes, bounds, _ in _linked(batch):
                kind = classes[own].astype(np.int64)
                emission = np.log10(n + ADDED) - base[kind]
                # The classes of a text, from the end in front of it to the end behind it.
                row = chain(kind[codes], bounds, int(classes[end]))
                steps = moves[row[:-1], row[1:]]
                upto = bounds + np.arange(len(bounds))
                yield as_batch(
                    {
                        "doc_id": batch.column("ids")[i].as_py(),
                        "n_tokens": np.diff(bounds) + 1,
                        "n_known": _sums((n > 0)[codes].astype(np.float64), bounds).astype(np.int64)
                        + (train_texts > 0),
                        "base_score": _sums(np.log10(n + 1.0)[codes], bounds)
                        + np.log10(train_texts + 1.0) - spread * (np.diff(bounds) + 1),
                        "score": _sums(emission[codes], bounds) + _sums(steps, upto),
                    },
                    schema,
                )

    return run


def scored(
    docs: DataFrame, parts: int = 7, part: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fit on the rows whose crc32 of the id is not ``part`` modulo ``parts``; score all rows.

    Returns (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity,
    held_out_perplexity): the perplexity of the text, and that of all held-out rows together (null
    without such rows). Words are lower-cased (A-Z) and end at white space; every text has one end
    token more. ``base_score`` is the add-one unigram score, ``score`` the class model's log10
    probability of the text. Null texts are empty; rows without an id are held out; repeated rows
    count each and are answered alike. Without training rows every word is unseen. Other columns
    are not read; an empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn(
        "train", ~held_out(F.col("doc_id"), parts, part)
    )
    kinds = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    with arrow_batches(docs.sparkSession, f"{BLOCK_BYTES}b"):
        model = fit(coded_texts(rows), keep=False)
        blocks = model.linked.select("ids", "own", "n", "codes", "bounds", "train")
        made = materialize(blocks.mapInArrow(_score_blocks(model), kinds))
        discard(model.linked)
    held = held_out(F.col("doc_id"), parts, part)
    over = made.where(held).agg(F.sum("score").alias("s"), F.sum("n_tokens").alias("n")).first()
    whole = 10.0 ** (-over["s"] / over["n"]) if over["n"] else None
    return made.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
        F.lit(whole).cast("double").alias("held_out_perplexity"),
    )
