"""SimHash groups: fingerprints of word shingles, linked through covering anchors.

1. One pass makes a 64-bit fingerprint of every text. Equal fingerprints fall together at once,
   whatever their number; only distinct fingerprints go on.
2. Each goes to all of its anchors (:mod:`nudgelab.llm.covering`, some ninety codewords of a
   product code), so that any two within the threshold meet at one of them.
3. Fingerprints are compared per anchor. Anchors that a hash sample shows to be crowded are cut
   into chunks of about ``block`` members: each chunk is compared with itself and with the first
   chunk. The sample decides the cut, never the result.
4. The links give components. A crowded anchor that still holds several is compared again in
   blocks: all members outside its largest component against all members.

A comparison hands on only links between fingerprints that it has not connected yet, so a crowded
anchor gives fewer links than members. No pair is left out, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nudgelab.llm.common import as_batch, id_and_text
from nudgelab.llm.components import components
from nudgelab.llm.covering import Anchors
from nudgelab.llm.words import _LOWER, _SPACE, edges, pieces, text_bytes
from nudgelab.session import materialize

WIDTH = 3
THRESHOLD = 3
SEED = 42
#: Members of an anchor that one comparison holds on either side.
BLOCK = 4096
#: One fingerprint in so many is counted to find crowded anchors.
SAMPLE = 64

_MARKS = "doc_id long, fingerprint long"
_LINKS = "u long, v long"
_LINK_SCHEMA = pa.schema([("u", pa.int64()), ("v", pa.int64())])
#: Shingles whose bits are counted together; a counter lane of 16 bits holds as many.
_LANE = 65_535
#: Anchors with up to so many members are compared by shifting whole batches.
_FEW = 8


def simhash_groups(
    docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD, id_col: str = "doc_id",
    text_col: str = "text", block: int = BLOCK, sample: int = SAMPLE,
) -> DataFrame:
    """Return (doc_id, fingerprint, component_id), one row for each input row.

    Texts are lower-cased (A-Z) and cut at white space. A fingerprint bit is 1 if it is set in more
    than half of the XXH64 values (seed 42) of the text's runs of ``width`` words, repeats included;
    a shorter text is one run, and a text without words (null, empty, blank) has fingerprint zero,
    which links like any other. Fingerprints link at ``threshold`` or fewer differing bits;
    ``component_id`` is the smallest id reachable. Rows that repeat an id are one document with
    several texts. Rows without an id link to nothing: component_id is null. The fingerprint is
    16 lowercase hex digits. Other columns are not read. An empty table gives no rows.
    """
    marked = materialize(
        id_and_text(docs, id_col, text_col).mapInArrow(_fingerprint_batches(width), _MARKS)
    )
    known = marked.where("doc_id is not null")
    classes = materialize(known.groupBy("fingerprint").agg(F.min("doc_id").alias("node")))
    several = (
        known.groupBy("doc_id")
        .agg(F.min("fingerprint").alias("least"), F.max("fingerprint").alias("most"))
        .where("least <> most")
        .select("doc_id")
    )
    given = known.join(several, "doc_id", "left_semi").join(classes, "fingerprint")
    given = given.select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    found = _links(classes, given, threshold, block, sample)
    labels = components(found.unionByName(given))
    tops = classes.join(labels, "node", "left").select(
        "fingerprint", F.coalesce("component", "node").alias("top")
    )
    return marked.join(tops, "fingerprint", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("top")).alias("component_id"),
    )


# -- fingerprints


def shingle_bytes(texts: pa.Array, width: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All shingles of all texts: a buffer, where each begins and ends in it, and its text."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    mask = _SPACE[data]
    starts, ends = edges(mask, offsets)
    bounds = np.searchsorted(starts, offsets)
    lengths = ends - starts
    at = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(lengths + 1, out=at[1:])
    joined = np.full(int(at[-1]), 0x20, dtype=np.uint8)
    joined[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(starts)), lengths)] = data[mask]
    counts = np.diff(bounds)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), runs)
    first = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
    first += bounds[:-1][owner]
    last = np.minimum(first + width, bounds[1:][owner]) - 1
    return joined.tobytes(), at[first], at[last + 1] - 1, owner


def fingerprints(texts: pa.Array, width: int) -> np.ndarray:
    """One fingerprint for each text."""
    buffer, starts, ends, owner = shingle_bytes(texts, width)
    counts = np.zeros((len(texts), 64), dtype=np.int64)
    lanes = np.uint64(0x0001_0001_0001_0001)
    digest = xxhash.xxh64_intdigest
    for low in range(0, len(owner), _LANE):
        part = slice(low, low + _LANE)
        hashes = np.fromiter(
            (digest(buffer[a:b], SEED) for a, b in zip(starts[part].tolist(), ends[part].tolist())),
            dtype=np.uint64,
        )
        own = owner[part]
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        for bit in range(16):
            sums = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, heads)
            for lane in range(4):
                ones = (sums >> np.uint64(16 * lane)) & np.uint64(0xFFFF)
                counts[own[heads], 16 * lane + bit] += ones.astype(np.int64)
    total = np.bincount(owner, minlength=len(texts))
    bits = (2 * counts > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def _fingerprint_batches(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            marks = fingerprints(piece.column("text"), width)
            yield as_batch(
                {"doc_id": piece.column("doc_id"), "fingerprint": marks.view(np.int64)}, schema
            )

    return run


# -- links


def _links(classes: DataFrame, given: DataFrame, threshold: int, block: int, sample: int) -> DataFrame:
    """Links (u, v) between class nodes that connect what lies within the threshold."""
    anchors = Anchors(threshold)
    marks = classes.select("fingerprint")
    placed = marks.mapInArrow(_anchor_batches(anchors), "anchor long, fingerprint long")
    drawn = marks.where(F.pmod(F.xxhash64("fingerprint"), F.lit(sample)) == 0)
    crowded = materialize(
        drawn.mapInArrow(_anchor_batches(anchors), "anchor long, fingerprint long")
        .groupBy("anchor")
        .agg(F.ceil(F.count(F.lit(1)) * sample / block).cast("int").alias("cut"))
        .where("cut > 1")
    )
    chunk = F.pmod(F.xxhash64("fingerprint"), F.col("cut")).cast("int")
    first = (
        F.when(F.col("cut").isNull(), F.array(F.lit(0)))
        .when(chunk == 0, F.sequence(F.lit(0), F.col("cut") - 1))
        .otherwise(F.array(chunk))
    )
    # The anchor, the chunk and a mark for members of the first chunk share one sort key.
    guest = F.when(F.col("cut").isNull() | (chunk != 0) | (F.col("j") == 0), 0).otherwise(1)
    key = F.shiftleft("anchor", 32) + F.col("j").cast("long") * 2 + guest
    dealt = (
        placed.join(crowded, "anchor", "left")
        .withColumn("j", F.explode(first))
        .select(key.alias("key"), "fingerprint")
    )
    links = _named(_compared(dealt, threshold).distinct(), classes)
    links = materialize(links)
    if crowded.isEmpty():
        return links
    rest = _second_round(placed.join(crowded, "anchor"), links.unionByName(given), classes, threshold, block)
    return links.unionByName(_named(rest.distinct(), classes))


def _named(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between fingerprints as links between the nodes of their classes."""
    for side in ("u", "v"):
        nodes = classes.select(F.col("fingerprint").alias(side), "node")
        pairs = pairs.join(nodes, side).drop(side).withColumnRenamed("node", side)
    return pairs.select("u", "v")


def _anchor_batches(anchors: Anchors):
    schema = pa.schema([("anchor", pa.int64()), ("fingerprint", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                marks = batch.column("fingerprint").slice(low, 2048).to_numpy()
                places, numbers = anchors.of(marks.view(np.uint64))
                yield as_batch({"anchor": numbers, "fingerprint": marks[places]}, schema)

    return run


def _compared(dealt: DataFrame, threshold: int) -> DataFrame:
    """Links among the members of each block; ``key`` is twice the block plus 1 for guests.

    Guests are not compared with each other, since another block does that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, marks in _whole_groups(batches):
            links = _group_links(keys >> 1, marks, (keys & 1).astype(bool), threshold)
            if len(links):
                pairs = marks[links].view(np.int64)
                yield as_batch({"u": pairs[:, 0], "v": pairs[:, 1]}, _LINK_SCHEMA)

    spread = F.shiftright("key", 1)
    return dealt.repartition(spread).sortWithinPartitions("key").mapInArrow(run, _LINKS)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted (key, fingerprint) rows in runs that end where a group ends."""
    keys, marks = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        marks = np.concatenate([marks, batch.column("fingerprint").to_numpy().view(np.uint64)])
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys >> 1, keys[-1] >> 1))
        if cut:
            yield keys[:cut], marks[:cut]
            keys, marks = keys[cut:], marks[cut:]
    if len(keys):
        yield keys, marks


def _group_links(
    groups: np.ndarray, marks: np.ndarray, guests: np.ndarray, threshold: int
) -> np.ndarray:
    """Pairs of row numbers that connect all rows of one group within the threshold."""
    heads = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[heads, len(groups)])
    few = np.repeat(sizes <= _FEW, sizes)
    found, top = [], {}

    def root(i: int) -> int:
        while top.get(i, i) != i:
            i = top[i]
        return i

    for shift in range(1, _FEW):
        same = (groups[shift:] == groups[:-shift]) & few[shift:]
        at = np.flatnonzero(same)
        if not len(at):
            break
        near = np.bitwise_count(marks[at] ^ marks[at + shift]) <= threshold
        near &= ~(guests[at] & guests[at + shift])
        for i in at[near].tolist():
            a, b = root(i), root(i + shift)
            if a != b:
                top[a] = b
                found.append((i, i + shift))
    pairs = [np.array(found, dtype=np.int64).reshape(-1, 2)]
    for head, size in zip(heads[sizes > _FEW], sizes[sizes > _FEW], strict=True):
        part = slice(head, head + size)
        rows = np.flatnonzero(~guests[part])
        links = spanning_links(marks[part], rows, np.arange(size), threshold)
        pairs.append(links + head)
    return np.concatenate(pairs)


def spanning_links(
    marks: np.ndarray, rows: np.ndarray, labels: np.ndarray, threshold: int
) -> np.ndarray:
    """Pairs (row, other) within the threshold that join different labels until none is left.

    Every one of ``rows`` is compared with all marks.
    """
    labels, found = labels.copy(), []
    step = max(1, (1 << 21) // max(1, len(marks)))
    for low in range(0, len(rows), step):
        part = rows[low : low + step]
        near = np.bitwise_count(marks[part][:, None] ^ marks[None, :]) <= threshold
        for k in np.flatnonzero((near & (labels[None, :] != labels[part][:, None])).any(axis=1)):
            row = part[k]
            others = np.flatnonzero(near[k] & (labels != labels[row]))
            met, first = np.unique(labels[others], return_index=True)
            found += [(row, j) for j in others[first].tolist()]
            labels[np.isin(labels, met)] = labels[row]
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def _second_round(
    placed: DataFrame, links: DataFrame, classes: DataFrame, threshold: int, block: int
) -> DataFrame:
    """Links at crowded anchors between members outside the largest component and all others."""
    first = components(links)
    label = classes.join(first, "node", "left").select(
        "fingerprint", F.coalesce("component", "node").alias("component")
    )
    members = materialize(placed.join(label, "fingerprint").select("anchor", "fingerprint", "component"))
    shares = members.groupBy("anchor", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = (
        shares.groupBy("anchor")
        .agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"),
             F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("anchor", F.col("top.component").alias("main"),
                F.ceil(F.col("all") / block).cast("int").alias("columns"),
                F.ceil((F.col("all") - F.col("top.n")) / block).cast("int").alias("rows"))
    )
    found = members.join(mixed, "anchor")
    spread = lambda count: F.pmod(F.xxhash64("fingerprint"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    kept = ["anchor", "i", "j", "guest", "fingerprint", "component"]
    columns = found.withColumn("j", spread("columns")).withColumn("i", every("rows"))
    rows = (
        found.where("component <> main")
        .withColumn("i", spread("rows"))
        .withColumn("j", every("columns"))
    )
    dealt = columns.withColumn("guest", F.lit(True)).select(*kept).unionByName(
        rows.withColumn("guest", F.lit(False)).select(*kept)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def links_of(table: pa.Table) -> pa.RecordBatch:
            marks = table.column("fingerprint").to_numpy().view(np.uint64)
            own = np.flatnonzero(~table.column("guest").to_numpy())
            pairs = marks[spanning_links(marks, own, table.column("component").to_numpy(), threshold)]
            pairs = pairs.view(np.int64)
            return as_batch({"u": pairs[:, 0], "v": pairs[:, 1]}, _LINK_SCHEMA)

        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in ("anchor", "i", "j")])
            cuts = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if start == stop:
                    continue
                if held and any(
                    held[-1].column(c)[0] != batch.column(c)[int(start)] for c in ("anchor", "i", "j")
                ):
                    yield links_of(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(start, stop - start))
        if held:
            yield links_of(pa.Table.from_batches(held))

    place = ["anchor", "i", "j"]
    return dealt.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, _LINKS)
