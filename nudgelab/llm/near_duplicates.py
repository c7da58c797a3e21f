"""Near-duplicate documents: fast similarity sketching, banding, exact verification.

1. One pass makes each text's set of word shingles, a 128-bit digest of it and its sketch
   (:mod:`nudgelab.llm.sketches`). Equal sets fall together by digest at once, whatever their
   number; only one document of each goes on.
2. Band keys put sketches into buckets. Each member of a bucket is checked against the bucket's
   smallest id on full sets; the links found give first components.
3. A bucket that still holds several components is compared in blocks: all of its members
   against those outside its largest component, each pair in the first bucket it shares.
   Sketches rule out a pair whose agreement is ``SIGMAS`` standard deviations below the
   threshold; the others are checked on full sets, which travel once per block and document.
   A pair inside one component cannot change the result and is not looked at.

At no point do all pairs of a group become rows, and nothing is capped: blocks only cut the work.
A link of similarity exactly 0.8 shares no band with probability (1 - 0.8^ROWS)^BANDS = 2e-6, and
more similar pairs with less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nudgelab.llm.common import as_batch, id_and_text, quoted
from nudgelab.llm.components import components
from nudgelab.llm.sketches import band_keys, digests, shingle_sets, sketch
from nudgelab.llm.words import pieces, split
from nudgelab.session import materialize

WIDTH = 5
PERCENT = 80
BANDS, ROWS = 56, 7
SIGMAS = 4.5
#: Members of a bucket that one block comparison holds on either side.
BLOCK = 1024

_SKETCHED = "doc_id long, n_shingles long, high long, low long, bands array<long>, signature binary"
_SETS = "doc_id long, shingles binary"
_PAIRS = "u long, v long"
_LIKELY = "block long, us array<long>, vs array<long>, of_us array<long>, of_vs array<long>"


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Return (doc_id, n_shingles, component_id, kept), one row per input row.

    Texts are lower-cased (A-Z); words end at white space; a set holds the distinct shingles of
    ``width`` words, or the whole sequence of a shorter text. Two documents are linked if
    ``100 * |A & B| >= percent * |A | B|``; ``component_id`` is the smallest id reachable and
    ``kept`` marks it. Null, empty and wordless texts have an empty set and no links. Rows that
    repeat an id are one document with several texts: they share a component, and the same text
    twice changes nothing. Rows without an id link to nothing: component_id is null, kept true.
    Other columns are not read. An empty table gives no rows.
    """
    sketched = materialize(
        id_and_text(docs, id_col, text_col).mapInArrow(_sketch_batches(width), _SKETCHED)
    )
    rows = sketched.select("doc_id", "n_shingles", "high", "low")
    filled = rows.where("doc_id is not null and n_shingles > 0")
    classes = materialize(filled.groupBy("high", "low").agg(F.min("doc_id").alias("first_id")))
    heads = sketched.where("doc_id is not null and n_shingles > 0").join(
        classes.withColumnRenamed("first_id", "doc_id"), ["high", "low", "doc_id"], "left_semi"
    )
    one = F.struct("high", "low")
    repeated = (
        filled.groupBy("doc_id")
        .agg(F.min(one).alias("least"), F.max(one).alias("most"))
        .where("least <> most")
        .select("doc_id")
    )
    given = (
        filled.join(repeated, "doc_id", "left_semi")
        .join(classes, ["high", "low"])
        .select(F.col("doc_id").alias("u"), F.col("first_id").alias("v"))
    )
    labels = _link_heads(docs, heads, given, width, percent, id_col, text_col)
    out = (
        rows.join(classes, ["high", "low"], "left")
        .withColumn("node", F.when(F.col("n_shingles") > 0, F.col("first_id")))
        .join(labels, "node", "left")
    )
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")
    )
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, all its columns.

    Rows with a null id stay. Of rows that repeat an id one stays, the first by a hash of its text.
    Other columns may have any names.
    """
    id_col, text_col = settings.pop("id_col", "doc_id"), settings.pop("text_col", "text")
    # Columns under names of their own, so that none of the input's can clash.
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    its_id, its_text = (names[_place(docs, c)] for c in (id_col, text_col))
    fates = (
        near_duplicates(plain, id_col=its_id, text_col=its_text, **settings)
        .where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("kept").alias("stays"), F.count(F.lit(1)).alias("rows"))
        .where("not stays or rows > 1")
    )
    fates = materialize(fates)
    key = F.col(its_id).cast("long") == F.col("doc_id")
    single = plain.join(fates, key, "left_anti")
    order = Window.partitionBy(its_id).orderBy(F.xxhash64(its_text))
    several = (
        plain.join(fates.where("stays"), key, "left_semi")
        .withColumn("row", F.row_number().over(order))
        .where("row = 1")
        .drop("row")
    )
    return single.unionByName(several).toDF(*docs.columns)


def _place(docs: DataFrame, name: str) -> int:
    """Where a column stands, whatever the case of its name."""
    return [c.lower() for c in docs.columns].index(name.lower())


def _sketch_batches(width: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("high", pa.int64()),
        ("low", pa.int64()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            sets = shingle_sets(split(piece.column("text")), width)
            high, low = digests(sets)
            sketches = sketch(sets, BANDS * ROWS)
            keys = band_keys(sketches, BANDS, ROWS).reshape(-1)
            ends = np.arange(0, len(keys) + 1, BANDS, dtype=np.int32)
            marks = np.ascontiguousarray(sketches & np.uint64(0xFF)).astype(np.uint8)
            marks_at = np.arange(0, marks.size + 1, BANDS * ROWS, dtype=np.int32)
            yield as_batch(
                {
                    "doc_id": piece.column("doc_id"), "n_shingles": sets.sizes,
                    "high": high, "low": low,
                    "bands": pa.ListArray.from_arrays(pa.array(ends), pa.array(keys)),
                    "signature": pa.Array.from_buffers(
                        pa.binary(), len(marks), [None, pa.py_buffer(marks_at), pa.py_buffer(marks)]
                    ),
                },
                schema,
            )

    return run


def _set_batches(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            sets = shingle_sets(split(piece.column("text")), width)
            ends = (sets.bounds * 8).astype(np.int32)
            packed = pa.Array.from_buffers(
                pa.binary(), piece.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(sets.values)]
            )
            yield as_batch({"doc_id": piece.column("doc_id"), "shingles": packed}, schema)

    return run


def _link_heads(docs, heads, given, width, percent, id_col, text_col) -> DataFrame:
    """Components (node, component) of the first documents of all set classes."""
    bands = heads.select("doc_id", "high", "low", "n_shingles", F.explode("bands").alias("band"))
    hubs = (
        bands.groupBy("band")
        .agg(F.min(F.struct("doc_id", "n_shingles")).alias("hub"), F.max("doc_id").alias("last"))
        .where("hub.doc_id <> last")
        .select("band", "hub")
    )
    members = materialize(bands.join(hubs, "band"))
    near = _sizes_allow(F.col("n_shingles"), F.col("hub.n_shingles"), percent)
    stars = (
        members.where(near & (F.col("doc_id") != F.col("hub.doc_id")))
        .select(F.col("doc_id").alias("u"), F.col("hub.doc_id").alias("v"))
        .distinct()
    )
    ids = members.select("doc_id").distinct()
    texts = id_and_text(docs, id_col, text_col).join(ids, "doc_id", "left_semi")
    # A repeated id has several sets; all of them are tried.
    sets = materialize(texts.mapInArrow(_set_batches(width), _SETS))
    first = materialize(components(verified(stars, sets, percent).unionByName(given)))

    placed = (
        members.select("band", "doc_id", "high", "low", "n_shingles")
        .join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
    )
    likely = materialize(_likely_pairs(placed, heads, percent))
    # The second round links components of the first.
    rest = _block_links(likely, sets, percent).distinct()
    merged = components(rest).select(F.col("node").alias("root"), F.col("component").alias("top"))
    merged = materialize(merged)
    known = first.select("node", F.col("component").alias("root")).unionByName(
        merged.join(first, merged["root"] == first["node"], "left_anti").select(
            F.col("root").alias("node"), "root"
        )
    )
    return known.join(merged, "root", "left").select(
        "node", F.coalesce("top", "root").alias("component")
    )


def _sizes_allow(a, b, percent: int):
    """The smaller set can only reach the threshold if it is large enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _likely_pairs(placed: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """(block, us, vs, of_us, of_vs): likely pairs of one bucket and two components, and those
    components; see the module's step 3."""
    shares = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = (
        shares.groupBy("band")
        .agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"),
             F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("band", F.col("top.component").alias("main"),
                F.ceil(F.col("all") / BLOCK).cast("int").alias("columns"),
                F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("rows"))
    )
    found = materialize(
        placed.join(mixed, "band").withColumn("minor", F.col("component") != F.col("main"))
    )
    spread = lambda count: F.pmod(F.xxhash64("doc_id"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    kept = ["band", "doc_id", "high", "low", "n_shingles", "component", "minor"]
    column = found.withColumn("j", spread("columns")).withColumn("i", every("rows"))
    row = (
        found.where("minor").withColumn("i", spread("rows")).withColumn("j", every("columns"))
    )
    blocks = column.select(*kept, "i", "j", F.lit(False).alias("is_row")).unionByName(
        row.select(*kept, "i", "j", F.lit(True).alias("is_row"))
    )
    return (
        blocks.join(heads.select("doc_id", "high", "low", "bands", "signature"), ["doc_id", "high", "low"])
        .select(F.xxhash64("band", "i", "j").alias("block"), "is_row", *kept, "bands", "signature")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_compare_blocks(percent), _LIKELY)
    )


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block, from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        if held and held[-1].column("block")[0].as_py() != block[0]:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            held.append(batch.slice(start, stop - start))
            if stop < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _compare_blocks(percent: int):
    listed = pa.list_(pa.int64())
    names = ("us", "vs", "of_us", "of_vs")
    schema = pa.schema([("block", pa.int64()), *[(c, listed) for c in names]])
    size, share = BANDS * ROWS, percent / 100
    least = int(size * (share - SIGMAS * (share * (1 - share) / size) ** 0.5))

    def compare(table: pa.Table) -> list[np.ndarray]:
        get = {c: table.column(c).to_numpy() for c in
               ("is_row", "minor", "band", "doc_id", "n_shingles", "component")}
        ids, sizes, part = get["doc_id"], get["n_shingles"], get["component"]
        marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint8)
        marks = marks.reshape(len(ids), size)
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        here = int(np.flatnonzero(bands[0] == get["band"][0])[0])
        rows, columns = np.flatnonzero(get["is_row"]), np.flatnonzero(~get["is_row"])
        us, vs, agreed = [], [], []
        for k in rows:
            near = columns[
                (part[columns] != part[k])
                & (np.minimum(sizes[columns], sizes[k]) * 100
                   >= np.maximum(sizes[columns], sizes[k]) * percent)
                & (~get["minor"][columns] | (ids[columns] > ids[k]))
            ]
            near = near[~(bands[near, :here] == bands[k, :here]).any(axis=1)]
            agree = (marks[near] == marks[k]).sum(axis=1)
            near, agree = near[agree >= least], agree[agree >= least]
            us.append(np.full(len(near), k))
            vs.append(near)
            agreed.append(agree)
        if not us:
            return [np.zeros(0, np.int64)] * 4
        order = np.argsort(-np.concatenate(agreed), kind="stable")
        u, v = np.concatenate(us)[order], np.concatenate(vs)[order]
        return [ids[u], ids[v], part[u], part[v]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_block(batches):
            pairs = compare(table)
            if len(pairs[0]):
                block = table.column("block")[0].as_py()
                yield as_batch({"block": [block]} | {c: [x] for c, x in zip(names, pairs, strict=True)}, schema)

    return run


def _block_links(likely: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components (u, v) whose likely pairs hold a link, as far as their block has not joined them."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_block(batches):
            own: dict[int, list[np.ndarray]] = {}
            for i, x in zip(table.column("doc_id"), table.column("shingles"), strict=True):
                if x.is_valid:
                    own.setdefault(i.as_py(), []).append(np.frombuffer(x.as_py(), np.uint64))
            top: dict[int, int] = {}
            found = []
            for row in table.select(["us", "vs", "of_us", "of_vs"]).to_pylist():
                for u, v, of_u, of_v in zip(*(x or () for x in row.values()), strict=True):
                    a, b = _root(top, of_u), _root(top, of_v)
                    if a != b and any(_similar(x, y, percent) for x in own[u] for y in own[v]):
                        top[a] = b
                        found.append((of_u, of_v))
            if found:
                yield as_batch({"u": [x for x, _ in found], "v": [x for _, x in found]}, schema)

    ids = F.explode(F.array_distinct(F.concat("us", "vs")))
    members = likely.select("block", ids.alias("doc_id")).join(sets, "doc_id")
    none = F.lit(None)
    rows = likely.select(
        "block", "us", "vs", "of_us", "of_vs", none.cast("long").alias("doc_id"), none.cast("binary").alias("shingles")
    ).unionByName(members.select("block", "doc_id", "shingles"), allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(check, _PAIRS)


def _root(top: dict[int, int], node: int) -> int:
    while top.setdefault(node, node) != node:
        top[node] = node = top[top[node]]
    return node


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two ascending, non-empty sets reach the threshold."""
    if not len(x) or not len(y):
        return False
    merged = np.concatenate([x, y])
    merged.sort(kind="stable")
    both = int(np.count_nonzero(merged[1:] == merged[:-1]))
    return both * 100 >= percent * (len(merged) - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the threshold."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = lambda x: np.frombuffer(x.as_buffer(), dtype=np.uint64)
            good = [
                _similar(read(a), read(b), percent)
                for a, b in zip(batch.column("a"), batch.column("b"), strict=True)
            ]
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield as_batch({"u": kept.column("u"), "v": kept.column("v")}, schema)

    with_b = pairs.join(
        sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b")), "v"
    )
    with_a = with_b.join(
        sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a")), "u"
    )
    return with_a.select("u", "v", "a", "b").mapInArrow(check, _PAIRS).distinct()

