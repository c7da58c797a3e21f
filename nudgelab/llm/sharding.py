"""Consistent-hash shards with bounded loads.

The ring of 64-bit hash points is cut into ``2^SLICE_BITS`` slices. Every shard stands on it with
``VIRTUAL`` virtual nodes, each at a hashed slice. A document belongs to the first virtual node
clockwise of its point. A shard takes no more than its capacity: rows that find it full continue
clockwise to the next shard with room. Which rows those are follows from the ring alone: shards
fill in rounds (first their own slices, then the overflow that arrives), slice by slice clockwise,
and inside a slice by the order of points.

Only the slices' sizes (at most 65,536 numbers, whatever the input) come to the driver.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nudgelab.llm.common import quoted
from nudgelab.llm.positions import slice_of, spread_point
from nudgelab.session import materialize

SLICE_BITS = 16
VIRTUAL = 128
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def ring(shards: int, virtual: int = VIRTUAL, bits: int = SLICE_BITS) -> list[int]:
    """The shard at each slice's first virtual node clockwise; a node covers the slices up to it."""
    nodes: dict[int, int] = {}
    for shard in range(shards):
        for number in range(virtual):
            name = f"{shard}/{number}".encode()
            spot = int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "big") >> (64 - bits)
            nodes.setdefault(spot, shard)
    owners, current = [0] * (1 << bits), nodes[min(nodes)]
    for spot in range((1 << bits) - 1, -1, -1):
        current = nodes.get(spot, current)
        owners[spot] = current
    return owners


def clockwise(owners: list[int], shards: int) -> list[list[int]]:
    """For each slice all shards in the order in which they come clockwise."""
    following: list[int] = list(dict.fromkeys(owners))
    following += [s for s in range(shards) if s not in following]
    out: list[list[int]] = [[]] * len(owners)
    for spot in range(len(owners) - 1, -1, -1):
        shard = owners[spot]
        if following[0] != shard:
            following = [shard, *(s for s in following if s != shard)]
        out[spot] = following
    return out


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Rows that each shard may hold: an even share, or (1 + slack) times that, rounded up.

    Without slack the first ``total mod shards`` shards hold one row more than the others.
    """
    if slack > 0:
        return [math.ceil((1 + slack) * total / shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def allotted(sizes: dict[int, int], shards: int, slack: float, virtual: int = VIRTUAL):
    """Pieces (slice, from_rank, to_rank, shard, slot of from_rank) that cover all rows."""
    orders = clockwise(ring(shards, virtual), shards)
    room = capacities(sum(sizes.values()), shards, slack)
    used = [0] * shards
    waiting = [(spot, 0, n) for spot, n in sorted(sizes.items())]
    pieces = []
    for turn in range(shards):
        later = []
        for spot, start, stop in waiting:
            shard = orders[spot][turn]
            taken = min(stop - start, room[shard] - used[shard])
            if taken > 0:
                pieces.append((spot, start, start + taken, shard, used[shard]))
                used[shard] += taken
            if start + taken < stop:
                later.append((spot, start + taken, stop))
        waiting = later
    if waiting:
        raise RuntimeError("capacities do not cover the rows")
    return pieces


def sharded(
    docs: DataFrame, shards: int = 8, slack: float = 0.0, id_col: str = "doc_id",
    text_col: str = "text", keep: bool = True,
) -> DataFrame:
    """``docs`` plus size, text_crc32, law, shard, slot and grown_shard.

    ``size`` is the text's UTF-8 bytes plus 1. With ``slack`` 0 the law is ``rows``: shard sizes
    differ by one at most. ``slot`` counts from 0 without gaps in every shard; ``grown_shard`` is
    null, since with bounds other documents decide too. Null texts have size 1 and the crc of an
    empty text; rows without an id are placed by their text and their place in the input; repeated
    rows are rows of their own, in slots of their own. Columns of ``docs`` with the names above are
    replaced, all others are kept whatever their names. ``keep=False`` returns only the id as
    ``doc_id`` and the new columns. An empty table gives no rows.
    """
    # The input's columns go under names of their own, so that none can clash with a working one.
    taken = {x.lower() for x in ADDED}
    kept = [c for c in docs.columns if keep and c.lower() not in taken]
    names = [f"c{i}" for i in range(len(kept))]
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    base = docs.select(
        *[F.col(quoted(c)).alias(n) for c, n in zip(kept, names, strict=True)],
        F.col(quoted(id_col)).alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        spread_point(F.col(quoted(id_col)), text).alias("place"),
    )
    # Points of rows without an id depend on the order of the rows, so these are written once.
    if keep:
        base = base.where("doc_id is not null").unionByName(materialize(base.where("doc_id is null")))
    else:
        base = materialize(base)
    base = base.withColumn("slice", slice_of(F.col("place"), SLICE_BITS))
    sizes = {r["slice"]: r["count"] for r in base.groupBy("slice").count().collect()}
    pieces = base.sparkSession.createDataFrame(
        allotted(sizes, shards, slack) if sizes else [],
        "its_slice int, from_rank long, to_rank long, shard int, base long",
    )
    order = Window.partitionBy("slice").orderBy("place", "doc_id", "size", "text_crc32")
    own = (F.col("slice") == F.col("its_slice")) & F.col("inside").between(
        F.col("from_rank"), F.col("to_rank") - 1
    )
    placed = base.withColumn("inside", F.row_number().over(order) - 1).join(F.broadcast(pieces), own)
    slot = (F.col("base") + F.col("inside") - F.col("from_rank")).cast("long")
    first = [F.col(n).alias(c) for c, n in zip(kept, names, strict=True)] if keep else [F.col("doc_id")]
    return placed.select(
        *first, "size", "text_crc32", F.lit("rows" if slack == 0 else "bounded").alias("law"), "shard",
        slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
