"""Mixing sources to target weights by Pfair scheduling.

Weights are whole numbers out of a hyperperiod of D slots. Block j of a source of weight w is
released at slot floor(j D / w) and due at ceil((j + 1) D / w). Earliest deadline first runs one
block per slot; all deadlines hold, so at every slot each source is less than one block away from
its share. The schedule repeats with the hyperperiod: it is computed once, for D slots, and block j
of a source takes the slot of block j mod w, (j div w) hyperperiods later. Everything else is a
join of ranks with that table.

A source is read in a hashed order, and again from the start (next epoch) when it ends. The mix
runs until every source has been read whole once, so no document is lost, and sources below
their target are repeated.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nudgelab.llm.common import quoted, without
from nudgelab.llm.positions import point, ranked

HYPERPERIOD = 1000
BLOCK_ROWS = 16
#: Target weights are proportional to the size of a source to this power.
EXPONENT = 0.8
#: Rows of a slice of one source, roughly.
SLICE_ROWS = 20_000
#: Sources the weights table may hold.
MAX_SOURCES = 100_000
_OWN = ("place", "slice", "rank", "need", "weight", "its_source", "copies", "mix_epoch",
        "mix_source", "number", "cycle_slot", "in_block", "mix_slot", "mix_position",
        "key_source", "key_number")


def whole_weights(shares: dict[str, float], hyperperiod: int = HYPERPERIOD) -> dict[str, int]:
    """Whole weights that sum to the hyperperiod (or 10 per source, if more), at least 1 each.

    The largest remainders are rounded up; ties go to the first name.
    """
    if not shares:
        return {}
    if any(not x > 0 for x in shares.values()):
        raise ValueError("target weights must be positive")
    slots = max(hyperperiod, 10 * len(shares))
    total, spare = sum(shares.values()), slots - len(shares)
    exact = {s: spare * x / total for s, x in shares.items()}
    weights = {s: 1 + math.floor(x) for s, x in exact.items()}
    rest = sorted(shares, key=lambda s: (math.floor(exact[s]) - exact[s], s))
    for s in rest[: slots - sum(weights.values())]:
        weights[s] += 1
    return weights


def schedule(weights: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, slot) over one hyperperiod, earliest deadline first."""
    slots = sum(weights.values())
    released = sorted(
        (j * slots // w, -(-(j + 1) * slots // w), s, j)
        for s, w in weights.items() for j in range(w)
    )
    ready: list[tuple[int, str, int]] = []
    out, following = [], 0
    for slot in range(slots):
        while following < len(released) and released[following][0] <= slot:
            _, due, source, j = released[following]
            heapq.heappush(ready, (due, source, j))
            following += 1
        due, source, j = heapq.heappop(ready)
        if slot >= due:
            raise RuntimeError("a deadline was missed")
        out.append((source, j, slot))
    return out


def horizon(
    sizes: dict[str, int], weights: dict[str, int], plan: list[tuple[str, int, int]], block: int
) -> tuple[int, dict[str, int]]:
    """Slots until every source is read whole, and the blocks each source has had by then."""
    if not plan:
        return 0, {}
    slots = {(s, j): slot for s, j, slot in plan}
    period, end = len(plan), 0
    for s, n in sizes.items():
        last = max(1, -(-n // block)) - 1
        end = max(end, last // weights[s] * period + slots[s, last % weights[s]] + 1)
    rest, given = end % period, {s: end // period * w for s, w in weights.items()}
    for s, _, slot in plan:
        given[s] += slot < rest
    return end, given


def mixed(
    docs: DataFrame, weights: dict[str, float] | None = None, exponent: float = EXPONENT,
    block_rows: int = BLOCK_ROWS, source_col: str = "source", id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` plus mix_source, mix_epoch, mix_slot and mix_position (gapless from 0).

    ``weights`` gives target shares by source name; without it they follow the sources' sizes to
    the power ``exponent``. Sources missing from ``weights`` raise. A null source is the source
    named ``(none)``. Null ids are ordered by their text; repeated rows are rows of their own; an
    empty table gives no rows. Columns of ``docs`` with the names above, or with names of working
    columns (``place``, ``rank`` and so on), are replaced or dropped; :func:`mix_of` keeps exactly
    the input's columns.
    """
    rows = without(docs, _OWN).withColumns({
        "mix_source": F.coalesce(F.col(quoted(source_col)).cast("string"), F.lit("(none)")),
        "place": point(F.col(quoted(id_col)), F.coalesce(F.col(quoted(text_col)), F.lit(""))),
    })
    counted = rows.groupBy("mix_source").count().limit(MAX_SOURCES + 1).collect()
    if len(counted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r["mix_source"]: r["count"] for r in counted}
    shares = {s: float(n) ** exponent for s, n in sizes.items()}
    if weights is not None:
        if unknown := sorted(set(sizes) - set(weights)):
            raise ValueError(f"no target weight for {unknown[:5]}")
        shares = {s: float(weights[s]) for s in sizes}
    whole = whole_weights(shares)
    plan = schedule(whole)
    _, given = horizon(sizes, whole, plan, block_rows)
    spark = docs.sparkSession
    needs = spark.createDataFrame(
        [(s, given[s] * block_rows, sizes[s], whole[s]) for s in sizes],
        "its_source string, emitted long, need long, weight int",
    )
    table = spark.createDataFrame(plan, "key_source string, key_number long, cycle_slot long")
    bits = max(0, math.ceil(math.log2(max(1, sum(sizes.values()) / SLICE_ROWS))))
    placed = ranked(rows, ["mix_source"], ["place", quoted(id_col)], max(1, min(30, bits)))
    copies = F.sequence(
        F.lit(0), F.floor((F.col("emitted") - 1 - F.col("rank")) / F.col("need")).cast("int")
    )
    epochs = (
        placed.join(F.broadcast(needs), F.col("mix_source") == F.col("its_source"))
        .withColumn("mix_epoch", F.explode(copies))
        .withColumn("in_block", F.col("rank") + F.col("mix_epoch") * F.col("need"))
        .withColumn("number", F.floor(F.col("in_block") / block_rows))
    )
    timed = epochs.join(
        F.broadcast(table),
        (F.col("mix_source") == F.col("key_source"))
        & (F.col("number") % F.col("weight") == F.col("key_number")),
    )
    slot = F.floor(F.col("number") / F.col("weight")) * len(plan) + F.col("cycle_slot")
    return timed.withColumn("mix_slot", slot).withColumn(
        "mix_position", F.col("mix_slot") * block_rows + F.col("in_block") % block_rows
    ).drop("place", "slice", "rank", "need", "emitted", "weight", "its_source", "in_block",
           "number", "key_source", "key_number", "cycle_slot")


def mix_of(docs: DataFrame, **settings) -> DataFrame:
    """The mix with exactly the columns of ``docs``: repeated rows stand for further epochs."""
    names = {c: f"__{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(quoted(c)).alias(n) for c, n in names.items()])
    short = {k: names[settings.pop(f"{k}_col", d)]
             for k, d in (("source", "source"), ("id", "doc_id"), ("text", "text"))}
    out = mixed(plain, source_col=short["source"], id_col=short["id"], text_col=short["text"], **settings)
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])
