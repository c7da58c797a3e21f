"""Exact interpolated quantiles at any size: of whole columns, and per group."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import accumulate
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nudgelab.functions.scalars import column
from nudgelab.operators.prefix import running_totals
from nudgelab.session import cut_lineage, materialize

#: Size of the sketches that enclose a column's quantiles: ranks within 2 / k^0.9 = 0.11 %.
SKETCH_K = 4096
# A group with more distinct values than this is not summarised inside one task.
GROUP_LIMIT = 100_000
BROADCAST_GROUPS = 500_000


# --- per group -------------------------------------------------------------------------


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    by: Sequence[str] = (),
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Quantiles per group.

    Equal values collapse first. Groups of up to ``group_limit`` distinct values
    use the built-in aggregate; larger groups, if there are any, are cut into
    ranges and counted across tasks. The frame is read twice, so pass a
    materialised one when it is costly.
    """
    collapsed = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias(value))
        .agg(F.count("*").alias("n"))
    )
    if not by:
        return by_running_counts(collapsed, value, probabilities)
    keys = list(by)
    large = cut_lineage(
        collapsed.groupBy(*keys).agg(F.count("*").alias("d")).where(F.col("d") > group_limit)
    ).drop("d")
    n_large = large.count()
    if n_large == 0:
        return by_value_counts(collapsed, value, probabilities, keys)
    listed = large.withColumnsRenamed({k: f"_large_{k}" for k in keys})
    if n_large <= BROADCAST_GROUPS:
        listed = F.broadcast(listed)
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_large_{k}")) for k in keys))
    small_part = by_value_counts(
        collapsed.join(listed, same, "left_anti"), value, probabilities, keys
    )
    large_part = by_running_counts(
        collapsed.join(listed, same, "left_semi"), value, probabilities, keys
    )
    return small_part.unionByName(large_part)


def by_value_counts(
    collapsed: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str]
) -> DataFrame:
    """Quantiles of groups small enough for one task each, from (value, n) rows."""
    wanted = F.percentile(column(value), list(probabilities.values()), F.col("n"))
    return collapsed.groupBy(*by).agg(wanted.alias("_q")).select(
        *by, *(F.col("_q")[i].alias(name) for i, name in enumerate(probabilities))
    )


def by_running_counts(
    collapsed: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles of groups of any size: pick the values that straddle each position."""
    v, run, total = column(value), F.col("n_run"), F.col("n_all")
    counted = running_totals(collapsed, [v], ["n"], by)

    def holds(position: Column) -> Column:
        return (run - F.col("n") <= position) & (position < run)

    wanted = F.lit(False)
    picks = []
    for name, p in probabilities.items():
        exact = (total - 1) * F.lit(p)
        low, high = F.floor(exact), F.ceil(exact)
        wanted = wanted | holds(low) | holds(high)
        low_value = F.max(F.when(holds(low), v))
        high_value = F.max(F.when(holds(high), v))
        weight, left = F.max(exact - low), F.max(high - exact)
        between = low_value * left + high_value * weight
        picks.append(F.when(weight == 0, low_value).otherwise(between).cast("double").alias(name))
    return counted.where(wanted).groupBy(*by).agg(*picks)


# --- whole columns ---------------------------------------------------------------------


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: dict[str, float], k: int = SKETCH_K
) -> DataFrame:
    """Exact quantiles of whole columns, one row per column with values, in two reads of ``df``.

    The first read makes one mergeable sketch a column, whose ranks enclose every wanted position in
    a bracket of values. The second counts the rows between the brackets and the values inside
    them; a position is then picked by count, so no error of the sketch is left in the result. A
    bracket that misses its position (the sketch's bounds hold with a high probability) is opened
    and the rows are counted once more. Nulls and NaN are no values.
    """
    names = [f"c{i}" for i in range(len(columns))]
    doubles = df.select(
        *(F.nanvl(column(c).cast("double"), F.lit(None)).alias(n) for c, n in zip(columns, names, strict=True))
    )
    ranks, sizes = _sketch_ranks(doubles, names, probabilities, k)
    title = {n: c for n, c in zip(names, columns, strict=True) if sizes[n] > 0}
    schema = ", ".join(["column string", *(f"{p} double" for p in probabilities)])
    if not title:
        return df.sparkSession.createDataFrame([], schema)
    positions = {
        n: {p: (sizes[n] - 1) * share for p, share in probabilities.items()} for n in title
    }
    brackets = {n: _merged(ranks[n]) for n in title}
    while True:
        counted = materialize(_bracket_counts(doubles, brackets))
        before, inside = _gap_sums(counted, brackets)
        missed = {
            n for n, wanted in positions.items()
            for exact in wanted.values() for at in (math.floor(exact), math.ceil(exact))
            if _bracket_of(at, before[n], inside[n]) is None
        }
        if not missed:
            break
        brackets |= {n: [(-math.inf, math.inf)] for n in missed}
    targets = [
        (n, c, p, low, high, math.floor(exact) - before[n][low], math.ceil(exact) - before[n][high],
         exact - math.floor(exact))
        for n, c in title.items() for p, exact in positions[n].items()
        for low in [_bracket_of(math.floor(exact), before[n], inside[n])]
        for high in [_bracket_of(math.ceil(exact), before[n], inside[n])]
    ]
    return _picked(counted, targets, max(max(x) for x in inside.values()), list(probabilities))


def _sketch_ranks(
    doubles: DataFrame, names: Sequence[str], probabilities: dict[str, float], k: int
) -> tuple[dict[str, list[tuple[float, float]]], dict[str, int]]:
    """Brackets of values around every wanted position, and the number of values."""
    error = 2.0 / k**0.9
    row = doubles.agg(
        *(F.count(n).alias(f"{n}_n") for n in names),
        *(F.kll_sketch_agg_double(n, F.lit(k)).alias(n) for n in names),
    ).first()
    sizes = {n: row[f"{n}_n"] for n in names}
    known = [n for n in names if sizes[n]]
    if not known:
        return {}, sizes
    # Ranks depend on the sizes, so they are looked up in a second step, on one row of sketches.
    table = doubles.sparkSession.createDataFrame(
        [tuple(row[n] for n in known)], ", ".join(f"{n} binary" for n in known)
    )
    ends = []
    for n in known:
        for share in probabilities.values():
            exact = (sizes[n] - 1) * share
            ranks = (math.floor(exact) / sizes[n] - error, (math.ceil(exact) + 1) / sizes[n] + error)
            ends.append(F.array(*(
                F.kll_sketch_get_quantile_double(n, F.lit(min(1.0, max(0.0, r)))) for r in ranks
            )))
    found = table.select(F.array(*ends)).first()[0]
    step = len(probabilities)
    return {
        n: [(lo, hi) for lo, hi in found[i * step : (i + 1) * step]] for i, n in enumerate(known)
    }, sizes


def _merged(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Disjoint brackets in ascending order."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _bracket_counts(
    doubles: DataFrame, brackets: dict[str, list[tuple[float, float]]]
) -> DataFrame:
    """(name, place, value, n): rows in gap ``place`` (even, no value) or of a bracket's value.

    Places are found by binary search over whole Arrow batches: as expressions, the comparisons of
    all columns with all brackets would be too wide for generated code.
    """
    ends = {n: tuple(np.array(x) for x in zip(*found, strict=True)) for n, found in brackets.items()}
    schema = pa.schema([("name", pa.string()), ("place", pa.int32()), ("value", pa.float64()), ("n", pa.int64())])

    def rows_of(name: str, places: np.ndarray, values: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        names = pa.array([name] * len(places), pa.string())
        return pa.RecordBatch.from_arrays(
            [names, pa.array(places, pa.int32()), values, pa.array(counts, pa.int64())], schema=schema
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = {n: np.zeros(len(lows) + 1, dtype=np.int64) for n, (lows, _) in ends.items()}
        for batch in batches:
            for n, (lows, highs) in ends.items():
                v = batch.column(n).drop_null().to_numpy()
                at = np.searchsorted(highs, v)
                inside = (at < len(highs)) & (v >= lows[np.minimum(at, len(highs) - 1)])
                gaps[n] += np.bincount(at[~inside], minlength=len(lows) + 1)
                found, counts = np.unique(v[inside], return_counts=True)
                if len(found):
                    yield rows_of(n, 2 * np.searchsorted(highs, found) + 1, pa.array(found), counts)
        for n, counts in gaps.items():
            held = np.flatnonzero(counts)
            yield rows_of(n, 2 * held, pa.nulls(len(held), pa.float64()), counts[held])

    rows = doubles.select(*ends).mapInArrow(count, "name string, place int, value double, n long")
    return rows.groupBy("name", "place", "value").agg(F.sum("n").alias("n"))


def _gap_sums(
    counted: DataFrame, brackets: dict[str, list[tuple[float, float]]]
) -> tuple[dict[str, list[int]], dict[str, list[int]]]:
    """Rows before each bracket, and in it; one number for each gap and bracket comes back."""
    sums = {n: [0] * (2 * len(found) + 1) for n, found in brackets.items()}
    for r in counted.groupBy("name", "place").agg(F.sum("n").alias("n")).collect():
        sums[r["name"]][r["place"]] = r["n"]
    before, inside = {}, {}
    for n, found in sums.items():
        upto = list(accumulate(found))
        before[n] = upto[0:-1:2]
        inside[n] = found[1::2]
    return before, inside


def _bracket_of(position: int, before: list[int], inside: list[int]) -> int | None:
    for i, (first, size) in enumerate(zip(before, inside, strict=True)):
        if first <= position < first + size:
            return i
    return None


def _picked(
    counted: DataFrame, targets: list[tuple], largest: int, probabilities: list[str]
) -> DataFrame:
    """The quantile of each target from the ranked values of its brackets."""
    values = counted.where("value IS NOT NULL").select(
        F.concat_ws(":", "name", F.floor(F.col("place") / 2)).alias("bracket"), "value", "n"
    )
    if largest <= GROUP_LIMIT:
        upto = Window.partitionBy("bracket").orderBy("value")
        ranked = values.withColumn("n_run", F.sum("n").over(upto))
    else:
        ranked = running_totals(values, [F.col("value")], ["n"], ["bracket"])
    wanted = counted.sparkSession.createDataFrame(
        [(f"{n}:{b}", c, p, at, side, w) for n, c, p, low, high, at_low, at_high, w in targets
         for b, at, side in ((low, at_low, "low"), (high, at_high, "high"))],
        "bracket string, column string, probability string, at long, side string, w double",
    )
    run = F.col("n_run")
    held = (run - F.col("n") <= F.col("at")) & (F.col("at") < run)
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("value")))
    low, high, w = of("low"), of("high"), F.max("w")
    return (
        ranked.join(F.broadcast(wanted), "bracket")
        .where(held)
        .groupBy("column")
        .pivot("probability", probabilities)
        .agg(F.when(w == 0, low).otherwise(low * (1 - w) + high * w))
    )
