"""Ranks inside groups of any size, without a task that holds a whole group.

Rows are spread by a hash point over slices of the ring of 64-bit values. Ranks are counted
inside a slice and shifted by the sizes of the slices before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def point(id_col: Column, text: Column) -> Column:
    """A 64-bit hash of the id; rows without an id take that of their text."""
    return F.when(id_col.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(id_col))


def spread_point(id_col: Column, text: Column) -> Column:
    """Like :func:`point`, but rows without an id are spread by their place in the input too.

    For tables where one text without an id may be repeated very often: equal rows take different
    points, and which row takes which is of no consequence.
    """
    spot = F.xxhash64(text, F.monotonically_increasing_id())
    return F.when(id_col.isNull(), spot).otherwise(F.xxhash64(id_col))


def slice_of(place: Column, bits: int) -> Column:
    """The first ``bits`` bits of a point, as a number from 0 on."""
    return F.shiftrightunsigned(place, 64 - bits).cast("int")


def ranked(rows: DataFrame, group: list[str], order: list[str], bits: int) -> DataFrame:
    """``rows`` (with a column ``place``) plus ``rank``, gapless from 0 in every group.

    The order is that of (slice, ``order``); ties keep ranks of their own. The sizes table has a
    row per group and slice, 2^bits at most for each group.
    """
    cut = rows.withColumn("slice", slice_of(F.col("place"), bits))
    sizes = cut.groupBy(*group, "slice").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *[F.col(g).alias(f"its_{g}") for g in group], F.col("slice").alias("its_slice"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"),
    )
    inside = F.row_number().over(Window.partitionBy(*group, "slice").orderBy(*order)) - 1
    same = F.col("slice") == F.col("its_slice")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"its_{g}"))
    return (
        cut.withColumn("inside", inside)
        .join(shifts, same)
        .withColumn("rank", F.col("shift") + F.col("inside"))
        .drop("inside", "shift", "its_slice", *[f"its_{g}" for g in group])
    )
