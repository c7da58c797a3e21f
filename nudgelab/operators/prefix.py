"""Running totals over a global order, without a single task and with one shuffle of the rows.

``Window.orderBy`` without a partition sends the whole table to one task, and a window per key does
the same for a hot key. Here rows are range-partitioned on (keys, order) into slices and sorted
inside them. While a slice is written, its task adds up running sums from Arrow batches and marks
the rows that end a group which the slice's border (or its size) cuts. The marked rows, a few a
slice, give the shifts of the slices, and one read of the written rows adds them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nudgelab.session import materialize, slice_count

SLICE, ENDS = "_slice", "_ends"
WHOLE = "_whole"
#: Rows of one group that a task holds until the group's total is known.
HELD_ROWS = 200_000


def running_totals(
    df: DataFrame, order: Sequence[Column], sums: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Add ``<c>_run`` (inclusive running sum) and ``<c>_all`` (group total) per column.

    ``order`` must be a total order inside each group; null is a group of its own, and null counts
    as 0. Sums are longs or doubles. The sorted rows are written as a table, which is read twice:
    for its few marked rows, and for the result.
    """
    keys = list(by)
    if not keys:
        df = df.withColumn(WHOLE, F.lit(0))
        keys = [WHOLE]
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}
    df = df.withColumns({c: F.col(c).cast("long" if c in whole else "double") for c in sums})
    kinds = [df.schema[c].dataType for c in sums]
    added = [T.StructField(f"{c}_{part}", k) for part in ("run", "all") for c, k in zip(sums, kinds, strict=True)]
    schema = T.StructType(
        [*df.schema.fields, *added, T.StructField(SLICE, T.IntegerType()), T.StructField(ENDS, T.BooleanType())]
    )
    ranged = df.repartitionByRange(
        slice_count(df.sparkSession), *(F.col(k) for k in keys), *order
    ).sortWithinPartitions(*(F.col(k) for k in keys), *order)
    local = materialize(ranged.mapInArrow(_accumulate(keys, list(sums), HELD_ROWS), schema))

    shifts = _shifts(local, keys, sums).withColumnsRenamed({c: f"_border_{c}" for c in (SLICE, *keys)})
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_border_{c}")) for c in (SLICE, *keys)))
    shifted = local.join(F.broadcast(shifts), same, "left")
    extra = [f"{c}_{part}" for c in sums for part in ("before", "group")]
    extra += [f"_border_{c}" for c in (SLICE, *keys)]
    return shifted.withColumns(
        {f"{c}_run": F.col(f"{c}_run") + F.coalesce(f"{c}_before", F.lit(0)) for c in sums}
        | {f"{c}_all": F.coalesce(f"{c}_group", f"{c}_all") for c in sums}
    ).drop(SLICE, ENDS, WHOLE, *extra)


def _shifts(local: DataFrame, keys: list[str], sums: Sequence[str]) -> DataFrame:
    """Per slice and marked group: the sum over earlier slices and over all slices."""
    marked = local.where(ENDS).select(SLICE, *keys, *(F.col(f"{c}_run").alias(c) for c in sums))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return marked.select(
        SLICE,
        *keys,
        *(F.sum(c).over(earlier).alias(f"{c}_before") for c in sums),
        *(F.sum(c).over(group).alias(f"{c}_group") for c in sums),
    )


@dataclass
class _Slice:
    """What a task knows of the groups of its slice so far."""

    number: int
    sums: list[str]
    carried: list = field(default_factory=list)
    """Running sums of the open group's rows that were handed on already."""
    is_first: bool = True
    is_continued: bool = False

    def __post_init__(self) -> None:
        self.carried = [0] * len(self.sums)

    def finished(self, table: pa.Table, starts: np.ndarray, is_open: bool, is_last: bool) -> pa.Table:
        """``table`` (whole groups beginning at ``starts``) with running sums, totals and marks.

        ``is_open``: the one group of the table goes on after it. ``is_last``: the last group ends
        the slice. The totals of the slice's first and last group, and of a group whose rows were
        handed on piece by piece, are for the shifts to tell; their last rows are marked.
        """
        n = table.num_rows
        ends = np.append(starts[1:], n)
        known = np.ones(len(starts), dtype=bool)
        if self.is_first or self.is_continued or is_open:
            known[0] = False
        if is_last:
            known[-1] = False
        marked = np.zeros(n, dtype=bool)
        if not is_open:
            marked[ends[~known] - 1] = True
        sizes = ends - starts
        runs, totals = [], []
        for i, c in enumerate(self.sums):
            values = pc.fill_null(table.column(c), 0).to_numpy()
            upto = np.cumsum(values)
            base = upto[starts] - values[starts]
            base[0] -= self.carried[i]
            runs.append(pa.array(upto - np.repeat(base, sizes), table.schema.field(c).type))
            total = np.repeat(upto[ends - 1] - base, sizes)
            totals.append(pa.array(total, table.schema.field(c).type, mask=np.repeat(~known, sizes)))
            self.carried[i] = runs[-1][n - 1].as_py() if is_open else 0
        self.is_first, self.is_continued = self.is_first and is_open, is_open
        for part, columns in (("run", runs), ("all", totals)):
            for c, column in zip(self.sums, columns, strict=True):
                table = table.append_column(f"{c}_{part}", column)
        table = table.append_column(SLICE, pa.array(np.full(n, self.number, np.int32)))
        return table.append_column(ENDS, pa.array(marked))


def _group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers where a group begins; nulls are equal to each other."""
    changed = np.zeros(table.num_rows, dtype=bool)
    changed[0] = True
    for k in keys:
        column = table.column(k).combine_chunks()
        a, b = column.slice(0, len(column) - 1), column.slice(1)
        differs = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        nulls = column.is_null().to_numpy(zero_copy_only=False)
        changed[1:] |= differs | (nulls[1:] != nulls[:-1])
    return np.flatnonzero(changed)


def _accumulate(keys: list[str], sums: list[str], most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Slice(TaskContext.get().partitionId(), sums)
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            starts = _group_starts(held, keys)
            if len(starts) > 1:
                cut = int(starts[-1])
                yield from state.finished(held.slice(0, cut), starts[:-1], False, False).to_batches()
                held = held.slice(cut)
            elif held.num_rows > most:
                # All but the last row, which may yet turn out to end the group.
                part = held.slice(0, held.num_rows - 1)
                yield from state.finished(part, starts, True, False).to_batches()
                held = held.slice(held.num_rows - 1)
        if held is not None:
            yield from state.finished(held, np.zeros(1, np.int64), False, True).to_batches()

    return run
