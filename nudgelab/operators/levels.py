"""Levels of text columns: bounded detection, and counts of level pairs for many columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nudgelab.functions.scalars import column

#: Most levels of a column whose pairs are counted in dense arrays.
DENSE_LEVELS = 128


def _as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[column(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)])


def bounded_levels(df: DataFrame, columns: Sequence[str], limit: int) -> dict[str, list[str] | None]:
    """The levels of each column, or None for a column with ``limit`` or more.

    One pass. A task keeps at most ``limit`` values of a column and looks at the column no longer
    once it has that many, so the shuffle holds at most tasks x columns x ``limit`` values and a
    column of distinct keys costs next to nothing. Nulls are no level.
    """
    if not columns:
        return {}
    names = [f"c{i}" for i in range(len(columns))]
    schema = pa.schema([("place", pa.int32()), ("level", pa.string())])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[set] = [set() for _ in names]
        for batch in batches:
            for held, name in zip(seen, names, strict=True):
                if len(held) < limit:
                    held.update(pc.unique(batch.column(name)).drop_null().to_pylist())
        places = [i for i, held in enumerate(seen) for _ in range(min(len(held), limit))]
        levels = [v for held in seen for v in sorted(held)[:limit]]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(levels, pa.string())], schema=schema)

    found = _as_text(df, columns).mapInArrow(collect, "place int, level string").distinct()
    kept = found.groupBy("place").agg(F.count("*").alias("n")).where(F.col("n") < limit)
    out: dict[str, list[str] | None] = {c: None for c in columns}
    rows = found.join(kept, "place").select("place", "level").orderBy("place", "level").collect()
    for r in kept.collect():
        out[columns[r["place"]]] = []
    for r in rows:
        out[columns[r["place"]]].append(r["level"])
    empty = [i for i, c in enumerate(columns) if out[c] is None]
    if empty:
        known = _as_text(df, [columns[i] for i in empty]).agg(
            *[F.count(f"c{k}").alias(f"c{k}") for k in range(len(empty))]
        ).first()
        out |= {columns[i]: [] for k, i in enumerate(empty) if known[k] == 0}
    return out


def pair_counts(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """(feature_1, feature_2, v1, v2, n): rows of each pair of levels, columns i <= j, both known.

    Values are coded by the given levels (all that occur). A task counts every pair of columns in a
    dense array and hands on the cells that are not empty: at most pairs x levels^2 rows a task.
    """
    names = list(levels)
    sizes = [len(levels[c]) for c in names]
    coded = [pa.array(levels[c], pa.string()) for c in names]
    pairs = [(a, b) for a in range(len(names)) for b in range(a, len(names))]
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("i", pa.int32()), ("j", pa.int32()),
                        ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = {p: np.zeros((sizes[p[0]], sizes[p[1]]), dtype=np.int64) for p in pairs}
        for batch in batches:
            codes = [
                pc.fill_null(pc.index_in(batch.column(f"c{k}"), value_set=coded[k]), -1).to_numpy()
                for k in range(len(names))
            ]
            for a, b in pairs:
                both = (codes[a] >= 0) & (codes[b] >= 0)
                flat = codes[a][both].astype(np.int64) * sizes[b] + codes[b][both]
                cells[a, b] += np.bincount(flat, minlength=sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])
        for (a, b), table in cells.items():
            i, j = np.nonzero(table)
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), a), pa.int32()), pa.array(np.full(len(i), b), pa.int32()),
                     pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(table[i, j])], schema=schema,
                )

    summed = (
        _as_text(df, names).mapInArrow(count, "a int, b int, i int, j int, n long")
        .groupBy("a", "b", "i", "j").agg(F.sum("n").alias("n"))
    )
    coding = [(k, i, c, v) for k, c in enumerate(names) for i, v in enumerate(levels[c])]
    table = F.broadcast(
        df.sparkSession.createDataFrame(coding, "column int, code int, feature string, level string")
    )
    for side, (k, i) in (("1", ("a", "i")), ("2", ("b", "j"))):
        own = table.select(
            F.col("column").alias(k), F.col("code").alias(i),
            F.col("feature").alias(f"feature_{side}"), F.col("level").alias(f"v{side}"),
        )
        summed = summed.join(own, [k, i])
    return summed.select("feature_1", "feature_2", "v1", "v2", "n")
