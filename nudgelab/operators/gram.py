"""Sums of products over the rows where both columns are known, for all pairs at once.

Each task adds up four small matrices over its Arrow batches: X'X, X'M, (X*X)'M and M'M, with the
values taken from a shift near their mean and 0 where a value is unknown (M marks the known ones).
One row for each pair and task is shuffled; no row of the table fans out to its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nudgelab.functions.scalars import column

_SUMS = ("n", "x", "y", "xx", "yy", "xy")
#: A spread below this share of the sum of squares is rounding error of a constant.
_NOISE = 1e-13


def pair_sums(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(i, j, n, x, y, xx, yy, xy) for i <= j over the rows that know both; shifted values.

    The shift is each column's mean, so sums of squares lose no digits to a large offset. The table
    is read twice. Pairs without a common row have n = 0.
    """
    width = len(features)
    doubles = [column(c).cast("double") for c in features]
    means = df.agg(*[F.avg(d).alias(f"m{i}") for i, d in enumerate(doubles)]).first()
    shift = np.array([0.0 if m is None or not np.isfinite(m) else m for m in means])
    i, j = np.triu_indices(width)
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), *[(c, pa.float64()) for c in _SUMS]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(_SUMS), len(i)))
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("v").flatten()
            known = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width)
            x = flat.to_numpy(zero_copy_only=False).reshape(-1, width) - shift
            x = np.where(known, x, 0.0)
            m = known.astype(float)
            sums, squares = x.T @ m, (x * x).T @ m
            products = (m.T @ m, sums, sums.T, squares, squares.T, x.T @ x)
            total += np.stack([p[i, j] for p in products])
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(t) for t in total]],
            schema=schema,
        )

    kinds = "i int, j int, " + ", ".join(f"{c} double" for c in _SUMS)
    parts = df.select(F.array(*doubles).alias("v")).mapInArrow(add, kinds)
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _SUMS])


def correlation() -> Column:
    """Pearson r from a row of :func:`pair_sums`; null for fewer than two rows or a constant."""
    n = F.col("n")
    spread = lambda a, aa: F.col(aa) - F.col(a) * F.col(a) / n
    varies = lambda a, aa: spread(a, aa) > _NOISE * F.col(aa)
    r = (F.col("xy") - F.col("x") * F.col("y") / n) / F.sqrt(spread("x", "xx") * spread("y", "yy"))
    bounded = F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))
    return F.when((n > 1) & varies("x", "xx") & varies("y", "yy"), bounded)
