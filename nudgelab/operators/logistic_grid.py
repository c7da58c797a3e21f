"""Many ridge logistic models in the passes of one.

A search fits the same rows again and again: every setting on every fold of every arm. Here all
these models advance together. The design matrix is written once in packed blocks; each pass reads
it once, and every task adds up the loss, gradient and Hessian of all models that are still moving.
The sums meet in one shuffle by model, and the driver, which holds a few kilobytes a model, takes a
Newton step. About ten passes fit any number of models.

The objective and the scaling are those of :class:`nudgelab.operators.learners.RidgeLogistic`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nudgelab.session import materialize, slice_count

BLOCK_ROWS = 8192
#: Newton steps end when the largest entry of the gradient is below this.
TOLERANCE = 1e-10
MOST_PASSES = 100
_BLOCK = "rows int, x binary, y binary, members binary"
_SUMS = "slot int, sums binary"
_SUMS_SCHEMA = pa.schema([("slot", pa.int32()), ("sums", pa.binary())])


@dataclass(frozen=True)
class Setting:
    """Inverse strength of the penalty, and whether both labels weigh the same in total."""

    c: float
    balanced: bool = False


@dataclass(frozen=True)
class Design:
    """Which columns make the matrix: numbers as they are, then one column for each text level."""

    numbers: tuple[str, ...]
    levels: tuple[tuple[str, tuple[str, ...]], ...]

    @staticmethod
    def of(rows: DataFrame, numbers: Sequence[str], texts: Sequence[str]) -> Design:
        """The levels of all rows; a level that a model has not seen gets no weight there."""
        found = []
        for text in texts:
            seen = rows.select(F.col(text).cast("string").alias("v")).where("v IS NOT NULL").distinct()
            found.append((text, tuple(sorted(r["v"] for r in seen.collect()))))
        return Design(tuple(numbers), tuple(found))

    @property
    def names(self) -> list[str]:
        return [*self.numbers, *[f"{t}={v}" for t, vs in self.levels for v in vs]]

    @property
    def scaled(self) -> np.ndarray:
        """True for the columns that are centred and scaled."""
        return np.arange(len(self.names)) < len(self.numbers)

    def column(self) -> Column:
        """The row of the matrix; null numbers are 0, null levels all zeros."""
        numbers = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in self.numbers]
        levels = [
            F.coalesce((F.col(t) == v).cast("double"), F.lit(0.0)) for t, vs in self.levels for v in vs
        ]
        return F.array(*numbers, *levels).cast("array<double>")


@dataclass(frozen=True)
class GridModel:
    """Models of all (subset, setting) pairs; weights belong to scaled columns."""

    design: Design
    subsets: tuple[str, ...]
    settings: tuple[Setting, ...]
    means: np.ndarray
    deviations: np.ndarray
    weights: np.ndarray
    """[subset, setting, column]"""
    intercepts: np.ndarray
    passes: int

    def margins(self, x: np.ndarray, subset: int) -> np.ndarray:
        """Log odds of the rows of ``x`` under every setting of one subset."""
        z = _scaled(x, self.means[subset], self.deviations[subset])
        return z @ self.weights[subset].T + self.intercepts[subset]

    def probabilities(self, x: np.ndarray, subset: int) -> np.ndarray:
        return _chance(self.margins(x, subset))


def fit_grid(
    rows: DataFrame, design: Design, label: str, subsets: dict[str, Column],
    settings: Sequence[Setting],
) -> GridModel:
    """Fit every setting on every subset of ``rows`` (conditions over its columns).

    The penalty of a model is ``1 / (C n)`` for the n rows of its subset; intercepts are free. A
    subset without rows, or with one label only, gives weights of 0 and the intercept of its label
    (half for none).
    """
    conditions = [F.coalesce(c, F.lit(False)).cast("int") for c in subsets.values()]
    blocks = materialize(
        rows.select(
            design.column().alias("x"), F.col(label).cast("double").alias("y"),
            F.array(*conditions).alias("members"),
        ).mapInArrow(_packed(len(design.names), len(subsets)), _BLOCK)
    )
    width, free = len(design.names), design.scaled
    sizes, ones, means, deviations = _moments(blocks, width, len(subsets), free)
    size = width + 1
    count = len(settings)
    state = np.zeros((len(subsets), count, size))
    weighing = np.ones((len(subsets), count, 2))
    ridge = np.zeros((len(subsets), count))
    for s, (n, k) in enumerate(zip(sizes, ones, strict=True)):
        usable = 0 < k < n
        for j, setting in enumerate(settings):
            ridge[s, j] = 1.0 / (setting.c * n) if n else 0.0
            if usable and setting.balanced:
                weighing[s, j] = n / (2.0 * (n - k)), n / (2.0 * k)
            if usable:
                low, high = weighing[s, j] * (n - k, k)
                state[s, j, -1] = np.log(high / low)
            else:
                state[s, j, -1] = 0.0 if not n else np.inf if k else -np.inf
    moving = [(s, j) for s in range(len(subsets)) for j in range(count) if 0 < ones[s] < sizes[s]]
    trusted = {at: (np.inf, state[at].copy(), np.zeros(size)) for at in moving}
    passes = 0
    while moving and passes < MOST_PASSES:
        passes += 1
        sums = _added(blocks, _derivatives(width, means, deviations, weighing, state, moving), len(moving))
        still = []
        for at, total in zip(moving, sums, strict=True):
            mass = total[1]
            loss = total[0] / mass + ridge[at] / 2 * (state[at][:-1] ** 2).sum()
            gradient = total[2 : 2 + size] / mass
            gradient[:-1] += ridge[at] * state[at][:-1]
            before, point, step = trusted[at]
            if loss > before + 1e-12 * abs(before):
                # Too long a step: half of it from the last good point.
                trusted[at] = before, point, step / 2
                state[at] = point + step / 2
                still += [at] if np.abs(step).max() > 1e-14 else []
                continue
            if np.abs(gradient).max() < TOLERANCE:
                continue
            hessian = total[2 + size :].reshape(size, size) / mass
            hessian[np.arange(width), np.arange(width)] += ridge[at]
            step = -np.linalg.lstsq(hessian, gradient, rcond=1e-15)[0]
            trusted[at] = loss, state[at].copy(), step
            state[at] = state[at] + step
            still.append(at)
        moving = still
    return GridModel(
        design, tuple(subsets), tuple(settings), means, deviations, state[:, :, :-1], state[:, :, -1], passes
    )


def scored_by(
    rows: DataFrame, model: GridModel, keep: Sequence[str], minuend: Column, subtrahend: Column
) -> DataFrame:
    """(``keep``, setting, score): probability of subset ``minuend`` less that of ``subtrahend``.

    The columns give each row's numbers of the two subsets; a row has one output row a setting.
    """
    kept = rows.select(*keep, design_x(model).alias("x"), minuend.alias("plus"), subtrahend.alias("minus"))
    out = [f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            plus, minus = (batch.column(c).to_numpy() for c in ("plus", "minus"))
            scores = np.zeros((batch.num_rows, len(model.settings)))
            for sign, side in ((1, plus), (-1, minus)):
                for s in np.unique(side):
                    at = side == s
                    scores[at] += sign * model.probabilities(x[at], int(s))
            table = pa.Table.from_batches([batch]).select(list(keep))
            for j in range(len(model.settings)):
                one = table.append_column("setting", pa.array(np.full(batch.num_rows, j, np.int32)))
                yield from one.append_column("score", pa.array(scores[:, j])).to_batches()

    return kept.mapInArrow(run, ", ".join([*out, "setting int", "score double"]))


def design_x(model: GridModel) -> Column:
    return model.design.column()


def _chance(margin: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-margin))


def _scaled(x: np.ndarray, means: np.ndarray, deviations: np.ndarray) -> np.ndarray:
    return np.where(deviations > 0, (x - means) / np.where(deviations > 0, deviations, 1.0), 0.0)


def _packed(width: int, subsets: int) -> Callable:
    schema = pa.schema([("rows", pa.int32()), ("x", pa.binary()), ("y", pa.binary()), ("members", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(low, BLOCK_ROWS)
                x = part.column("x").flatten().to_numpy().astype("<f8")
                members = part.column("members").flatten().to_numpy().astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int32()), pa.array([x.tobytes()]),
                     pa.array([part.column("y").to_numpy().astype("<f8").tobytes()]),
                     pa.array([members.tobytes()])], schema=schema,
                )

    return run


def _blocks(batches: Iterator[pa.RecordBatch], width: int, subsets: int) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            n = batch.column("rows")[i].as_py()
            read = lambda c, kind: np.frombuffer(batch.column(c)[i].as_buffer(), kind)  # noqa: B023, E731
            members = read("members", np.uint8).reshape(n, subsets).astype(bool)
            yield read("x", "<f8").reshape(n, width), read("y", "<f8"), members


def _added(blocks: DataFrame, measure: Callable, slots: int) -> list[np.ndarray]:
    """Sums of ``measure`` over all blocks: added up in each task, then by slot across tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for slot, sums in measure(batches):
            totals[slot] = totals[slot] + sums if slot in totals else sums
        if totals:
            packed = [x.astype("<f8").tobytes() for x in totals.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array(packed, pa.binary())], schema=_SUMS_SCHEMA
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(rows):
            for batch in rows:
                for slot, sums in zip(batch.column("slot"), batch.column("sums"), strict=True):
                    yield slot.as_py(), np.frombuffer(sums.as_buffer(), "<f8")

        totals: dict[int, np.ndarray] = {}
        for slot, sums in given(batches):
            totals[slot] = totals[slot] + sums if slot in totals else sums
        if totals:
            packed = [x.tobytes() for x in totals.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array(packed, pa.binary())], schema=_SUMS_SCHEMA
            )

    parts = min(slots, slice_count(blocks.sparkSession))
    found = blocks.mapInArrow(add, _SUMS).repartition(parts, "slot").mapInArrow(merge, _SUMS).collect()
    return [x for _, x in sorted((r["slot"], np.frombuffer(bytes(r["sums"]), "<f8").copy()) for r in found)]


def _moments(blocks: DataFrame, width: int, subsets: int, scaled: np.ndarray) -> tuple:
    """Rows, ones, means and sample deviations of every subset; unscaled columns have 0 and 1."""

    def sums(batches):
        for x, y, members in _blocks(batches, width, subsets):
            for s in range(subsets):
                at = members[:, s]
                yield s, np.concatenate([[at.sum(), y[at].sum()], x[at].sum(axis=0)])

    found = {s: v for s, v in enumerate(_added(blocks, sums, subsets))} if subsets else {}
    empty = np.zeros(2 + width)
    table = np.array([found.get(s, empty) for s in range(subsets)]).reshape(subsets, 2 + width)
    sizes, ones = table[:, 0], table[:, 1]
    means = table[:, 2:] / np.maximum(sizes, 1)[:, None]

    def squares(batches):
        for x, _, members in _blocks(batches, width, subsets):
            for s in range(subsets):
                yield s, ((x[members[:, s]] - means[s]) ** 2).sum(axis=0)

    apart = _added(blocks, squares, subsets) if found else [np.zeros(width)] * subsets
    deviations = np.sqrt(np.array(apart).reshape(subsets, width) / np.maximum(sizes - 1, 1)[:, None])
    means, deviations = np.where(scaled, means, 0.0), np.where(scaled, deviations, 1.0)
    return sizes, ones, means, deviations


def _derivatives(width, means, deviations, weighing, state, moving) -> Callable:
    """Loss, weight, gradient and Hessian of every moving model at its present point."""
    subsets = len(means)
    of_subset: dict[int, list[tuple[int, int]]] = {}
    for slot, (s, j) in enumerate(moving):
        of_subset.setdefault(s, []).append((slot, j))

    def measure(batches):
        for x, y, members in _blocks(batches, width, subsets):
            for s, models in of_subset.items():
                at = members[:, s]
                z = np.column_stack([_scaled(x[at], means[s], deviations[s]), np.ones(at.sum())])
                label = y[at]
                for slot, j in models:
                    margin = z @ state[s, j]
                    w = weighing[s, j][label.astype(int)]
                    chance = _chance(margin)
                    loss = (w * (np.logaddexp(0.0, margin) - label * margin)).sum()
                    gradient = z.T @ (w * (chance - label))
                    hessian = (z * (w * chance * (1 - chance))[:, None]).T @ z
                    yield slot, np.concatenate([[loss, w.sum()], gradient, hessian.ravel()])

    return measure
