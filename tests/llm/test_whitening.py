"""Whitened coordinates against numpy on whole tables and odd vectors."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from nudgelab.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, block int, x string, whitened double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 0.0) for i, v in rows], SCHEMA)


def plain(vectors):
    """Integer vectors, covariance, whitened coordinates and exact deviations."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:8]
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return values[order], centred @ vectors[:, order] / np.sqrt(values[order]), exact, values.sum()


def check(rows, ids, vectors):
    values, coordinates, exact, trace = plain(vectors)
    width = len(values)
    assert len(rows) == len(ids) * width
    for j in range(width):
        mine = {r.vec_id: r for r in rows if r.component == j + 1}
        got = np.array([mine[i].whitened for i in ids])
        sign = np.sign(got @ coordinates[:, j])
        assert np.abs(got * sign - coordinates[:, j]).max() < 1e-8
        assert [int(mine[i].deviation) for i in ids] == exact
        assert all(abs(r.explained - values[j] / trace) < 1e-9 for r in mine.values())
        assert {r.n for r in mine.values()} == {len(ids)}
        assert all(r.identity_error < 1e-9 for r in mine.values())


@pytest.mark.parametrize("block_bytes", [8_000_000, 20_000])
def test_same_coordinates_as_numpy(spark, folder, block_bytes):
    """Also in blocks so small that many partitions hold several, some of them short."""
    table = spark.read.parquet(f"{folder}/embeddings.parquet").repartition(3)
    rows = whitening.whitened(table, block_bytes=block_bytes).collect()
    given = table.collect()
    check(rows, [r.vec_id for r in given], [r.embedding for r in given])


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in rng.normal(0, 0.3, 3)]) for i in range(40)]
    bad = [
        (100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, []),
        (104, [float("inf"), 0.0, 0.0]), (105, [float("-inf"), 0.0, 0.0]), (106, [0.5, 0.5]),
        (107, [3e38, 0.0, 0.0]),
    ]
    rows = whitening.whitened(frame(spark, good + bad), block_bytes=24 * 7).collect()
    check(rows, [i for i, _ in good], [v for _, v in good])


def test_repeated_and_missing_ids_all_count(spark):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [1.0, 0.25]), (2, [0.5, -1.0])]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert len(got) == 8 and {r.n for r in got} == {4}
    assert sorted((r.vec_id or 0) for r in got) == [0, 0, 1, 1, 1, 1, 2, 2]


def test_directions_without_variance_have_no_coordinate(spark):
    rows = [(i, [float(i), 7.0]) for i in range(5)]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert all(r.whitened is not None for r in got if r.component == 1)
    assert all(r.whitened is None and abs(r.explained) < 1e-12 for r in got if r.component == 2)
    assert all(r.identity_error < 1e-12 for r in got)
    same = whitening.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert all(r.whitened is None and r.explained is None and r.deviation == 0 for r in same)


def test_empty_table_gives_no_rows(spark):
    out = whitening.whitened(frame(spark, []))
    assert out.collect() == []
    assert out.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]
    assert whitening.whitened(frame(spark, [(1, None)])).collect() == []


def test_deviation_is_exact_beyond_longs(spark):
    values = [[1e9, -1e9], [1e12, 5.0], [-3e12, 0.5]]
    got = whitening.whitened(frame(spark, list(enumerate(values)))).collect()
    _, _, exact, _ = plain(values)
    assert {r.vec_id: int(r.deviation) for r in got} == dict(enumerate(exact))
    assert max(exact) > 1 << 63 and all(Fraction(x).denominator == 1 for x in exact)
