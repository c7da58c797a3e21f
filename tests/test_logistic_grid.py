"""Models of a grid against single fits."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from nudgelab.operators import learners as M
from nudgelab.operators import logistic_grid as grid


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(600, numPartitions=4).selectExpr(
        "id", "cast(id % 2 as int) arm", "cast(id % 3 as int) fold",
        "cast(hash(id, 1) % 1000 / 100D + id % 2 as double) a", "cast(hash(id, 2) % 1000 * 50D as double) b",
        "3D c", "case when id % 7 < 3 then 'x' when id % 7 < 6 then 'y' when id % 2 = 1 then 'only treated' end t",
    ).withColumn("y", F.expr("cast(a + b / 20000 + case t when 'x' then 1 else 0 end + hash(id, 3) % 8 > 1.2 as int)"))
    return made.cache()


SETTINGS = [
    grid.Setting(c, balanced) for c in (0.003, 0.05, 2.0, 80.0) for balanced in (False, True)
]


def subsets():
    return {
        f"{f}/{arm}": (F.col("fold") != f) & (F.col("arm") == arm) for f in (0, 1, 2) for arm in (0, 1)
    }


@pytest.fixture(scope="module")
def fitted(rows):
    design = grid.Design.of(rows, ["a", "b", "c"], ["t"])
    return grid.fit_grid(rows, design, "y", subsets(), SETTINGS)


def test_weights_equal_those_of_single_fits(rows, fitted, monkeypatch):
    """Every fold of both arms; the single fits run to the end, not to their usual tolerance."""
    monkeypatch.setattr(M, "LOGISTIC_TOLERANCE", 1e-13)
    assert fitted.passes < 15
    for name, condition in list(subsets().items())[:4]:
        for j, setting in enumerate(SETTINGS):
            if j % 3:
                continue
            single = M.RidgeLogistic(
                ["a", "b", "c"], ["t"], label="y", c=setting.c, balanced=setting.balanced
            ).fit(rows.where(condition))
            coefficients = single.stages[-1].coefficients.toArray()
            levels = [f"t={x}" for x in single.stages[0].labelsArray[0]]
            s = fitted.subsets.index(name)
            got = dict(zip(fitted.design.names, fitted.weights[s, j], strict=True))
            want = dict(zip(["a", "b", "c", *levels], coefficients, strict=True))
            assert got == pytest.approx(want | {k: 0.0 for k in got.keys() - want.keys()}, abs=1e-6)
            assert fitted.intercepts[s, j] == pytest.approx(single.stages[-1].intercept, abs=1e-6)


def test_one_job_a_pass(rows, monkeypatch):
    """The passes do not grow with the number of models."""
    design = grid.Design.of(rows, ["a", "b", "c"], ["t"])
    calls = []
    real = grid._added
    monkeypatch.setattr(grid, "_added", lambda *a: calls.append(1) or real(*a))
    few = grid.fit_grid(rows, design, "y", {"all": F.lit(True)}, SETTINGS[:1])
    single, calls[:] = len(calls), []
    many = grid.fit_grid(rows, design, "y", subsets(), SETTINGS)
    assert single == few.passes + 2 and len(calls) == many.passes + 2 and len(calls) < single + 6


def test_scores_are_differences_of_the_models(rows, fitted):
    scored = grid.scored_by(rows, fitted, ["id", "fold"], 2 * F.col("fold") + 1, 2 * F.col("fold"))
    got = {(r["id"], r["setting"]): r["score"] for r in scored.collect()}
    assert len(got) == 600 * len(SETTINGS)
    treated = {f: rows.where((F.col("fold") != f) & (F.col("arm") == 1)) for f in (0,)}
    r = rows.where("fold = 0").orderBy("id").first()
    x = np.array([[r["a"], r["b"], r["c"], *[float(r["t"] == v) for v in fitted.design.levels[0][1]]]])
    want = fitted.probabilities(x, 1) - fitted.probabilities(x, 0)
    assert [got[r["id"], j] for j in range(len(SETTINGS))] == pytest.approx(want[0].tolist())
    assert treated[0].count() > 0


def test_subsets_without_both_labels(rows):
    design = grid.Design.of(rows, ["a"], [])
    parts = {"none": F.lit(False), "ones": F.col("y") == 1, "zeros": F.col("y") == 0, "null": F.lit(None).cast("boolean")}
    got = grid.fit_grid(rows, design, "y", parts, SETTINGS[:2])
    assert (got.weights == 0).all()
    assert got.probabilities(np.zeros((1, 1)), 0).tolist() == [[0.5, 0.5]]
    assert got.probabilities(np.zeros((1, 1)), 1).tolist() == [[1.0, 1.0]]
    assert got.probabilities(np.zeros((1, 1)), 2).tolist() == [[0.0, 0.0]]
    empty = grid.fit_grid(rows.where("false"), design, "y", {"all": F.lit(True)}, SETTINGS[:1])
    assert empty.intercepts.tolist() == [[0.0]]
