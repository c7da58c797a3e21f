"""Learners recover a planted effect; artifacts, tuning and jobs run end to end."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from nudgelab.operators import importance as I
from nudgelab.operators import learners as M
from nudgelab.operators import ranking as R
from nudgelab.operators import split
from nudgelab.plans import modelling as jobs
from nudgelab.session import cut_lineage
from nudgelab.sources import artifacts

FEATURES = ("age", "total_transactions", "first_transaction_quarter", "gender")


@pytest.fixture(scope="module")
def planted(spark):
    """Treatment helps the young and does nothing for the old."""
    rng, rows = random.Random(11), []
    for i in range(3000):
        age, t = rng.uniform(18, 80), rng.randrange(2)
        p = 0.35 + (0.45 if t and age < 50 else 0.0)
        rows.append((i, age, rng.randrange(30), rng.choice(["2018Q1", "2018Q2"]),
                     rng.choice("MFU"), t, int(rng.random() < p)))
    schema = ("client_id long, age double, total_transactions long, "
              "first_transaction_quarter string, gender string, treatment_flg int, target int")
    return cut_lineage(spark.createDataFrame(rows, schema))


def young_minus_old(scored):
    row = scored.agg(
        F.avg(F.when(F.col("age") < 45, F.col("uplift"))).alias("young"),
        F.avg(F.when(F.col("age") > 55, F.col("uplift"))).alias("old"),
    ).first()
    return row["young"] - row["old"]


@pytest.mark.parametrize("kind", ["t", "s", "x"])
def test_planted_effect(planted, kind):
    learner = {
        "t": lambda: M.t_learner(planted),
        "s": lambda: M.s_learner(planted, maxIter=15, maxDepth=4),
        "x": lambda: M.x_learner(planted, maxIter=8, maxDepth=3),
    }[kind]()
    scored = learner.fit(planted).transform(planted)
    assert set(planted.columns) <= set(scored.columns)
    assert young_minus_old(scored) > 0.15
    assert R.gain_areas(scored).first()["auuc"] > 0.05


@pytest.mark.parametrize("make", [M.s_learner, M.baseline_learner])
def test_stopping_keeps_the_best_rounds(planted, make):
    marked = planted.withColumn(M.VALIDATION, F.col("client_id") % 5 == 0)
    learner = make(marked, validate=True, maxIter=40, maxDepth=3)
    model = learner.fit(marked)
    trees = model.parts["response"].stages[-1].getNumTrees
    scored = model.transform(marked)
    assert scored.select("uplift").distinct().count() > 1
    if make is M.s_learner:  # without the arm one tree says all there is
        assert 1 < trees <= 40 and young_minus_old(scored) > 0.15


def test_many_levels_fit(spark, planted):
    wide = planted.withColumn(
        "first_transaction_quarter", F.concat(F.lit("q"), (F.col("client_id") % 150).cast("string"))
    )
    assert M.x_learner(wide, maxIter=1, maxDepth=2).fit(wide).parts["effect_0"] is not None


def test_gender_stays_out_by_default(planted):
    assert "gender" not in M.t_learner(planted).estimator.texts
    assert "gender" in M.t_learner(planted, with_gender=True).estimator.texts


def test_unseen_level_is_all_zeros(spark, planted):
    model = M.t_learner(planted).fit(planted)
    odd = planted.limit(4).withColumn(
        "first_transaction_quarter",
        F.when(F.col("client_id") % 2 == 0, F.lit("1999Q1")),
    )
    for part in model.parts.values():
        for row in part.transform(odd).select("first_transaction_quarter_levels").collect():
            assert row[0].numNonzeros() == 0


def test_save_and_load(spark, planted, tmp_path):
    model = M.t_learner(planted).fit(planted)
    artifacts.save_learner(model, str(tmp_path / "m"), FEATURES)
    again, features = artifacts.load_learner(spark, str(tmp_path / "m"))
    assert features == list(FEATURES)
    before = {r[0]: r[1] for r in model.transform(planted).select("client_id", "uplift").collect()}
    after = {r[0]: r[1] for r in again.transform(planted).select("client_id", "uplift").collect()}
    assert before == after


def test_importance(spark, planted):
    t_model = M.t_learner(planted).fit(planted)
    gap = I.coefficient_gap(spark, t_model).collect()
    assert gap[0]["feature"] == "age" and gap[0]["gap"] < 0
    base = M.baseline_learner(planted, maxIter=5).fit(planted)
    table = I.importance_table(spark, {"t_learner": t_model, "baseline": base})
    sums = table.agg(F.sum("t_learner"), F.sum("baseline")).first()
    assert tuple(sums) == pytest.approx((1.0, 1.0))
    assert I.top_importance(table, 2, "mean_importance").count() == 2


def test_x_learner_default_propensity(planted):
    numbers, texts = M.split_kinds(planted)
    learner = M.XLearner(
        M.RidgeLogistic(numbers, texts),
        M.boosted_regressor(numbers, texts, maxIter=3, maxBins=64),
        numbers=numbers,
        texts=texts,
    )
    scored = learner.fit(planted).transform(planted)
    assert young_minus_old(scored) > 0.05
    assert abs(scored.agg(F.avg("propensity")).first()[0] - 0.5) < 0.05


def test_search_records_failures(planted):
    study = jobs.Study()

    def fails():
        planted.select(F.expr("no_such_column")).count()
        return 1.0

    study.run("broken", {}, fails)
    study.run("fine", {"a": 1}, lambda: 0.2)
    assert study.best().family == "fine" and study.trials[0].auuc == 0.0
    assert "no_such_column" in study.trials[0].error


@pytest.mark.parametrize(
    "name", ["t_learner", "model_comparison", "propensity", "importance_t", "score_batch"]
)
def test_model_queries_give_finite_numbers(spark, folder, name):
    df = registry.queries()[name](spark, folder)
    rows = df.collect()
    assert rows
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    assert all(r[c] is None or math.isfinite(r[c]) for r in rows for c in doubles)


def test_whole_searches_draw_every_family_and_trial(planted, monkeypatch):
    """Without the tree fits: what is drawn, measured and kept."""
    monkeypatch.setattr(jobs, "cross_validated_auuc", lambda folded, base, folds: 0.25)
    monkeypatch.setattr(jobs, "_validated_auuc", lambda train, held, params: params["stepSize"])
    study = jobs.tune_t_learner(planted)
    assert sorted(t.family for t in study.trials) == sorted([*jobs.FAMILIES] * 10)
    assert len({str(t.params) for t in study.trials}) == 30
    assert {t.auuc for t in study.trials if t.family != "logreg"} == {0.25}
    assert all(0.05 < t.auuc < 1 for t in study.trials if t.family == "logreg")
    study = jobs.tune_x_learner(planted)
    assert len({str(t.params) for t in study.trials}) == 80
    assert study.best().auuc == max(t.params["stepSize"] for t in study.trials)


def test_trials_fitted_together_measure_like_trials_of_their_own(planted, monkeypatch):
    monkeypatch.setattr(M, "LOGISTIC_TOLERANCE", 1e-12)
    folded = split.assign_folds(planted.where("client_id < 900"), 3, seed=1)
    folded = cut_lineage(folded)
    numbers, texts = M.split_kinds(folded, with_gender=False)
    drawn = [{"c": 0.01, "balanced": False}, {"c": 5.0, "balanced": True}]
    together = jobs.grid_auuc(folded, numbers, texts, drawn, 3)
    for params, area in zip(drawn, together, strict=True):
        base = jobs.FAMILIES["logreg"].build(numbers, texts, params)
        assert area == pytest.approx(jobs.cross_validated_auuc(folded, base, 3), abs=1e-6)


def test_final_fit_after_a_search(planted):
    study = jobs.tune_x_learner(planted, trials=2, overrides={"maxIter": 4, "maxDepth": 3})
    row = jobs.refit_x_learner(planted, study).first()
    assert row["validation_auuc"] == study.best().auuc and row["auuc"] > 0.05
