"""Trees grown in one job against MLlib's."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from nudgelab.operators import boosting
from nudgelab.operators import learners as M
from nudgelab.operators import staged

NUMBERS, TEXTS = ["a", "b", "flat"], ["t"]
TREES = {"maxIter": 6, "maxDepth": 4, "stepSize": 0.3, "maxBins": 64, "seed": 5}


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(1500, numPartitions=4).selectExpr(
        "id", "cast(pmod(hash(id, 1), 40) as double) a", "cast(pmod(hash(id, 2), 7) as double) b", "0D flat",
        "concat('q', pmod(hash(id, 3), 9)) t",
        "cast(hash(id, 1) % 1000 / 500D + if(pmod(hash(id, 3), 9) in (2, 5, 7), 0.6, -0.3) "
        "+ hash(id, 4) % 100 / 70D > 0 as int) y", "hash(id, 1) % 40 / 9D + pmod(hash(id, 3), 9) z",
    )
    return made.cache()


def predicted(model, rows):
    return [r[0] for r in model.transform(rows).orderBy("id").select("prediction").collect()]


@pytest.mark.parametrize("kind, label", [(GBTClassifier, "y"), (GBTRegressor, "z")])
def test_same_model_as_mllib(rows, kind, label):
    """All rows, a bin for every value: nothing is left to chance."""
    ours = M.TreeLearner(kind, NUMBERS, TEXTS, label, **TREES).fit(rows)
    theirs = kind(labelCol=label, **TREES).fit(M.PipelineModel(ours.stages[:-1]).transform(rows))
    assert type(ours.stages[-1]) is type(theirs)
    assert ours.stages[-1].getNumTrees == 6 and ours.stages[-1].treeWeights == theirs.treeWeights
    want = predicted(theirs, M.PipelineModel(ours.stages[:-1]).transform(rows))
    assert predicted(ours, rows) == pytest.approx(want)
    assert ours.stages[-1].featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())


def test_more_rows_than_a_task_takes_are_mllib_s(rows, monkeypatch):
    one = M.TreeLearner(GBTRegressor, NUMBERS, TEXTS, "z", **TREES).fit(rows)
    monkeypatch.setattr(boosting, "TASK_BYTES", 1499 * 4 * 8)
    monkeypatch.setattr(boosting, "save_boosted", None)
    spread = M.TreeLearner(GBTRegressor, NUMBERS, TEXTS, "z", **TREES).fit(rows)
    assert predicted(spread, rows) == pytest.approx(predicted(one, rows))


def test_more_rounds_are_no_more_jobs(spark, rows):
    """Each round used to start a job for every level."""
    jobs = []
    for rounds in (2, 40):
        spark.sparkContext.setJobGroup(f"rounds-{rounds}", "fit")
        M.TreeLearner(GBTClassifier, NUMBERS, TEXTS, "y", **TREES | {"maxIter": rounds}).fit(rows)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{rounds}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 0


def test_chance_of_rows_and_features(rows):
    some = TREES | {"subsamplingRate": 0.5, "featureSubsetStrategy": "0.500000", "maxIter": 20}
    model = M.TreeLearner(GBTClassifier, NUMBERS, TEXTS, "y", **some).fit(rows)
    right = model.transform(rows).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert right > 0.6
    root = boosting.Plan([], [3] * 8, 1, 1, 0.1, 1.0, 0.5, 1, True)
    grower = boosting.Grower(root, boosting.np.zeros((8, 1), dtype="uint16"))
    allowed = grower._allowed(50, boosting.np.random.default_rng(3))
    assert (allowed.sum(axis=1) == 4).all() and len({a.tobytes() for a in allowed}) > 1


@pytest.mark.parametrize("odd", ["if(id = 3, null, y)", "if(id = 3, 2, y)"])
def test_odd_labels_raise_as_in_mllib(rows, odd):
    with pytest.raises(Exception, match="(?i)label"):
        M.TreeLearner(GBTClassifier, NUMBERS, TEXTS, "y", **TREES).fit(rows.withColumn("y", F.expr(odd)))


@pytest.fixture(scope="module")
def marked(rows):
    return rows.withColumn(M.VALIDATION, F.expr("pmod(hash(id, 8), 4) = 0"))


@pytest.mark.parametrize("needs", [None, "b", "flat"])
def test_kept_rounds_have_the_largest_area(marked, needs):
    """The task that grows the trees and the pass over a stored model choose alike; ``flat`` is never split on."""
    settings = TREES | {"maxIter": 30, "subsamplingRate": 0.8}
    kept = M.TreeLearner(GBTClassifier, NUMBERS, TEXTS, "y", True, needs, **settings).fit(marked)
    whole = M.TreeLearner(GBTClassifier, NUMBERS, TEXTS, "y", **settings).fit(marked.where(~F.col(M.VALIDATION)))
    path = staged.saved_copy(whole.stages[-1])
    ensemble = staged.read_ensemble(path)
    held = M.PipelineModel(whole.stages[:-1]).transform(marked.where(M.VALIDATION))
    least = 1 if needs is None else staged.first_split(ensemble, NUMBERS.index(needs))
    want = 30 if least is None else staged.best_rounds(ensemble, held, "y", least)
    trees = kept.stages[-1]
    assert trees.getNumTrees == want and trees.treeWeights == whole.stages[-1].treeWeights[:want]
    assert needs == "flat" or want < 30
    prefix = staged.first_trees(path, want, type(trees))
    assert predicted(kept, marked) == predicted(M.PipelineModel([*kept.stages[:-1], prefix]), marked)


def test_areas_need_no_pass_over_the_stored_trees(marked, monkeypatch):
    """All trees used to be stored, read by the driver, walked twice and cut by another job."""
    for name in ("read_ensemble", "area_bounds", "exact_areas", "first_trees"):
        monkeypatch.setattr(staged, name, None)
    model = M.TreeLearner(GBTClassifier, NUMBERS, TEXTS, "y", True, **TREES).fit(marked)
    assert 1 <= model.stages[-1].getNumTrees <= 6


def test_held_rows_beyond_a_task_are_scored_from_the_stored_trees(marked, monkeypatch):
    learner = M.TreeLearner(GBTClassifier, NUMBERS, TEXTS, "y", True, **TREES)
    together = learner.fit(marked)
    monkeypatch.setattr(M.TreeLearner, "_rides_along", lambda self, held: False)
    apart = learner.fit(marked)
    assert apart.stages[-1].getNumTrees == together.stages[-1].getNumTrees
    assert predicted(apart, marked) == predicted(together, marked)


@pytest.mark.parametrize("ones", ["0", "1", "id % 2"])
def test_areas_of_one_label_or_no_rows(rows, ones):
    """Without both labels among the held-out rows all prefixes are alike, and one tree stays."""
    held = F.lit(False) if ones == "id % 2" else F.expr(f"id % 5 = 0 and y = {ones}")
    model = M.TreeLearner(GBTClassifier, NUMBERS, TEXTS, "y", True, **TREES).fit(rows.withColumn(M.VALIDATION, held))
    assert model.stages[-1].getNumTrees == 1


def test_exact_area_counts_ties_half():
    margin, label = np.array([0.3, 0.1, 0.3, 0.2, 0.1, 0.3]), np.array([1.0, 0, 0, 1, 1, 1])
    pairs = [(m > n) + (m == n) / 2 for m in margin[label == 1] for n in margin[label == 0]]
    assert staged.exact_area(margin, label) == np.mean(pairs)
    assert staged.exact_area(np.empty(0), np.empty(0)) == 0.5
