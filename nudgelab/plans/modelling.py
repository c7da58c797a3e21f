"""Training, comparing, tuning and applying effect learners."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nudgelab.operators import clean as C
from nudgelab.operators import learners as M
from nudgelab.operators import logistic_grid as grid
from nudgelab.operators import ranking as R
from nudgelab.operators import split
from nudgelab.operators.age import AgeImputer, AgeImputerModel
from nudgelab.plans import features as P
from nudgelab.session import materialize
from nudgelab.sources import artifacts


def training_frame(clients: DataFrame, campaign: DataFrame, purchases: DataFrame) -> DataFrame:
    """The labelled feature frame, null-free and materialised for iterative fits."""
    return materialize(P.client_features(clients, campaign, purchases, na_fill=0.0))


def with_parts(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """70 / 30 holdout; a fifth of the training rows is marked for early stopping."""
    parted = split.holdout_split(frame)
    train = parted.where("part = 'train'").drop("part")
    marked = split.stratified_assign(
        train, P.KEY, P.LABELS, {"stop": 0.2, "fit": 0.8}, seed=7, out="role"
    )
    train = marked.withColumn(M.VALIDATION, F.col("role") == "stop").drop("role")
    return train, parted.where("part = 'test'").drop("part")


# --- propensity ------------------------------------------------------------------------


def propensity_scores(frame: DataFrame, features: Sequence[str] = P.AUDIT_FEATURES) -> DataFrame:
    """Probability of treatment from a logistic model (all columns scaled, none centred)."""
    filled = frame.fillna(0.0)
    numbers, texts = M.split_kinds(filled, features)
    model = M.RidgeLogistic(
        numbers, texts, label=P.ARM, c=1.0, center=False, scale_levels=True
    ).fit(filled)
    scored = M.add_probability(model, filled, M.SCORE)
    return scored.select(P.KEY, M.SCORE, *P.LABELS)


def propensity_check(frame: DataFrame) -> DataFrame:
    """One row: AUC of the propensity and its Qini; both say nothing if the arms are random."""
    scored = materialize(propensity_scores(frame))
    auc = R.roc_auc(scored, M.SCORE, P.ARM)
    return auc.join(F.broadcast(R.gain_areas(scored).select("qini")))


# --- comparison ------------------------------------------------------------------------


@dataclass
class Comparison:
    """Fitted learners, their scores on the test rows, and the metric table."""

    models: dict[str, M.EffectModel]
    scored: DataFrame
    metrics: DataFrame


def score_all(models: dict[str, M.EffectModel], rows: DataFrame) -> DataFrame:
    """One narrow table (client, model, score, labels), materialised once for all metrics."""
    tables = [M.scored_columns(m.transform(rows), name) for name, m in models.items()]
    return materialize(reduce(DataFrame.unionByName, tables))


def learners(fit_rows: DataFrame, trees: int | None = None) -> dict[str, Estimator]:
    """The four learners for a training frame of :func:`with_parts`.

    ``trees`` overrides the number of boosting rounds of every tree model.
    """
    rounds = {} if trees is None else {"maxIter": trees}
    return {
        "t_learner": M.t_learner(fit_rows),
        "s_learner": M.s_learner(fit_rows, validate=True, **rounds),
        "x_learner": M.x_learner(fit_rows, **rounds),
        "baseline": M.baseline_learner(fit_rows, validate=True, **rounds),
    }


def compared(models: dict[str, M.EffectModel], test: DataFrame) -> Comparison:
    """Fitted learners side by side on the test rows."""
    scored = score_all(models, test)
    return Comparison(models, scored, R.metric_table(scored, ["model"]))


def compare_learners(frame: DataFrame, trees: int | None = None) -> Comparison:
    """Fit the four learners on the training part and compare them on the rest."""
    train, test = with_parts(frame)
    fit_rows = materialize(train)
    estimators = learners(fit_rows, trees)
    fitted = M.side_by_side([partial(e.fit, fit_rows) for e in estimators.values()])
    return compared(dict(zip(estimators, fitted, strict=True)), test)


# --- tuning ----------------------------------------------------------------------------

Draw = Callable[[random.Random], dict]
Build = Callable[[list[str], list[str], dict], Estimator]


def _log_uniform(rng: random.Random, low: float, high: float) -> float:
    return math.exp(rng.uniform(math.log(low), math.log(high)))


@dataclass
class Family:
    """A base classifier and the space its settings are drawn from."""

    draw: Draw
    build: Build


def _build_logistic(numbers: list[str], texts: list[str], p: dict) -> Estimator:
    return M.RidgeLogistic(numbers, texts, c=p["c"], balanced=p["balanced"])


def _build_forest(numbers: list[str], texts: list[str], p: dict) -> Estimator:
    return M.forest_classifier(numbers, texts, seed=42, **p)


def _build_boosted(numbers: list[str], texts: list[str], p: dict) -> Estimator:
    return M.boosted_classifier(numbers, texts, seed=42, **p)


# The ranges of the reference search.
FAMILIES: dict[str, Family] = {
    "logreg": Family(
        lambda rng: {"c": _log_uniform(rng, 1e-3, 1e2), "balanced": rng.random() < 0.5},
        _build_logistic,
    ),
    "forest": Family(
        lambda rng: {
            "numTrees": rng.randrange(100, 601, 100),
            "maxDepth": rng.randint(3, 20),
            "minInstancesPerNode": rng.randint(1, 20),
        },
        _build_forest,
    ),
    "boosted": Family(
        lambda rng: {
            "maxIter": rng.randrange(150, 701, 50),
            "maxDepth": rng.randint(3, 10),
            "stepSize": _log_uniform(rng, 0.01, 0.3),
            "subsamplingRate": rng.uniform(0.5, 1.0),
            "featureSubsetStrategy": f"{rng.uniform(0.5, 1.0):.6f}",
        },
        _build_boosted,
    ),
}


@dataclass
class Trial:
    """One drawn setting and its AUUC; a failed fit counts as 0 and keeps its message."""

    family: str
    params: dict
    auuc: float
    error: str | None = None


def _tried(family: str, params: dict, measure: Callable[[], float]) -> Trial:
    try:
        return Trial(family, params, measure())
    except (PySparkException, Py4JError) as error:
        return Trial(family, params, 0.0, str(error))


@dataclass
class Study:
    """All trials of a search."""

    trials: list[Trial] = field(default_factory=list)

    def run(self, family: str, params: dict, measure: Callable[[], float]) -> None:
        """Record one trial."""
        self.trials.append(_tried(family, params, measure))

    def run_all(self, drawn: Sequence[tuple[str, dict, Callable[[], float]]]) -> None:
        """Record trials in the order they were drawn; they run side by side."""
        if drawn:
            self.trials.extend(M.side_by_side([partial(_tried, *trial) for trial in drawn]))

    def best(self, family: str | None = None) -> Trial:
        """The trial with the largest AUUC (of one family)."""
        pool = [t for t in self.trials if family in (None, t.family)]
        return max(pool, key=lambda t: t.auuc)

    def families(self) -> list[str]:
        """Searched families, in order."""
        return list(dict.fromkeys(t.family for t in self.trials))

    def table(self, spark: SparkSession) -> DataFrame:
        """Trials, best first."""
        rows = [(t.family, str(sorted(t.params.items())), t.auuc) for t in self.trials]
        return spark.createDataFrame(rows, "family string, params string, auuc double").orderBy(
            F.col("auuc").desc()
        )


def cross_validated_auuc(folded: DataFrame, base: Estimator, folds: int) -> float:
    """Mean AUUC of a two-model learner over the folds, scored in one metric pass."""
    parts = []
    for i in range(folds):
        model = M.TLearner(base).fit(folded.where(F.col("fold") != i).drop("fold"))
        parts.append(M.scored_columns(model.transform(folded.where(F.col("fold") == i)), str(i)))
    areas = R.gain_areas(reduce(DataFrame.unionByName, parts), ["model"])
    return float(areas.agg(F.avg("auuc").alias("auuc")).first()["auuc"])


def grid_auuc(
    folded: DataFrame, numbers: list[str], texts: list[str], drawn: Sequence[dict], folds: int
) -> list[float]:
    """Mean AUUC over the folds of two logistic models, for all settings at once.

    All folds, arms and settings advance in the same passes, and one pass scores every row with the
    models of the folds that it was not in.
    """
    design = grid.Design.of(folded, numbers, texts)
    subsets = {
        f"{fold}/{arm}": (F.col("fold") != fold) & (F.col(P.ARM) == arm)
        for fold in range(folds) for arm in (0, 1)
    }
    settings = [grid.Setting(p["c"], p["balanced"]) for p in drawn]
    model = grid.fit_grid(folded, design, P.RESPONSE, subsets, settings)
    own = 2 * F.col("fold").cast("int")
    scored = grid.scored_by(folded, model, [P.KEY, "fold", *P.LABELS], own + 1, own)
    named = scored.select(
        P.KEY, F.concat_ws("/", "setting", "fold").alias("model"), F.col("score").alias(M.SCORE), *P.LABELS
    )
    areas = R.gain_areas(materialize(named), ["model"])
    setting = F.split_part("model", F.lit("/"), F.lit(1)).cast("int")
    means = {
        r["setting"]: r["auuc"]
        for r in areas.groupBy(setting.alias("setting")).agg(F.avg("auuc").alias("auuc")).collect()
    }
    return [float(means.get(j) or 0.0) for j in range(len(drawn))]


def tune_t_learner(
    train: DataFrame,
    families: Sequence[str] = tuple(FAMILIES),
    trials: int = 10,
    folds: int = 3,
    seed: int = 42,
    overrides: dict | None = None,
) -> Study:
    """Random search per family by mean cross-validated AUUC.

    The logistic trials are fitted together; the others run side by side on the same folds, each
    fit distributed. ``overrides`` pins settings of the tree families.
    """
    rng, study = random.Random(seed), Study()
    folded = materialize(split.assign_folds(train, folds, seed=seed))
    numbers, texts = M.split_kinds(folded, with_gender=False)
    for name in families:
        drawn = []
        for _ in range(trials):
            params = FAMILIES[name].draw(rng)
            drawn.append(params | {k: v for k, v in (overrides or {}).items() if k in params})
        if name == "logreg":
            areas = grid_auuc(folded, numbers, texts, drawn, folds)
            study.trials += [Trial(name, p, a) for p, a in zip(drawn, areas, strict=True)]
            continue
        bases = [FAMILIES[name].build(numbers, texts, p) for p in drawn]
        study.run_all([
            (name, p, partial(cross_validated_auuc, folded, base, folds))
            for p, base in zip(drawn, bases, strict=True)
        ])
    return study


def tune_x_learner(
    frame: DataFrame, trials: int = 80, seed: int = 42, overrides: dict | None = None
) -> Study:
    """Random search of the tree settings on the 60 / 20 / 20 validation part."""
    rng, study = random.Random(seed), Study()
    parted = materialize(split.three_way_split(frame))
    train = parted.where("part = 'train'").drop("part")
    held = parted.where("part = 'validation'").drop("part")
    drawn = []
    for _ in range(trials):
        params = {
            "maxIter": rng.randint(100, 400),
            "maxDepth": rng.randint(4, 7),
            "stepSize": rng.uniform(0.03, 0.2),
        } | (overrides or {})
        drawn.append(("x_learner", params, partial(_validated_auuc, train, held, params)))
    study.run_all(drawn)
    return study


def _validated_auuc(train: DataFrame, held: DataFrame, params: dict) -> float:
    model = M.x_learner(train, **params).fit(train)
    return M.AUUCEvaluator().evaluate(M.scored_columns(model.transform(held), "x_learner"))


def refit_x_learner(frame: DataFrame, study: Study) -> DataFrame:
    """One row: the best setting fitted on train and validation part, AUUC and Qini on the test part."""
    parted = materialize(split.three_way_split(frame))
    learned = parted.where("part <> 'test'").drop("part")
    model = M.x_learner(learned, **study.best().params).fit(learned)
    scored = materialize(M.scored_columns(model.transform(parted.where("part = 'test'")), "x_learner"))
    validated = F.lit(study.best().auuc).alias("validation_auuc")
    return R.gain_areas(scored, ["model"]).select("model", validated, "auuc", "qini")


def refit_best(train: DataFrame, test: DataFrame, study: Study) -> DataFrame:
    """Best setting of each family fitted on all training rows: test metrics, best first."""
    numbers, texts = M.split_kinds(train, with_gender=False)
    models = {
        name: M.TLearner(FAMILIES[name].build(numbers, texts, study.best(name).params)).fit(train)
        for name in study.families()
    }
    rows = [(name, study.best(name).auuc) for name in models]
    validated = train.sparkSession.createDataFrame(rows, "model string, cv_auuc double")
    metrics = R.metric_table(score_all(models, test), ["model"])
    return metrics.join(F.broadcast(validated), "model").orderBy(F.col("auuc").desc())


# --- jobs ------------------------------------------------------------------------------


def train_job(
    clients: DataFrame, campaign: DataFrame, purchases: DataFrame, path: str
) -> M.EffectModel:
    """Fit the two-model learner on every labelled client and save it with its statistics."""
    frame = training_frame(clients, campaign, purchases)
    ages = AgeImputer().fit(C.labelled_clients(clients, campaign))
    model = M.t_learner(frame).fit(frame)
    artifacts.save_learner(model, path, P.MODEL_FEATURES, ages)
    return model


def score_clients(
    clients: DataFrame, purchases: DataFrame, model: M.EffectModel, ages: AgeImputerModel
) -> DataFrame:
    """Score all submitted clients in one job: (client_id, uplift)."""
    statistics = ages.as_frame(clients.sparkSession)
    frame = P.scoring_features(clients, purchases, statistics)
    return model.transform(frame).select(P.KEY, M.SCORE)
