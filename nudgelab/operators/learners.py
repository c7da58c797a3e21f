"""Effect learners on ``pyspark.ml``: two-model, single-model, cross-fitted, response only.

Fits are iterative, so pass a frame from ``materialize`` or a table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nudgelab.functions.scalars import numeric_columns
from nudgelab.operators import boosting, staged
from nudgelab.operators.ranking import gain_areas
from nudgelab.plans.features import ARM, KEY, LABELS, MODEL_FEATURES, RESPONSE
from nudgelab.session import materialize

SCORE = "uplift"
PSEUDO_EFFECT = "pseudo_effect"
VALIDATION = "is_validation"
WEIGHT = "class_weight"

# The tuned settings of the reference models, LOGISTIC_C to RESPONSE_TREES.
LOGISTIC_C = 0.027301853380688412
LOGISTIC_ITERATIONS = 2000
LOGISTIC_TOLERANCE = 1e-4
EFFECT_TREES = {"maxIter": 147, "stepSize": 0.03633155899517177, "maxDepth": 5, "seed": 42}
PROPENSITY_TREES = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 4, "seed": 42}
RESPONSE_TREES = {
    "maxIter": 1000,
    "stepSize": 0.111006,
    "maxDepth": 6,
    "subsamplingRate": 0.8,
    "maxBins": 254,
    "seed": 67,
}
#: Independent fits that run at the same time.
FITS_AT_ONCE = 4
#: Rows of a partition of a tree learner's input.
PARTITION_ROWS = 50_000


def split_kinds(
    df: DataFrame, features: Sequence[str] = MODEL_FEATURES, with_gender: bool = True
) -> tuple[list[str], list[str]]:
    """Numeric and text features present in the frame, in the given order."""
    numbers = set(numeric_columns(df))
    present = [f for f in features if f in df.columns and (with_gender or f != "gender")]
    return [f for f in present if f in numbers], [f for f in present if f not in numbers]


# --- building blocks -------------------------------------------------------------------


def linear_stages(
    numbers: Sequence[str], texts: Sequence[str], center: bool = True, scale_levels: bool = False
) -> list:
    """Scale numbers, one-hot text; an unseen or null level becomes all zeros.

    ``scale_levels`` scales the one-hot columns too.
    """
    stages: list = []
    if texts:
        stages += [
            StringIndexer(
                inputCols=list(texts),
                outputCols=[f"{t}_index" for t in texts],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=[f"{t}_index" for t in texts],
                outputCols=[f"{t}_levels" for t in texts],
                dropLast=True,
            ),
        ]
    levels = [f"{t}_levels" for t in texts]
    if scale_levels:
        return [
            *stages,
            VectorAssembler(inputCols=[*numbers, *levels], outputCol="numbers"),
            StandardScaler(inputCol="numbers", outputCol="features", withMean=center, withStd=True),
        ]
    return [
        *stages,
        VectorAssembler(inputCols=list(numbers), outputCol="numbers"),
        StandardScaler(
            inputCol="numbers", outputCol="scaled", withMean=center, withStd=True
        ),
        VectorAssembler(inputCols=["scaled", *levels], outputCol="features"),
    ]


def tree_stages(numbers: Sequence[str], texts: Sequence[str]) -> list:
    """Index text as categorical features; trees need no scaling."""
    stages: list = []
    if texts:
        stages.append(
            StringIndexer(
                inputCols=list(texts),
                outputCols=[f"{t}_index" for t in texts],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            )
        )
    inputs = [*numbers, *(f"{t}_index" for t in texts)]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


class RidgeLogistic(Estimator):
    """Logistic regression with the strength given as C, as ``1 / (C n)`` of the fitted rows."""

    def __init__(
        self,
        numbers: Sequence[str],
        texts: Sequence[str],
        label: str = RESPONSE,
        c: float = LOGISTIC_C,
        balanced: bool = False,
        center: bool = True,
        scale_levels: bool = False,
    ) -> None:
        super().__init__()
        self.scale_levels = scale_levels
        self.numbers, self.texts, self.label = list(numbers), list(texts), label
        self.c, self.balanced, self.center = c, balanced, center

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        counts = dataset.agg(
            F.count("*").alias("n"), F.sum(self.label).cast("double").alias("k")
        ).first()
        n, k = counts["n"], counts["k"]
        classifier = LogisticRegression(
            labelCol=self.label,
            regParam=1.0 / (self.c * n),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=LOGISTIC_ITERATIONS,
            tol=LOGISTIC_TOLERANCE,
        )
        if self.balanced:
            positive = F.col(self.label) == 1
            weight = F.when(positive, n / (2.0 * k)).otherwise(n / (2.0 * (n - k)))
            dataset = dataset.withColumn(WEIGHT, weight)
            classifier = classifier.setWeightCol(WEIGHT)
        stages = linear_stages(self.numbers, self.texts, self.center, self.scale_levels)
        return Pipeline(stages=[*stages, classifier]).fit(dataset)


class TreeLearner(Estimator):
    """Trees over indexed features; ``maxBins`` grows with the levels of the text features.

    The indexed rows are written once, in partitions of ``PARTITION_ROWS``, since a forest reads them
    again for every level, as do boosted trees on more rows than one task takes; on fewer they are
    grown in one job (``operators/boosting.py``). With ``validated`` (boosted trees only) the rows
    marked ``is_validation`` take no part in the fit: all ``maxIter`` rounds are grown once, and the
    model keeps the rounds with the largest ROC area on those rows, which one job measures along with
    growing them, or ``operators/staged.py`` after it. ``needs`` names a number that at least one of the kept trees
    must split on; if no tree does, all rounds stay.
    """

    def __init__(
        self, kind: type, numbers: Sequence[str], texts: Sequence[str], label: str,
        validated: bool = False, needs: str | None = None, **params,
    ) -> None:
        super().__init__()
        self.kind, self.label, self.settings = kind, label, dict(params)
        self.numbers, self.texts = list(numbers), list(texts)
        self.validated, self.needs = validated, needs

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        learned = dataset.where(~F.col(VALIDATION)) if self.validated else dataset
        prepared = Pipeline(stages=tree_stages(self.numbers, self.texts)).fit(learned)
        levels = [len(x) for x in _levels(prepared)]
        bins = max(self.settings.get("maxBins", 64), max(levels, default=0) + 2)
        settings = self.settings | {"maxBins": bins}
        rows = _compact(prepared.transform(learned).select("features", self.label, *self.numbers))
        n_rows, unusable = self._counted(rows)
        small = boosting.fits_one_task(n_rows, len(self.numbers) + len(self.texts))
        held = prepared.transform(dataset.where(F.col(VALIDATION))) if self.validated else None
        if self.kind in BOOSTED and small and n_rows and not unusable:  # MLlib names what is unusable
            # An unseen or null level is one more.
            categories = {t: n + 1 for t, n in zip(self.texts, levels, strict=True)}
            grow = partial(
                boosting.save_boosted, rows, self.numbers, categories, self.label,
                self.kind is GBTClassifier, settings,
            )
            if held is None or self._rides_along(dataset.where(F.col(VALIDATION))):
                needs = None if self.needs is None else self.numbers.index(self.needs)
                path = grow(held if held is None else held.select("features", self.label), needs)
                return PipelineModel([*prepared.stages, BOOSTED[self.kind].load(path)])
            model, path = None, grow()
        else:
            model = self.kind(labelCol=self.label, **settings).fit(rows)
            path = staged.saved_copy(model) if self.validated else None
        best = None
        if self.validated:
            best = self._best_prefix(path, _compact(held.select("features", self.label)))
        if best is not None:
            model = staged.first_trees(path, best, BOOSTED[self.kind])
        elif model is None:
            model = BOOSTED[self.kind].load(path)
        return PipelineModel([*prepared.stages, model])

    def _rides_along(self, held: DataFrame) -> bool:
        """Whether the held-out rows are few and sound enough to be scored by the task that grows."""
        n_rows, unusable = self._counted(held)
        return self.kind is GBTClassifier and not unusable and boosting.fits_one_task(n_rows, len(self.numbers) + len(self.texts))

    def _counted(self, rows: DataFrame) -> tuple[int, int]:
        """Rows, and those with a number or label that no boosted tree can be fitted to."""
        label = F.col(self.label).cast("double")
        wrong = ~label.isin(0.0, 1.0) if self.kind is GBTClassifier else _not_finite(label)
        for name in self.numbers:
            wrong |= _not_finite(F.col(name).cast("double"))
        counts = rows.agg(F.count("*"), F.count_if(F.coalesce(wrong, F.lit(True)))).first()
        return counts[0], counts[1]

    def _best_prefix(self, path: str, held: DataFrame) -> int | None:
        """The rounds to keep of a stored model, None for all."""
        ensemble = staged.read_ensemble(path)
        least: int | None = 1
        if self.needs is not None:
            least = staged.first_split(ensemble, self.numbers.index(self.needs))
        if least is None:
            return None
        best = staged.best_rounds(ensemble, held, self.label, least)
        return None if best == ensemble.rounds else best


#: Estimators whose trees are grown in one job, and the models they give.
BOOSTED = {GBTClassifier: GBTClassificationModel, GBTRegressor: GBTRegressionModel}


def _not_finite(value: Column) -> Column:
    return value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))


def _levels(prepared: PipelineModel) -> list:
    return [x for s in prepared.stages if hasattr(s, "labelsArray") for x in s.labelsArray]


def _compact(rows: DataFrame) -> DataFrame:
    written = materialize(rows)
    return written.coalesce(max(1, -(-written.count() // PARTITION_ROWS)))


def boosted_classifier(
    numbers: Sequence[str], texts: Sequence[str], label: str = RESPONSE, **params
) -> TreeLearner:
    """Gradient-boosted trees for a 0/1 label."""
    return TreeLearner(GBTClassifier, numbers, texts, label, **params)


def boosted_regressor(
    numbers: Sequence[str], texts: Sequence[str], label: str = PSEUDO_EFFECT, **params
) -> TreeLearner:
    """Gradient-boosted trees for a real label."""
    return TreeLearner(GBTRegressor, numbers, texts, label, **params)


def forest_classifier(
    numbers: Sequence[str], texts: Sequence[str], label: str = RESPONSE, **params
) -> TreeLearner:
    """A random forest for a 0/1 label."""
    return TreeLearner(RandomForestClassifier, numbers, texts, label, **params)


def add_probability(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """Probability of 1 as column ``name``; the model's working columns are left out."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


def add_prediction(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """Real-valued prediction as column ``name``."""
    return model.transform(df).select(*df.columns, F.col("prediction").alias(name))


def side_by_side(fits: Sequence[Callable[[], Model]]) -> list[Model]:
    """Run independent fits at the same time, ``FITS_AT_ONCE`` at most.

    Boosting is a long row of small jobs, so one fit alone leaves most of the cores idle.
    """
    carry = inheritable_thread_target(SparkSession.active())
    with ThreadPool(min(FITS_AT_ONCE, len(fits))) as pool:
        return pool.map(lambda run: run(), [carry(f) for f in fits])


# --- learners --------------------------------------------------------------------------


class EffectModel(Model):
    """A fitted learner: named parts, and a score added by ``transform``."""

    kind = ""

    def __init__(self, **parts: PipelineModel) -> None:
        super().__init__()
        self.parts = parts


class TLearner(Estimator):
    """One response model per arm; the score is the difference of their probabilities."""

    def __init__(self, estimator: Estimator) -> None:
        super().__init__()
        self.estimator = estimator

    def _fit(self, dataset: DataFrame) -> TLearnerModel:
        arms = [dataset.where(F.col(ARM) == arm) for arm in (1, 0)]
        treated, control = side_by_side([partial(self.estimator.fit, rows) for rows in arms])
        return TLearnerModel(treated=treated, control=control)


class TLearnerModel(EffectModel):
    kind = "t_learner"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        both = add_probability(self.parts["treated"], dataset, "p_treated")
        both = add_probability(self.parts["control"], both, "p_control")
        return both.withColumn(SCORE, F.col("p_treated") - F.col("p_control"))


class SLearner(Estimator):
    """One response model with the arm as a feature."""

    def __init__(self, estimator: Estimator) -> None:
        super().__init__()
        self.estimator = estimator

    def _fit(self, dataset: DataFrame) -> SLearnerModel:
        return SLearnerModel(response=self.estimator.fit(dataset))


class SLearnerModel(EffectModel):
    kind = "s_learner"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = self.parts["response"]
        columns = [c for c in dataset.columns if c != ARM]
        observed = [F.col("_observed").alias(ARM)] if ARM in dataset.columns else []
        rows = dataset.withColumnRenamed(ARM, "_observed")
        both = add_probability(model, rows.withColumn(ARM, F.lit(1)), "p_treated")
        both = add_probability(model, both.withColumn(ARM, F.lit(0)), "p_control")
        return both.select(
            *columns,
            *observed,
            "p_treated",
            "p_control",
            (F.col("p_treated") - F.col("p_control")).alias(SCORE),
        )


class XLearner(Estimator):
    """Response per arm, pseudo-effects, effect per arm, blended by the propensity.

    Without a propensity estimator a plain logistic regression is used.
    """

    def __init__(
        self,
        outcome: Estimator,
        effect: Estimator,
        propensity: Estimator | None = None,
        numbers: Sequence[str] = (),
        texts: Sequence[str] = (),
    ) -> None:
        super().__init__()
        self.outcome, self.effect = outcome, effect
        self.propensity = propensity or RidgeLogistic(numbers, texts, label=ARM, c=1.0)

    def _fit(self, dataset: DataFrame) -> XLearnerModel:
        control, treated = (dataset.where(F.col(ARM) == arm) for arm in (0, 1))
        response_0, response_1, propensity = side_by_side(
            [
                partial(self.outcome.fit, control),
                partial(self.outcome.fit, treated),
                partial(self.propensity.fit, dataset),
            ]
        )
        y = F.col(RESPONSE)
        effect_0 = add_probability(response_1, control, "p").withColumn(
            PSEUDO_EFFECT, F.col("p") - y
        )
        effect_1 = add_probability(response_0, treated, "p").withColumn(
            PSEUDO_EFFECT, y - F.col("p")
        )
        effects = side_by_side([partial(self.effect.fit, rows) for rows in (effect_0, effect_1)])
        return XLearnerModel(
            response_0=response_0,
            response_1=response_1,
            effect_0=effects[0],
            effect_1=effects[1],
            propensity=propensity,
        )


class XLearnerModel(EffectModel):
    kind = "x_learner"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = add_prediction(self.parts["effect_0"], dataset, "effect_0")
        scored = add_prediction(self.parts["effect_1"], scored, "effect_1")
        scored = add_probability(self.parts["propensity"], scored, "propensity")
        g = F.col("propensity")
        return scored.withColumn(SCORE, g * F.col("effect_0") + (1 - g) * F.col("effect_1"))


class ResponseLearner(Estimator):
    """Baseline: the response probability itself, arm left out, is the score."""

    def __init__(self, estimator: Estimator) -> None:
        super().__init__()
        self.estimator = estimator

    def _fit(self, dataset: DataFrame) -> ResponseModel:
        return ResponseModel(response=self.estimator.fit(dataset))


class ResponseModel(EffectModel):
    kind = "baseline"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_probability(self.parts["response"], dataset, SCORE)


MODEL_KINDS = {m.kind: m for m in (TLearnerModel, SLearnerModel, XLearnerModel, ResponseModel)}


# --- ready-made learners ---------------------------------------------------------------


def t_learner(df: DataFrame, with_gender: bool = False) -> TLearner:
    """Two logistic models; gender stays out unless asked for."""
    return TLearner(RidgeLogistic(*split_kinds(df, with_gender=with_gender)))


def s_learner(df: DataFrame, validate: bool = False, **overrides) -> SLearner:
    """Boosted trees with the arm as a feature; ``validate`` keeps the best rounds on ``is_validation``.

    The kept rounds hold a split on the arm: without one every score would be the same, which on
    few rows the response area alone may well prefer.
    """
    numbers, texts = split_kinds(df)
    params = RESPONSE_TREES | {"validated": validate, "needs": ARM} | overrides
    return SLearner(boosted_classifier([*numbers, ARM], texts, **params))


def baseline_learner(df: DataFrame, validate: bool = False, **overrides) -> ResponseLearner:
    """Boosted trees on the response, without the arm."""
    params = RESPONSE_TREES | {"validated": validate} | overrides
    return ResponseLearner(boosted_classifier(*split_kinds(df), **params))


def x_learner(df: DataFrame, **overrides) -> XLearner:
    """Boosted trees for responses, effects and propensity."""
    numbers, texts = split_kinds(df)
    trees = EFFECT_TREES | overrides
    propensity = dict(PROPENSITY_TREES)
    propensity |= {k: v for k, v in overrides.items() if k == "maxIter"}
    return XLearner(
        outcome=boosted_classifier(numbers, texts, **trees),
        effect=boosted_regressor(numbers, texts, **trees),
        propensity=boosted_classifier(numbers, texts, label=ARM, **propensity),
    )


def scored_columns(scored: DataFrame, model: str) -> DataFrame:
    """The narrow scored table every metric reads."""
    return scored.select(
        KEY, F.lit(model).alias("model"), F.col(SCORE).cast("double").alias(SCORE), *LABELS
    )


class AUUCEvaluator(Evaluator):
    """Normalised area under the uplift curve, for tuning."""

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(gain_areas(dataset).first()["auuc"])

    def isLargerBetter(self) -> bool:
        return True
