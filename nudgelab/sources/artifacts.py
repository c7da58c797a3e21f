"""Saving and loading fitted learners: one folder per part and a row of metadata."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from nudgelab.operators.age import AgeImputerModel
from nudgelab.operators.learners import MODEL_KINDS, EffectModel

METADATA = "kind string, parts array<string>, features array<string>"


def save_learner(
    model: EffectModel, path: str, features: Sequence[str], ages: AgeImputerModel | None = None
) -> None:
    """Write the learner, its feature names and the age statistics it was trained with."""
    spark = SparkSession.active()
    for name, part in model.parts.items():
        part.write().overwrite().save(posixpath.join(path, "parts", name))
    if ages is not None:
        ages.write().overwrite().save(posixpath.join(path, "ages"))
    row = [(model.kind, list(model.parts), list(features))]
    spark.createDataFrame(row, METADATA).coalesce(1).write.mode("overwrite").json(
        posixpath.join(path, "metadata")
    )


def load_learner(spark: SparkSession, path: str) -> tuple[EffectModel, list[str]]:
    """Read a learner and its feature names."""
    row = spark.read.schema(METADATA).json(posixpath.join(path, "metadata")).first()
    parts = {n: PipelineModel.load(posixpath.join(path, "parts", n)) for n in row["parts"]}
    return MODEL_KINDS[row["kind"]](**parts), list(row["features"])


def load_ages(path: str) -> AgeImputerModel:
    """Read the age statistics saved with a learner."""
    return AgeImputerModel.load(posixpath.join(path, "ages"))
