"""Predicted effect by client segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nudgelab.operators.quantiles import exact_quantiles
from nudgelab.session import cut_lineage

PERCENTAGE = "uplift_percentage"


def with_percentage(clients: DataFrame, scores: DataFrame, key: str = "client_id") -> DataFrame:
    """All client rows with the score in percent, null where there is none."""
    kind = scores.schema[key].dataType
    percent = scores.select(key, F.bround(F.col("uplift") * 100, 4).alias(PERCENTAGE))
    return clients.withColumn(key, F.col(key).cast(kind)).join(percent, key, "left")


def uplift_by_segment(
    clients: DataFrame, scores: DataFrame, by: Sequence[str], key: str = "client_id"
) -> DataFrame:
    """count, mean, median, deviation, min and max per segment; null segments are left out."""
    labelled = with_percentage(clients, scores, key).dropna(subset=list(by))
    merged = cut_lineage(labelled.select(*by, PERCENTAGE))
    v = F.col(PERCENTAGE)
    moments = merged.groupBy(*by).agg(
        F.count(v).alias("count"),
        F.bround(F.avg(v), 4).alias("mean"),
        F.bround(F.stddev_samp(v), 4).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    medians = exact_quantiles(merged, PERCENTAGE, {"median": 0.5}, by).withColumn(
        "median", F.bround("median", 4)
    )
    return moments.join(medians, list(by), "left")
