"""Age imputation: statistics fitted on training clients, applied anywhere."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

YOUNGEST, OLDEST, OLDEST_KNOWN = 15, 100, 200
STATISTICS = (
    "age_q1",
    "age_q2",
    "age_q3",
    "mean_low",
    "mean_mid_low",
    "mean_mid_high",
    "mean_high",
    "mean_all",
)


def age_stats(clients: DataFrame, column: str = "age") -> DataFrame:
    """One row: quartiles of the valid ages and the mean of each quartile band.

    Valid ages are whole years 15..100, so everything after the first
    aggregate works on at most 86 rows.
    """
    valid = clients.where(F.col(column).between(YOUNGEST, OLDEST))
    histogram = valid.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    # One row: the quartiles next to the whole (short) histogram.
    summary = histogram.agg(
        F.percentile("v", [0.25, 0.5, 0.75], F.col("n")).alias("q"),
        F.collect_list(F.struct("v", "n")).alias("h"),
    )
    rows = summary.select(
        *(F.col("q")[i].alias(f"age_q{i + 1}") for i in range(3)), F.inline_outer("h")
    )
    v, n = F.col("v"), F.col("n")

    def band_mean(condition: Column) -> Column:
        return F.sum(F.when(condition, v * n)) / F.sum(F.when(condition, n))

    bands = {
        "mean_low": v <= F.col("age_q1"),
        "mean_mid_low": (v > F.col("age_q1")) & (v <= F.col("age_q2")),
        "mean_mid_high": (v > F.col("age_q2")) & (v <= F.col("age_q3")),
        "mean_high": v > F.col("age_q3"),
        "mean_all": F.lit(True),
    }
    return rows.agg(
        *(F.first(f"age_q{i}").alias(f"age_q{i}") for i in (1, 2, 3)),
        *(band_mean(cond).cast("double").alias(name) for name, cond in bands.items()),
    )


def imputed_age(age: Column, low: Column, high: Column, overall: Column) -> Column:
    """Keep 15..100; below 15 take the low band's mean, 100..200 the high band's."""
    return (
        F.when(age.between(YOUNGEST, OLDEST), age.cast("double"))
        .when(age < YOUNGEST, low)
        .when((age > OLDEST) & (age <= OLDEST_KNOWN), high)
        .otherwise(overall)
    )


def impute_age(clients: DataFrame, stats: DataFrame, column: str = "age") -> DataFrame:
    """Apply a one-row statistics frame, without leaving the plan."""
    row = stats.select("mean_low", "mean_high", "mean_all")
    fixed = imputed_age(F.col(column), F.col("mean_low"), F.col("mean_high"), F.col("mean_all"))
    return clients.join(F.broadcast(row)).withColumn(column, fixed).drop(*row.columns)


class _AgeParams(Params):
    column = Param(Params._dummy(), "column", "age column", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(column="age")


class AgeImputer(Estimator, _AgeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the band means once, so scoring uses the training statistics."""

    def __init__(self, column: str = "age") -> None:
        super().__init__()
        self._set(column=column)

    def _fit(self, dataset: DataFrame) -> AgeImputerModel:
        name = self.getOrDefault("column")
        row = age_stats(dataset, name).first()
        if row["mean_all"] is None:
            raise ValueError("no valid age to fit on")
        # A single valid age leaves the upper band empty: use the overall mean there.
        values = [row[s] if row[s] is not None else row["mean_all"] for s in STATISTICS]
        return AgeImputerModel(column=name, statistics=[float(v) for v in values])


class AgeImputerModel(Model, _AgeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted band means."""

    statistics = Param(
        Params._dummy(), "statistics", "values of STATISTICS", TypeConverters.toListFloat
    )

    def __init__(self, column: str = "age", statistics: list[float] | None = None) -> None:
        super().__init__()
        self._set(column=column)
        if statistics is not None:
            self._set(statistics=statistics)

    def as_frame(self, spark: SparkSession) -> DataFrame:
        """The statistics as one row, in the shape of ``age_stats``."""
        schema = ", ".join(f"{s} double" for s in STATISTICS)
        return spark.createDataFrame([tuple(self.getOrDefault("statistics"))], schema)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = self.getOrDefault("column")
        known = dict(zip(STATISTICS, self.getOrDefault("statistics"), strict=True))
        fixed = imputed_age(
            F.col(name),
            F.lit(known["mean_low"]),
            F.lit(known["mean_high"]),
            F.lit(known["mean_all"]),
        )
        return dataset.withColumn(name, fixed)
