"""Column profiles of any frame, one pass per kind of statistic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nudgelab.functions.scalars import column, text_columns
from nudgelab.operators.levels import bounded_levels
from nudgelab.operators.quantiles import column_quantiles

PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)
LOW_CARDINALITY = 100


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, deviation, extrema and nine exact percentiles per column."""
    entries = []
    for c in columns:
        v = column(c).cast("double")
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).alias("n"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            )
        )
    moments = df.agg(F.array(*entries).alias("e")).select(F.inline("e"))
    quantiles = column_quantiles(df, columns, {f"p{p}": p / 100 for p in PERCENTILES})
    return moments.join(F.broadcast(quantiles), "column", "left")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) over all listed columns, nulls included, as text."""
    as_text = df.select(*(column(c).cast("string").alias(c) for c in columns))
    return (
        as_text.unpivot([], [column(c) for c in columns], "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def profile_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value (smallest on a tie) and its count."""
    known = value_counts(df, columns).where("value IS NOT NULL")
    top = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value")))
    return (
        known.groupBy("column")
        .agg(F.sum("n").alias("n"), F.count("*").alias("unique"), top.alias("top"))
        .select(
            "column",
            "n",
            "unique",
            F.col("top.value").alias("top"),
            (-F.col("top.rank")).alias("freq"),
        )
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Null count per column, and the total under ``(all)``."""
    names = df.columns
    row = df.agg(
        *(
            F.coalesce(F.sum(F.isnull(column(c)).cast("bigint")), F.lit(0)).alias(f"n_{i}")
            for i, c in enumerate(names)
        )
    )
    total = sum((F.col(f"n_{i}") for i in range(len(names))), F.lit(0))
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"n_{i}").alias("nulls"))
        for i, c in enumerate(names)
    ]
    entries.append(F.struct(F.lit("(all)").alias("column"), total.alias("nulls")))
    return row.select(F.inline(F.array(*entries)))


def profile_distinct(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values per column and whether the column counts as categorical.

    Text below 100 distinct values is categorical, and so is a number whose
    values are all 0 or 1.
    """
    names = list(columns) if columns is not None else df.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = set(text_columns(df))
    numbers = {c for c in names if isinstance(kinds[c], T.NumericType)}
    counted = (
        value_counts(df, names)
        .where("value IS NOT NULL")
        .groupBy("column")
        .agg(
            F.count("*").alias("distinct_values"),
            F.max(F.when(F.col("value").try_cast("double").isin(0.0, 1.0), 0).otherwise(1)).alias(
                "beyond_binary"
            ),
        )
    )
    is_text = F.col("column").isin(*sorted(texts & set(names))) if texts else F.lit(False)
    is_number = F.col("column").isin(*sorted(numbers)) if numbers else F.lit(False)
    categorical = (is_text & (F.col("distinct_values") < LOW_CARDINALITY)) | (
        is_number & (F.col("beyond_binary") == 0) & (F.col("distinct_values") <= 2)
    )
    return counted.select(
        "column", "distinct_values", categorical.cast("int").alias("is_categorical")
    )


def categorical_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """The columns that ``profile_distinct`` counts as categorical, in their order.

    Nothing is counted beyond the limit: text columns by bounded sets, numbers by whether a value
    other than 0 and 1 occurs. A column without values is not categorical.
    """
    names = list(columns) if columns is not None else df.columns
    texts = [c for c in text_columns(df) if c in names]
    found = {c for c, levels in bounded_levels(df, texts, LOW_CARDINALITY).items() if levels}
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name in names]
    if numbers:
        binary = df.agg(*[
            F.every(column(c).cast("double").isin(0.0, 1.0)).alias(f"c{i}") for i, c in enumerate(numbers)
        ]).first()
        found |= {c for c, is_binary in zip(numbers, binary, strict=True) if is_binary}
    return [c for c in names if c in found]


def histogram(
    df: DataFrame, value: str, bins: int, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Equal-width bins, empty ones included; the last bin includes its right edge.

    Without borders the observed minimum and maximum are used.
    """
    v = F.col(value)
    if low is None or high is None:
        borders = df.agg(F.min(v).alias("low"), F.max(v).alias("high"))
    else:
        borders = df.sparkSession.range(1).select(
            F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high")
        )
    width = (F.col("high") - F.col("low")) / bins
    place = F.when(
        F.col("high") > F.col("low"),
        F.least(F.floor((v - F.col("low")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)),
    ).otherwise(F.lit(0))
    counts = (
        df.where(v.isNotNull())
        .join(F.broadcast(borders))
        .where(v.between(F.col("low"), F.col("high")))
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    edges = borders.select(
        "low", width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("left_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def score_summary(df: DataFrame, value: str) -> DataFrame:
    """Row count and min / max / mean of a score."""
    return df.agg(
        F.count(value).alias("n"),
        F.min(value).alias("min_score"),
        F.max(value).alias("max_score"),
        F.avg(value).alias("mean_score"),
    )


def confusion_matrix(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Per class: predicted and true counts, precision, recall, F1, support."""
    predicted = (F.col(score) > threshold).cast("int")
    cells = df.agg(
        *(
            F.count_if((F.col(label) == actual) & (predicted == guess)).alias(f"c{actual}{guess}")
            for actual in (0, 1)
            for guess in (0, 1)
        )
    )

    def line(c: int) -> Column:
        hit, missed, false = F.col(f"c{c}{c}"), F.col(f"c{c}{1 - c}"), F.col(f"c{1 - c}{c}")

        def ratio(a: Column, b: Column) -> Column:
            return F.when(b > 0, a / b).otherwise(F.lit(0.0))

        return F.struct(
            F.lit(c).alias("class"),
            F.col(f"c{c}0").alias("predicted_0"),
            F.col(f"c{c}1").alias("predicted_1"),
            ratio(hit, hit + false).alias("precision"),
            ratio(hit, hit + missed).alias("recall"),
            ratio(2 * hit, 2 * hit + false + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    return cells.select(F.inline(F.array(line(0), line(1))))


def classification_report(
    df: DataFrame, score: str, label: str, threshold: float = 0.5
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages."""
    classes = confusion_matrix(df, score, label, threshold)
    measures = ("precision", "recall", "f1")
    n = F.sum("support")
    hits = F.sum(F.when(F.col("class") == 0, F.col("predicted_0")).otherwise(F.col("predicted_1")))
    nothing = F.lit(None).cast("double")
    lines = {
        "accuracy": (nothing, nothing, hits / n),
        "macro avg": tuple(F.avg(m) for m in measures),
        "weighted avg": tuple(F.sum(F.col(m) * F.col("support")) / n for m in measures),
    }
    entries = [
        F.struct(
            F.lit(name).alias("line"),
            *(v.alias(m) for v, m in zip(values, measures, strict=True)),
            n.alias("support"),
        )
        for name, values in lines.items()
    ]
    overall = classes.agg(F.array(*entries).alias("e")).select(F.inline("e"))
    per_class = classes.select(F.col("class").cast("string").alias("line"), *measures, "support")
    return per_class.unionByName(overall)
