"""Audit of a randomized campaign: lift, significance, intervals, balance."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nudgelab.functions.scalars import guarded_div, numeric_columns, text_columns

ARM, RESPONSE = "treatment_flg", "target"
Z_95 = 1.959963984540054


def target_distribution(df: DataFrame, column: str = RESPONSE) -> DataFrame:
    """Count and percentage of each value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select(
        column, "n", (F.col("n") / F.col("total") * 100).alias("percent")
    )


def crosstab(df: DataFrame, rows: str = ARM, columns: str = RESPONSE) -> DataFrame:
    """Arm by response: counts and row percentages."""
    table = df.groupBy(rows).pivot(columns, [0, 1]).agg(F.count(F.lit(1)))
    n0, n1 = F.coalesce("0", F.lit(0)), F.coalesce("1", F.lit(0))
    return table.select(
        rows,
        n0.alias("n_0"),
        n1.alias("n_1"),
        (n0 / (n0 + n1) * 100).alias("percent_0"),
        (n1 / (n0 + n1) * 100).alias("percent_1"),
    )


def arm_summary(df: DataFrame) -> DataFrame:
    """One row: sizes, responses, conversions, absolute and relative lift."""
    t, y = F.col(ARM), F.col(RESPONSE)
    counts = df.agg(
        F.sum(1 - t).cast("bigint").alias("n_control"),
        F.sum(t).cast("bigint").alias("n_treated"),
        F.sum((1 - t) * y).cast("bigint").alias("y_control"),
        F.sum(t * y).cast("bigint").alias("y_treated"),
    )
    overall = (F.col("y_control") + F.col("y_treated")) / (F.col("n_control") + F.col("n_treated"))
    return counts.withColumns(
        {
            "conversion": overall,
            "conversion_control": guarded_div(F.col("y_control"), F.col("n_control")),
            "conversion_treated": guarded_div(F.col("y_treated"), F.col("n_treated")),
        }
    ).withColumns(
        {
            "lift": F.col("conversion_treated") - F.col("conversion_control"),
            "relative_lift": guarded_div(
                F.col("conversion_treated") - F.col("conversion_control"),
                F.col("conversion_control"),
            ),
        }
    )


def z_test(df: DataFrame) -> DataFrame:
    """Two-proportion z statistic with pooled variance."""
    n0, n1, p = F.col("n_control"), F.col("n_treated"), F.col("conversion")
    error = F.sqrt(p * (1 - p) * (1 / n0 + 1 / n1))
    return arm_summary(df).select(guarded_div(F.col("lift"), error).alias("z"))


def t_test(df: DataFrame) -> DataFrame:
    """Two-sample t statistic with equal variances, and its degrees of freedom."""
    n0, n1 = F.col("n_control"), F.col("n_treated")
    p0, p1 = F.col("conversion_control"), F.col("conversion_treated")
    freedom = n0 + n1 - 2
    # For a 0/1 response the squared deviations add up to n p (1 - p).
    pooled = (n0 * p0 * (1 - p0) + n1 * p1 * (1 - p1)) / freedom
    return arm_summary(df).select(
        guarded_div(p1 - p0, F.sqrt(pooled * (1 / n0 + 1 / n1))).alias("t"),
        freedom.alias("degrees_of_freedom"),
    )


def two_sided_p(z: float) -> float:
    """Two-sided normal tail of one statistic."""
    return math.erfc(abs(z) / math.sqrt(2.0))


def two_sided_t(t: float, freedom: float, steps: int = 300) -> float:
    """Two-sided tail of Student's t: the regularised incomplete beta I_x(freedom / 2, 1 / 2)."""
    a, b, x = freedom / 2, 0.5, freedom / (freedom + t * t)
    if x in (0.0, 1.0):
        return x
    if x >= (a + 1) / (a + b + 2):  # the fraction converges fast on the other side
        return 1.0 - _beta_fraction(b, a, 1 - x, steps)
    return _beta_fraction(a, b, x, steps)


def _beta_fraction(a: float, b: float, x: float, steps: int) -> float:
    """I_x(a, b) by its continued fraction, from the inside out."""
    value = 1.0
    for m in range(steps, 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        value = 1.0 + even / (1.0 + odd / value)
    first = -(a + b) * x / (a + 1)
    scale = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(scale + a * math.log(x) + b * math.log1p(-x)) / a
    return front / (1.0 + first / value)


def significance(df: DataFrame) -> dict[str, float]:
    """z, t and their p-values (normal and Student tails), from two one-row results."""
    z = z_test(df).first()["z"]
    row = t_test(df).first()
    return {
        "z": z, "p_z": two_sided_p(z), "t": row["t"],
        "p_t": two_sided_t(row["t"], row["degrees_of_freedom"]),
    }


def conversion_intervals(df: DataFrame, z: float = Z_95) -> DataFrame:
    """Normal interval of each arm's conversion and of their difference."""

    def variance(p: Column, n: Column) -> Column:
        return guarded_div(p * (1 - p), n)

    summary = arm_summary(df)
    v0 = variance(F.col("conversion_control"), F.col("n_control"))
    v1 = variance(F.col("conversion_treated"), F.col("n_treated"))
    lines = {
        "control": ("conversion_control", v0),
        "treated": ("conversion_treated", v1),
        "difference": ("lift", v0 + v1),
    }
    structs = [
        F.struct(
            F.lit(name).alias("quantity"),
            F.col(estimate).alias("estimate"),
            (F.col(estimate) - z * F.sqrt(v)).alias("low"),
            (F.col(estimate) + z * F.sqrt(v)).alias("high"),
        )
        for name, (estimate, v) in lines.items()
    ]
    return summary.select(F.inline(F.array(*structs)))


def standardized_difference(
    m1: Column, m0: Column, v1: Column, v0: Column
) -> Column:
    """(m1 - m0) / sqrt((v0 + v1) / 2); null when the pooled variance is 0."""
    pooled = F.sqrt((v0 + v1) / 2)
    return F.when(pooled > 0, (m1 - m0) / pooled)


def balance(df: DataFrame, arm: str = ARM, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Absolute standardized difference between the arms, per encoded feature.

    Numeric nulls count as 0; each level of a text column (null is ``nan``) is
    a 0/1 feature named ``column_level``.
    """
    skip = (arm, *exclude)
    numbers, texts = numeric_columns(df, skip), text_columns(df, skip)
    t = F.col(arm)
    values = df.select(
        arm, *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numbers)
    ).unpivot([arm], numbers, "feature", "value")
    x = F.col("value")
    numeric = values.groupBy("feature").agg(
        F.avg(F.when(t == 0, x)).alias("m0"),
        F.avg(F.when(t == 1, x)).alias("m1"),
        F.var_samp(F.when(t == 0, x)).alias("v0"),
        F.var_samp(F.when(t == 1, x)).alias("v1"),
    )
    rows = numeric
    if texts:
        levels = (
            df.select(arm, *(F.coalesce(c, F.lit("nan")).alias(c) for c in texts))
            .unpivot([arm], texts, "column", "level")
            .groupBy("column", "level")
            .agg(
                F.sum(1 - t).cast("bigint").alias("k0"),
                F.sum(t).cast("bigint").alias("k1"),
            )
        )
        sizes = df.agg(
            F.sum(1 - t).cast("bigint").alias("n0"), F.sum(t).cast("bigint").alias("n1")
        )

        def share(i: int) -> Column:
            return F.col(f"k{i}") / F.col(f"n{i}")

        def spread(i: int) -> Column:
            n = F.col(f"n{i}")
            return F.when(n > 1, share(i) * (1 - share(i)) * n / (n - 1))

        rows = rows.unionByName(
            levels.join(F.broadcast(sizes)).select(
                F.concat_ws("_", "column", "level").alias("feature"),
                share(0).alias("m0"),
                share(1).alias("m1"),
                spread(0).alias("v0"),
                spread(1).alias("v1"),
            )
        )
    smd = F.abs(standardized_difference(*(F.col(c) for c in ("m1", "m0", "v1", "v0"))))
    return rows.select(
        "feature",
        smd.alias("abs_smd"),
        F.when(smd > 0.2, F.lit("large"))
        .when(smd > 0.1, F.lit("moderate"))
        .otherwise(F.lit("balanced"))
        .alias("balance"),
    )
