"""Strength of the link between features and a 0/1 response, and among features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nudgelab.functions.scalars import column, guarded_div, numeric_columns, text_columns
from nudgelab.operators.experiment import standardized_difference
from nudgelab.operators.gram import correlation, pair_sums
from nudgelab.operators.levels import DENSE_LEVELS, bounded_levels, pair_counts
from nudgelab.operators.ranking import roc_auc
from nudgelab.session import materialize

RARE_SHARE = 0.005
SUMMARY = ("kind", "score", "sign", "auc", "auc_norm", "smd", "smd_norm", "eta2", "combined")


def pearson(x: Column, y: Column) -> Column:
    """Correlation aggregate that is null, not an error, for a constant column."""
    spread = F.stddev_samp(x) * F.stddev_samp(y)
    return F.when(spread > 0, F.covar_samp(x, y) / spread)


def numeric_association(
    df: DataFrame, target: str, features: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Correlation, standardized difference and AUC of each numeric or 0/1 feature."""
    values = (
        df.select(*by, target, *(column(c).cast("double").alias(c) for c in features))
        .unpivot([*by, target], [column(c) for c in features], "feature", "value")
        .where("value IS NOT NULL")
    )
    x, y = F.col("value"), F.col(target)
    keys = [*by, "feature"]
    moments = values.groupBy(*keys).agg(
        pearson(x, y.cast("double")).alias("r"),
        F.avg(F.when(y == 0, x)).alias("m0"),
        F.avg(F.when(y == 1, x)).alias("m1"),
        F.var_samp(F.when(y == 0, x)).alias("v0"),
        F.var_samp(F.when(y == 1, x)).alias("v1"),
        F.max(F.when(x.isin(0.0, 1.0), 0).otherwise(1)).alias("beyond_binary"),
    )
    kind = F.when(F.col("beyond_binary") == 0, F.lit("binary")).otherwise(F.lit("numeric"))
    # A constant 0/1 column has phi 0; a constant number has no correlation.
    r = F.when(kind == "binary", F.coalesce("r", F.lit(0.0))).otherwise(F.col("r"))
    smd = standardized_difference(*(F.col(c) for c in ("m1", "m0", "v1", "v0")))
    return moments.join(roc_auc(values, "value", target, keys), keys).select(
        *keys,
        kind.alias("kind"),
        F.abs(r).alias("score"),
        r.alias("sign"),
        "auc",
        smd.alias("smd"),
        F.lit(None).cast("double").alias("eta2"),
    )


def categorical_association(
    df: DataFrame,
    target: str,
    features: Sequence[str],
    by: Sequence[str] = (),
    min_share: float = RARE_SHARE,
) -> DataFrame:
    """Share of response variance between levels, and AUC of the level means.

    Levels below ``min_share`` fold into ``RARE``, so at most 1/min_share + 2
    levels per feature are left after the second aggregate.
    """
    keys = [*by, "feature"]
    y = F.col(target)
    levels = (
        df.select(*by, target, *features)
        .unpivot([*by, target], list(features), "feature", "level")
        .groupBy(*keys, "level")
        .agg(F.count("*").alias("n"), F.sum(y).cast("bigint").alias("k"))
    )
    known = levels.groupBy(*keys).agg(
        F.sum(F.when(F.col("level").isNotNull(), F.col("n"))).alias("known")
    )
    rare = F.col("level").isNotNull() & (F.col("n") / F.col("known") < min_share)
    name = F.when(rare, F.lit("RARE")).otherwise(F.coalesce("level", F.lit("nan")))
    folded = (
        levels.join(F.broadcast(known), keys)
        .groupBy(*keys, name.alias("level"))
        .agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        .withColumn("rate", F.col("k") / F.col("n"))
    )
    # Levels with equal means tie, so the ranking works on distinct means.
    group = Window.partitionBy(*keys)
    above = group.orderBy(F.col("rate").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    tie = Window.partitionBy(*keys, "rate")
    ranked = folded.select(
        "*",
        F.sum("n").over(group).alias("n_all"),
        F.sum("k").over(group).alias("k_all"),
        F.sum("k").over(above).alias("k_run"),
        F.sum("k").over(tie).alias("k_tie"),
    )
    mu = F.col("k_all") / F.col("n_all")
    between = F.sum(F.col("n") * F.pow(F.col("rate") - mu, F.lit(2.0)))
    total = F.max(F.col("n_all") * mu * (1 - mu))
    pairs = F.max(F.col("k_all").cast("double") * (F.col("n_all") - F.col("k_all")))
    area = F.sum((F.col("n") - F.col("k")) * (F.col("k_run") - F.col("k_tie") / 2))
    summary = ranked.groupBy(*keys).agg(
        F.when(total > 0, between / total).alias("eta2"),
        F.when(pairs > 0, area / pairs).alias("auc"),
    )
    missing = F.lit(None).cast("double")
    return summary.select(
        *keys,
        F.lit("categorical").alias("kind"),
        F.col("eta2").alias("score"),
        missing.alias("sign"),
        "auc",
        missing.alias("smd"),
        "eta2",
    )


def _mean_of_known(*parts: Column) -> Column:
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0))
    known = sum((p.isNotNull().cast("int") for p in parts), F.lit(0))
    return F.when(known > 0, total / known)


def association(
    df: DataFrame,
    target: str,
    by: Sequence[str] = (),
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Ranked summary of every feature: one row per feature (and group).

    The frame is read a fixed number of times, so pass a materialised one.
    """
    skip = (target, *by, *exclude)
    rows = numeric_association(df, target, numeric_columns(df, skip), by)
    texts = text_columns(df, skip)
    if texts:
        rows = rows.unionByName(categorical_association(df, target, texts, by))
    scaled = rows.withColumns(
        {
            "auc_norm": F.abs(F.col("auc") - 0.5) * 2,
            "smd_norm": F.when(
                F.col("smd").isNotNull(), F.least(F.abs("smd") / 0.8, F.lit(1.0))
            ),
        }
    )
    combined = _mean_of_known(F.col("score"), F.col("auc_norm"), F.col("smd_norm"))
    return (
        scaled.withColumn("combined", combined)
        .select(*by, "feature", *SUMMARY)
        .orderBy(F.col("combined").desc_nulls_last(), *by, "feature")
    )


def association_by_arm(
    df: DataFrame, target: str, arm: str, exclude: Sequence[str] = ()
) -> DataFrame:
    """Combined strength in each arm and the change, for features that occur in both arms.

    The summary is evaluated once; its rows, one per feature and arm, are folded.
    """
    both = association(df, target, by=[arm], exclude=exclude)
    of = lambda i, c: F.max(F.when(F.col(arm) == i, F.col(c)))
    folded = both.groupBy("feature").agg(
        of(0, "kind").alias("kind"),
        of(0, "combined").alias("combined_t0"),
        of(1, "combined").alias("combined_t1"),
        F.countDistinct(arm).alias("arms"),
    )
    return folded.where("arms = 2").select(
        "feature", "kind", "combined_t0", "combined_t1",
        (F.col("combined_t1") - F.col("combined_t0")).alias("delta"),
    )


def strongest_changes(compared: DataFrame, k: int = 10) -> DataFrame:
    """The k largest and the k smallest changes between the arms; one row per feature is written."""
    compared = materialize(compared)
    rising = compared.orderBy(F.col("delta").desc(), "feature").limit(k)
    falling = compared.orderBy(F.col("delta").asc(), F.col("feature").desc()).limit(k)
    return rising.withColumn("side", F.lit("rising")).unionByName(
        falling.withColumn("side", F.lit("falling"))
    )


# --- feature against feature -----------------------------------------------------------


def correlation_pairs(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Pearson r of every pair i < j over rows where both are known; see :mod:`.gram`."""
    return _correlations(df, features).where("i < j").drop("i", "j")


def correlation_matrix(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """All ordered pairs, the diagonal included."""
    upper = _correlations(df, features)
    both = F.when(
        F.col("i") == F.col("j"), F.array(F.struct("feature_1", "feature_2"))
    ).otherwise(
        F.array(
            F.struct("feature_1", "feature_2"),
            F.struct(F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2")),
        )
    )
    return upper.select(F.inline(both), "corr")


def _correlations(df: DataFrame, features: Sequence[str] | None) -> DataFrame:
    names = list(features) if features is not None else numeric_columns(df)
    name = F.array(*(F.lit(c) for c in names))
    r = F.when((F.col("i") == F.col("j")) & correlation().isNotNull(), 1.0).otherwise(correlation())
    return pair_sums(df, names).select(
        "i", "j", F.get(name, F.col("i")).alias("feature_1"), F.get(name, F.col("j")).alias("feature_2"),
        r.alias("corr"),
    )


def strong_pairs(df: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Pairs beyond the threshold in size, largest first."""
    return (
        correlation_pairs(df)
        .where(F.abs("corr") > threshold)
        .orderBy(F.col("corr").desc(), "feature_1", "feature_2")
    )


def cramers_v(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Bias-corrected Cramer's V of every pair i <= j, over rows where both are known.

    Columns of up to ``DENSE_LEVELS`` levels are coded once and counted in dense arrays, one pass
    for all pairs; a pair with a longer column is counted by its own grouping.
    """
    names = list(features)
    levels = bounded_levels(df, names, DENSE_LEVELS + 1)
    dense = {c: v for c, v in levels.items() if v}
    pair = ["feature_1", "feature_2"]
    tables = [pair_counts(df, dense)] if dense else []
    for a, b in combinations_with_replacement(names, 2):
        if levels[a] is None or levels[b] is None:
            both = df.select(*(column(c).cast("string").alias(v) for c, v in ((a, "v1"), (b, "v2"))))
            counted = both.dropna().groupBy("v1", "v2").agg(F.count("*").alias("n"))
            tables.append(counted.select(F.lit(a).alias(pair[0]), F.lit(b).alias(pair[1]), "v1", "v2", "n"))
    if not tables:
        return df.sparkSession.createDataFrame([], "feature_1 string, feature_2 string, v_cramer double")
    cells = materialize(reduce(DataFrame.unionByName, tables))
    rows = cells.groupBy(*pair, "v1").agg(F.sum("n").alias("row_n"))
    columns = cells.groupBy(*pair, "v2").agg(F.sum("n").alias("column_n"))
    shape = (
        rows.groupBy(*pair)
        .agg(F.count("*").alias("r"), F.sum("row_n").alias("total"))
        .join(columns.groupBy(*pair).agg(F.count("*").alias("k")), pair)
    )
    # chi2 / n = sum(n_ij^2 / (row_i * column_j)) - 1
    fit = (
        cells.join(rows, [*pair, "v1"])
        .join(columns, [*pair, "v2"])
        .groupBy(*pair)
        .agg(
            (
                F.sum(F.col("n").cast("double") * F.col("n") / (F.col("row_n") * F.col("column_n")))
                - 1
            ).alias("phi2")
        )
    )
    r, k, n = F.col("r"), F.col("k"), F.col("total")
    excess = F.greatest(
        F.lit(0.0), F.col("phi2") - guarded_div(((k - 1) * (r - 1)).cast("double"), n - 1)
    )
    r_left = r - guarded_div(F.pow(r - 1, F.lit(2.0)), n - 1)
    k_left = k - guarded_div(F.pow(k - 1, F.lit(2.0)), n - 1)
    denominator = F.least(r_left, k_left) - 1
    return fit.join(shape, pair).select(
        *pair,
        F.when(denominator > 0, F.sqrt(excess / denominator)).alias("v_cramer"),
    )
