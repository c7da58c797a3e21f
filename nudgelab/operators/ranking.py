"""Effect-ranking metrics over a scored table (score, arm, response).

Metrics that ignore the order inside a tie work on one row per distinct score;
the others use a global row number with the client id as tie key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nudgelab.functions.scalars import guarded_div
from nudgelab.operators.prefix import running_totals
from nudgelab.session import cut_lineage

SCORE, ARM, RESPONSE, KEY = "uplift", "treatment_flg", "target", "client_id"
COUNTS = ("n_t", "n_c", "y_t", "y_c")
TOP_SHARES = (0.1, 0.2, 0.3, 0.5)
ONE_GROUP = "_one_group"


def _tallies(arm: Column, response: Column) -> list[Column]:
    """Treated / control rows and their responses, as sums."""
    parts = (arm, 1 - arm, arm * response, (1 - arm) * response)
    return [F.sum(p).cast("bigint").alias(n) for p, n in zip(parts, COUNTS, strict=True)]


def _with_group(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if by:
        return df, list(by)
    return df.withColumn(ONE_GROUP, F.lit(0)), [ONE_GROUP]


# --- distinct-score grain --------------------------------------------------------------


def score_points(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Running tallies at each distinct score, best first, next to group totals."""
    groups = scored.groupBy(*by, SCORE).agg(*_tallies(F.col(ARM), F.col(RESPONSE)))
    return running_totals(groups, [F.col(SCORE).desc()], COUNTS, by)


def uplift_value(n_t: Column, n_c: Column, y_t: Column, y_c: Column) -> Column:
    """Cumulative rate difference times rows so far (an empty arm counts as rate 0)."""
    return (guarded_div(y_t, n_t) - guarded_div(y_c, n_c)) * (n_t + n_c)


def qini_value(n_t: Column, n_c: Column, y_t: Column, y_c: Column) -> Column:
    """Incremental responses, control scaled to the treated count so far."""
    return y_t - y_c * guarded_div(n_t, n_c)


CURVES = {"auuc": uplift_value, "qini": qini_value}


def _areas(points: DataFrame, by: Sequence[str], names: dict[str, str]) -> DataFrame:
    """Trapezoid areas under the curves, from (0, 0), one row per group."""
    run = [F.col(f"{c}_run") for c in COUNTS]
    before = [F.col(f"{c}_run") - F.col(c) for c in COUNTS]
    width = F.col("n_t") + F.col("n_c")
    return points.groupBy(*by).agg(
        *(
            F.sum(width * (CURVES[curve](*run) + CURVES[curve](*before)) / 2).alias(alias)
            for curve, alias in names.items()
        ),
        # The last point of every curve: rows and responses per arm.
        *(F.max(f"{c}_run").alias(f"{c}_end") for c in COUNTS),
    )


def arm_totals(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and responses per arm: one row per group."""
    return scored.groupBy(*by).agg(*_tallies(F.col(ARM), F.col(RESPONSE)))


def perfect_points(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Running tallies of the ideal ranking of each metric (a few rows per group).

    The ideal score depends only on (arm, response), so the four cells of that
    table, given as arm totals, are all the data there is.
    """
    keyed, keys = _with_group(totals, by)
    cells = keyed.select(
        *keys,
        (F.col("y_c") > F.col("n_t") - F.col("y_t")).alias("response_first"),
        F.inline(
            F.expr(
                "array(named_struct('t', 1, 'y', 1, 'n', y_t),"
                " named_struct('t', 1, 'y', 0, 'n', n_t - y_t),"
                " named_struct('t', 0, 'y', 1, 'n', y_c),"
                " named_struct('t', 0, 'y', 0, 'n', n_c - y_c))"
            )
        ),
    ).where("n > 0")
    ideal = {
        "auuc": "2 * int(y = t) + CASE WHEN response_first THEN y ELSE t END",
        "qini": "y * t - y * (1 - t)",
    }
    scores = ", ".join(
        f"named_struct('curve', '{c}', 'score', {sql})" for c, sql in ideal.items()
    )
    ranked = cells.select(*keys, "t", "y", "n", F.inline(F.expr(f"array({scores})")))
    t, y, n = F.col("t"), F.col("y"), F.col("n")
    groups = ranked.groupBy(*keys, "curve", "score").agg(
        F.sum(t * n).alias("n_t"),
        F.sum((1 - t) * n).alias("n_c"),
        F.sum(t * y * n).alias("y_t"),
        F.sum((1 - t) * y * n).alias("y_c"),
    )
    window = (
        Window.partitionBy(*keys, "curve")
        .orderBy(F.col("score").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return groups.withColumns({f"{c}_run": F.sum(c).over(window) for c in COUNTS}).drop(
        *([] if by else [ONE_GROUP])
    )


def gain_areas(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AUUC and Qini AUC: (area - random) / (perfect - random), one row per group.

    The scored table is read once; all else works on one row per group.
    """
    keyed, keys = _with_group(scored, by)
    measured = cut_lineage(
        _areas(score_points(keyed, keys), keys, {c: f"area_{c}" for c in CURVES})
    )
    ends = [F.col(f"{c}_end") for c in COUNTS]
    totals = measured.select(*keys, *(e.alias(c) for e, c in zip(ends, COUNTS, strict=True)))
    ideal = _areas(
        perfect_points(totals, keys), [*keys, "curve"], {c: f"perfect_{c}" for c in CURVES}
    )
    rows = measured.join(
        ideal.groupBy(*keys).agg(
            *(
                F.max(F.when(F.col("curve") == c, F.col(f"perfect_{c}"))).alias(f"perfect_{c}")
                for c in CURVES
            )
        ),
        keys,
    )

    def normalised(curve: str) -> Column:
        diagonal = (F.col("n_t_end") + F.col("n_c_end")) * CURVES[curve](*ends) / 2
        return guarded_div(
            F.col(f"area_{curve}") - diagonal, F.col(f"perfect_{curve}") - diagonal
        ).alias(curve)

    return rows.select(*by, *(normalised(c) for c in CURVES))


def perfect_curve(scored: DataFrame) -> DataFrame:
    """Points of the ideal curves and the end of the random line, per curve."""
    run = [F.col(f"{c}_run") for c in COUNTS]
    value = F.when(F.col("curve") == "auuc", uplift_value(*run)).otherwise(qini_value(*run))
    totals = cut_lineage(arm_totals(scored))
    perfect = perfect_points(totals).select(
        "curve",
        F.lit("perfect").alias("line"),
        (F.col("n_t_run") + F.col("n_c_run")).alias("n"),
        value.cast("double").alias("gain"),
    )
    counts = [F.col(c) for c in COUNTS]
    ends = [
        totals.select(
            F.lit(curve).alias("curve"),
            F.lit("random").alias("line"),
            (F.col("n_t") + F.col("n_c")).alias("n"),
            CURVES[curve](*counts).cast("double").alias("gain"),
        )
        for curve in CURVES
    ]
    return perfect.unionByName(ends[0]).unionByName(ends[1])


# --- row grain -------------------------------------------------------------------------


def rank_clients(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the global position of each client (best score first) and running tallies."""
    arm, response = F.col(ARM), F.col(RESPONSE)
    rows = scored.withColumns(
        {
            "n_t": arm.cast("bigint"),
            "n_c": (1 - arm).cast("bigint"),
            "y_t": (arm * response).cast("bigint"),
            "y_c": ((1 - arm) * response).cast("bigint"),
        }
    )
    ordered = running_totals(rows, [F.col(SCORE).desc(), F.col(KEY)], COUNTS, by)
    return ordered.withColumns(
        {
            "position": F.col("n_t_run") + F.col("n_c_run"),
            "n_rows": F.col("n_t_all") + F.col("n_c_all"),
        }
    )


def qini_curve(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One point per client: treated responses minus control responses at a global ratio."""
    ratio = guarded_div(F.col("n_t_all"), F.col("n_c_all"))
    return ranked.select(
        *by,
        "position",
        (F.col("position") / F.col("n_rows")).alias("fraction"),
        (F.col("y_t_run") - F.col("y_c_run") * ratio).alias("qini"),
    )


def uplift_curve(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One point per client: cumulative rate difference.

    Once both arms have been seen the difference stays defined, so the only gap
    is at the head; it takes the first defined value, or 0 if there is none.
    """
    defined = (F.col("n_t_run") > 0) & (F.col("n_c_run") > 0)
    difference = F.when(
        defined,
        guarded_div(F.col("y_t_run"), F.col("n_t_run"))
        - guarded_div(F.col("y_c_run"), F.col("n_c_run")),
    )
    points, keys = _with_group(ranked.withColumn("difference", difference), by)
    head = points.groupBy(*keys).agg(
        F.min_by("difference", F.when(defined, F.col("position"))).alias("head")
    )
    return points.join(F.broadcast(head), keys).select(
        *by,
        "position",
        (F.col("position") / F.col("n_rows")).alias("fraction"),
        F.coalesce("difference", "head", F.lit(0.0)).alias("uplift_curve"),
    )


def _arm_rate(condition: Column, arm: int) -> Column:
    return F.avg(F.when(condition & (F.col(ARM) == arm), F.col(RESPONSE)))


def uplift_at_k(
    ranked: DataFrame, shares: Sequence[float] = TOP_SHARES, by: Sequence[str] = ()
) -> DataFrame:
    """Response difference between the arms in the first ``int(N * k)`` clients."""
    picked = {k: F.col("position") <= F.floor(F.col("n_rows") * F.lit(float(k))) for k in shares}
    row = ranked.groupBy(*by).agg(
        *(
            (_arm_rate(top, 1) - _arm_rate(top, 0)).alias(f"uplift_at_{round(k * 100)}")
            for k, top in picked.items()
        )
    )
    return row


def equal_bin(position: Column, rows: Column, bins: int) -> Column:
    """Bin of a 1-based position; the first bins take the remainder (as ``ntile``)."""
    size = F.floor(rows / bins)
    large = rows % bins
    border = large * (size + 1)
    return (
        F.when(position <= border, F.floor((position - 1) / (size + 1)) + 1)
        .otherwise(large + F.floor((position - 1 - border) / F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def uplift_deciles(ranked: DataFrame, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Per equal-count bin: rows and response rate of each arm, and their difference."""
    binned = ranked.withColumn("bin", equal_bin(F.col("position"), F.col("n_rows"), bins))
    everything = F.lit(True)
    return binned.groupBy(*by, "bin").agg(
        F.sum("n_t").alias("n_treated"),
        F.sum("n_c").alias("n_control"),
        _arm_rate(everything, 1).alias("rate_treated"),
        _arm_rate(everything, 0).alias("rate_control"),
        (_arm_rate(everything, 1) - _arm_rate(everything, 0)).alias("bin_uplift"),
    )


def weighted_avg_uplift(ranked: DataFrame, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean bin uplift weighted by the bin's treated rows; null if a bin lacks an arm."""
    n, lacking = F.col("n_treated"), F.count_if(F.col("bin_uplift").isNull())
    mean = guarded_div(F.sum(F.col("bin_uplift") * n), F.sum(n))
    return (
        uplift_deciles(ranked, bins, by).groupBy(*by).agg(F.when(lacking == 0, mean).alias("wau"))
    )


def metric_table(scored: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """AUUC, Qini, weighted uplift and uplift at the top shares, one row per model."""
    ranked = rank_clients(scored, by)
    return (
        gain_areas(scored, by)
        .join(weighted_avg_uplift(ranked, by=by), list(by))
        .join(uplift_at_k(ranked, by=by), list(by))
    )


# --- response ranking ------------------------------------------------------------------


def roc_points(
    df: DataFrame, score: str, label: str, by: Sequence[str] = ()
) -> DataFrame:
    """Running positives and negatives at each distinct score, best first."""
    y = F.col(label)
    groups = df.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.sum(y).cast("bigint").alias("pos"), F.sum(1 - y).cast("bigint").alias("neg")
    )
    return running_totals(groups, [F.col("threshold").desc()], ["pos", "neg"], by)


def roc_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at every threshold."""
    return roc_points(df, score, label, by).select(
        *by,
        "threshold",
        guarded_div(F.col("neg_run"), F.col("neg_all")).alias("fpr"),
        guarded_div(F.col("pos_run"), F.col("pos_all")).alias("tpr"),
    )


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null with one class only."""
    pairs = F.col("neg_all").cast("double") * F.col("pos_all")
    area = F.col("neg") * (F.col("pos_run") - F.col("pos") / 2)
    return (
        roc_points(df, score, label, by)
        .groupBy(*by)
        .agg(F.sum(area).alias("area"), F.max(pairs).alias("pairs"))
        .select(*by, F.when(F.col("pairs") > 0, F.col("area") / F.col("pairs")).alias("auc"))
    )
