"""Cleaning of the client table and the purchase log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nudgelab.functions import scalars as S
from nudgelab.session import materialize

KNOWN_ROW = "ok"

#: Levels whose means are broadcast.
BROADCAST_LEVELS = 100_000


def labelled_clients(clients: DataFrame, campaign: DataFrame) -> DataFrame:
    """Clients of the experiment with arm and response, matched by key."""
    return campaign.select("client_id", "treatment_flg", "target").join(
        clients, "client_id", "inner"
    )


def clean_purchases(purchases: DataFrame) -> DataFrame:
    """Fill the redeemed amount, make spent points positive, parse the time strictly."""
    return purchases.withColumns(
        {
            "transaction_datetime": S.strict_timestamp(F.col("transaction_datetime")),
            "trn_sum_from_red": F.coalesce("trn_sum_from_red", "trn_sum_from_iss"),
            "regular_points_spent": F.abs("regular_points_spent"),
            "express_points_spent": F.abs("express_points_spent"),
        }
    )


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Reject a frame without the named columns before any job starts."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    return df


def quarantine(df: DataFrame, key: str = "client_id") -> DataFrame:
    """Tag each row: 200 for a usable integer key, 400 with a reason otherwise."""
    require_columns(df, key)
    parsed = F.col(key).try_cast("bigint")
    reason = (
        F.when(F.col(key).isNull(), F.lit("missing key"))
        .when(parsed.isNull(), F.lit("key is not an integer"))
        .otherwise(F.lit(KNOWN_ROW))
    )
    return df.withColumns(
        {
            "row_status": reason,
            "status_code": F.when(reason == KNOWN_ROW, F.lit(200)).otherwise(F.lit(400)),
            "parsed_key": parsed,
        }
    )


def first_client_row(clients: DataFrame) -> DataFrame:
    """One row per client: the first by issue date, then by the other columns.

    The copies of one client may be many, so the pick is an aggregate that
    combines before the shuffle, not a window over the group.
    """
    others = [c for c in clients.columns if c != "client_id"]
    order = sorted(others, key=lambda c: (c != "first_issue_date", c))
    picked = clients.groupBy("client_id").agg(F.min(F.struct(*order)).alias("row"))
    return picked.select("client_id", *(F.col(f"row.{c}").alias(c) for c in others))


def add_static(clients: DataFrame) -> DataFrame:
    """Add calendar parts of the card's issue, the lag to first use, the activation flag."""
    issued = S.lenient_timestamp(F.col("first_issue_date"))
    redeemed = S.lenient_timestamp(F.col("first_redeem_date"))
    return clients.withColumns(
        {
            "first_issue_month": F.month(issued).cast("bigint"),
            "first_issue_weekday": F.weekday(issued).cast("bigint"),
            "first_issue_quarter": S.quarter_label(issued),
            "first_issue_year_quarter_idx": S.quarter_index(issued),
            "redeem_lag_days": S.floor_days(issued, redeemed),
            "is_activated": F.col("first_redeem_date").isNotNull().cast("int"),
        }
    )


def rare_levels(df: DataFrame, column: str, min_share: float = 0.005) -> DataFrame:
    """Level counts with the level each one is reported under.

    Shares are taken over non-null values; null is its own level ``nan``.
    """
    counts = df.groupBy(F.col(column).alias("level")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum(F.when(F.col("level").isNotNull(), F.col("n"))).alias("n_known"))
    rare = F.col("level").isNotNull() & (F.col("n") / F.col("n_known") < min_share)
    return counts.join(F.broadcast(total)).select(
        F.coalesce(F.col("level"), F.lit("nan")).alias("level"),
        "n",
        F.when(rare, F.lit("RARE"))
        .otherwise(F.coalesce(F.col("level"), F.lit("nan")))
        .alias("reported_level"),
    )


def target_encode(df: DataFrame, column: str, target: str) -> DataFrame:
    """Replace a category by the mean response of its level.

    The means are broadcast if there are ``BROADCAST_LEVELS`` at most, so a frequent level is no
    hot key; more levels are joined on the level, where adaptive execution splits hot ones.
    """
    level = F.coalesce(F.col(column), F.lit("nan"))
    means = materialize(df.groupBy(level.alias("level")).agg(F.avg(target).alias("encoded")))
    if means.limit(BROADCAST_LEVELS + 1).count() <= BROADCAST_LEVELS:
        means = F.broadcast(means)
    return df.withColumn("level", level).join(means, "level", "left")

