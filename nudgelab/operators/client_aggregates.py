"""Per-client aggregates of the purchase log.

One client may hold a large share of all lines, so no step groups raw rows by
client alone: lines collapse to (client, transaction), then to (client, store)
or (client, product), and only these partial results meet at the client.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nudgelab.functions import scalars as S
from nudgelab.operators.quantiles import exact_quantiles

POINTS = (
    "regular_points_received",
    "express_points_received",
    "regular_points_spent",
    "express_points_spent",
)
TRANSACTION_COLUMNS = ("transaction_datetime", *POINTS, "purchase_sum", "store_id")
AMOUNT_QUANTILES = {
    "transaction_amount_q0.25": 0.25,
    "transaction_amount_q0.5": 0.5,
    "transaction_amount_q0.75": 0.75,
}


def transactions(purchases: DataFrame) -> DataFrame:
    """One row per (client, transaction); transaction ids may repeat across clients."""
    return purchases.groupBy("client_id", "transaction_id").agg(
        *(F.min(c).alias(c) for c in TRANSACTION_COLUMNS)
    )


def store_visits(tx: DataFrame, clock: bool = False) -> DataFrame:
    """Partial aggregates per (client, store); each of them adds up at the client.

    ``clock`` adds visit counts by weekday and by hour.
    """
    slots = [f"count_if(weekday(transaction_datetime) = {d}) AS weekday_{d}" for d in range(7)]
    slots += [f"count_if(hour(transaction_datetime) = {h}) AS hour_{h}" for h in range(24)]
    return tx.groupBy("client_id", "store_id").agg(
        F.count("*").alias("visits"),
        F.count("purchase_sum").alias("amounts"),
        S.total(F.col("purchase_sum")).alias("amount"),
        F.min("purchase_sum").alias("amount_min"),
        F.max("purchase_sum").alias("amount_max"),
        *(S.total(F.col(c)).alias(c) for c in POINTS),
        F.count("regular_points_received").alias("regular_received_rows"),
        F.count("express_points_received").alias("express_received_rows"),
        F.min("transaction_datetime").alias("first_seen"),
        F.max("transaction_datetime").alias("last_seen"),
        *(F.expr(slot) for slot in slots if clock),
    )


def _most_frequent(counts: list[str]) -> Column:
    """Index of the largest sum, the smallest index on a tie, -1 when all are zero."""
    values = f"array({', '.join(f'sum({c})' for c in counts)})"
    return F.expr(
        f"CASE WHEN array_max({values}) > 0 "
        f"THEN array_position({values}, array_max({values})) - 1 ELSE -1L END"
    )


def transaction_features(tx: DataFrame, habits: bool = False) -> DataFrame:
    """Everything about a client's transactions that adds up over stores.

    ``habits`` adds the most frequent weekday, hour and store.
    """
    n = F.sum("visits")
    received = F.sum("regular_points_received") + F.sum("express_points_received")
    spent = F.sum("regular_points_spent") + F.sum("express_points_spent")
    visited = F.col("store_id").isNotNull()
    usual = []
    if habits:
        ranked_store = F.struct((-F.col("visits")).alias("rank"), F.col("store_id"))
        usual = [
            _most_frequent([f"weekday_{d}" for d in range(7)]).alias("most_frequent_weekday"),
            _most_frequent([f"hour_{h}" for h in range(24)]).alias("most_frequent_hour"),
            F.min(F.when(visited, ranked_store))["store_id"].alias("most_frequent_store"),
        ]
    per_client = store_visits(tx, clock=habits).groupBy("client_id").agg(
        n.alias("total_transactions"),
        F.sum("amount").alias("total_purchase_sum"),
        S.guarded_div(F.sum("amount"), F.sum("amounts")).alias(
            "avg_transaction_amount"
        ),
        F.max("amount_max").alias("max_transaction_amount"),
        F.min("amount_min").alias("min_transaction_amount"),
        *(F.sum(c).alias(f"total_{c}") for c in POINTS),
        S.guarded_div(
            F.sum("regular_points_received"), F.sum("regular_received_rows")
        ).alias("avg_regular_points_per_transaction"),
        S.guarded_div(
            F.sum("express_points_received"), F.sum("express_received_rows")
        ).alias("avg_express_points_per_transaction"),
        (received / (spent + 1)).alias("points_earned_to_spent_ratio"),
        F.min("first_seen").alias("first_transaction_date"),
        F.max("last_seen").alias("last_transaction_date"),
        F.count("store_id").alias("unique_stores_visited"),
        F.coalesce(F.max(F.when(visited, F.col("visits"))) / n, F.lit(0.0)).alias(
            "store_loyalty_ratio"
        ),
        *usual,
    )
    first, last = F.col("first_transaction_date"), F.col("last_transaction_date")
    period = S.floor_days(first, last)
    return per_client.withColumns(
        {
            "transaction_period_days": period,
            "first_transaction_quarter": S.quarter_label(first),
            "first_transaction_year_quarter_idx": S.quarter_index(first),
            "transactions_per_day": F.col("total_transactions") / (period + 1),
        }
    )


def amount_spread(tx: DataFrame) -> DataFrame:
    """Sample deviation of the transaction amount; null for a single transaction."""
    return tx.groupBy("client_id").agg(
        F.stddev_samp("purchase_sum").alias("std_transaction_amount")
    )


def amount_quantiles(tx: DataFrame) -> DataFrame:
    """Interpolated quartiles of the transaction amount (reads ``tx`` twice)."""
    return exact_quantiles(tx, "purchase_sum", AMOUNT_QUANTILES, by=["client_id"])


def product_features(purchases: DataFrame) -> DataFrame:
    """Product-line aggregates, collapsed to (client, product) first."""
    baskets = purchases.groupBy("client_id", "product_id").agg(
        F.count("product_quantity").alias("lines"),
        S.total(F.col("product_quantity")).alias("quantity"),
        S.total(F.col("trn_sum_from_iss")).alias("issued"),
        S.total(F.col("trn_sum_from_red")).alias("redeemed"),
    )
    quantity = F.sum("quantity")
    return baskets.groupBy("client_id").agg(
        quantity.alias("total_products_purchased"),
        F.count("product_id").alias("unique_products_count"),
        F.sum("issued").alias("total_trn_sum_from_iss"),
        F.sum("redeemed").alias("total_trn_sum_from_red"),
        S.guarded_div(quantity, F.sum("lines")).alias("avg_product_quantity"),
    )
