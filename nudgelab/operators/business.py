"""Business ratios: a projection over the joined client aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nudgelab.functions import scalars as S

LOYALTY_THRESHOLD = 0.9


def add_business_features(df: DataFrame) -> DataFrame:
    """Add the ratios; a client without purchases keeps null ratios and zero flags."""
    total = F.col("total_purchase_sum")
    days = S.at_least(F.col("transaction_period_days"), 1)
    count = S.at_least(F.col("total_transactions"), 1)
    received = F.col("total_regular_points_received") + F.col("total_express_points_received")
    spent = F.col("total_regular_points_spent") + F.col("total_express_points_spent")
    log_total = F.log1p(total)
    loyal = S.flag(F.col("store_loyalty_ratio") >= LOYALTY_THRESHOLD)
    per_transaction = S.guarded_div(received, count)
    store_rate = S.guarded_div(F.col("unique_stores_visited"), count)
    return df.withColumns(
        {
            "avg_purchase_per_day": S.guarded_div(total, days),
            "spend_per_transaction": S.guarded_div(total, count),
            "transactions_per_month": S.guarded_div(F.col("total_transactions"), days / 30),
            "points_earn_ratio": per_transaction,
            "points_spend_ratio": S.guarded_div(spent, count),
            "points_balance_ratio": S.guarded_div(received, spent + 1),
            "avg_points_per_purchase": per_transaction,
            "loyal_store_flag": loyal,
            "unique_store_intensity": store_rate,
            "store_visit_intensity": store_rate,
            "activity_density": S.guarded_div(F.col("total_transactions"), days),
            "log_total_purchase_sum": log_total,
            "seasonal_quarter_code": F.coalesce(
                F.quarter("first_transaction_date"), F.lit(0)
            ),
            "avg_items_per_transaction": S.guarded_div(F.col("total_products_purchased"), count),
            "spend_points_per_transaction": S.guarded_div(
                F.col("total_regular_points_spent"), count
            ),
            "transaction_value_density": S.guarded_div(log_total, days),
            "is_super_loyal": loyal,
        }
    )


BUSINESS_FEATURES = (
    "avg_purchase_per_day",
    "spend_per_transaction",
    "transactions_per_month",
    "points_earn_ratio",
    "points_spend_ratio",
    "points_balance_ratio",
    "avg_points_per_purchase",
    "loyal_store_flag",
    "unique_store_intensity",
    "activity_density",
    "log_total_purchase_sum",
    "seasonal_quarter_code",
    "avg_items_per_transaction",
    "spend_points_per_transaction",
    "transaction_value_density",
    "is_super_loyal",
)
