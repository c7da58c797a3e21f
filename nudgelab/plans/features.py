"""The client feature frame: training, audit and scoring variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nudgelab.functions import scalars as S
from nudgelab.operators import age as A
from nudgelab.operators import clean as C
from nudgelab.operators import client_aggregates as G
from nudgelab.operators.business import add_business_features
from nudgelab.session import materialize

KEY, ARM, RESPONSE = "client_id", "treatment_flg", "target"
LABELS = (ARM, RESPONSE)

# The names of the features, as the result has to carry them.
STATIC_FEATURES = ("first_issue_month", "first_issue_weekday", "first_issue_year_quarter_idx")
BEHAVIOUR_FEATURES = (
    "total_transactions",
    "avg_transaction_amount",
    "max_transaction_amount",
    "min_transaction_amount",
    "total_express_points_received",
    "total_express_points_spent",
    "avg_express_points_per_transaction",
    "points_earned_to_spent_ratio",
    "unique_products_count",
    "avg_product_quantity",
    "transaction_period_days",
    "first_transaction_quarter",
    "first_transaction_year_quarter_idx",
    "unique_stores_visited",
    "store_loyalty_ratio",
)
RATIO_FEATURES = (
    "avg_purchase_per_day",
    "transactions_per_month",
    "points_spend_ratio",
    "points_balance_ratio",
    "unique_store_intensity",
    "log_total_purchase_sum",
    "seasonal_quarter_code",
    "avg_items_per_transaction",
    "spend_points_per_transaction",
    "transaction_value_density",
    "is_super_loyal",
)
DEMOGRAPHIC_FEATURES = ("age", "gender", "is_activated")
# The feature contract of the effect models.
MODEL_FEATURES = STATIC_FEATURES + BEHAVIOUR_FEATURES + RATIO_FEATURES + DEMOGRAPHIC_FEATURES
# The audit keeps one more store ratio and leaves out the quarter index of the first purchase.
AUDIT_FEATURES = tuple(
    c for c in MODEL_FEATURES if c != "first_transaction_year_quarter_idx"
) + ("store_visit_intensity",)


def behaviour(purchases: DataFrame) -> DataFrame:
    """Per-client aggregates that need no deviation or quantile of the amount."""
    cleaned = C.clean_purchases(purchases)
    return G.transaction_features(G.transactions(cleaned)).join(
        G.product_features(cleaned), KEY
    )


def wide_behaviour(purchases: DataFrame) -> DataFrame:
    """All per-client aggregates.

    Deviation, quantiles and store visits each read the transaction table, so
    that table is materialised once.
    """
    cleaned = C.clean_purchases(purchases)
    tx = materialize(G.transactions(cleaned))
    return (
        G.transaction_features(tx, habits=True)
        .join(G.amount_spread(tx), KEY, "left")
        .join(G.amount_quantiles(tx), KEY, "left")
        .join(G.product_features(cleaned), KEY)
    )


def with_client_columns(
    clients: DataFrame, behaviours: DataFrame, age_statistics: DataFrame | None = None
) -> DataFrame:
    """Static, demographic and behaviour columns of every client, plus the ratios."""
    stats = A.age_stats(clients) if age_statistics is None else age_statistics
    described = C.add_static(A.impute_age(clients, stats))
    return add_business_features(described.join(behaviours, KEY, "left"))


def client_features(
    clients: DataFrame,
    campaign: DataFrame,
    purchases: DataFrame,
    drop_redundant: bool = True,
    na_fill: float | None = None,
) -> DataFrame:
    """Labelled feature frame: one row per client of the experiment.

    ``drop_redundant`` keeps the model features only; Catalyst then never
    computes the others. ``na_fill`` replaces numeric nulls.
    """
    labelled = C.labelled_clients(clients, campaign)
    if drop_redundant:
        frame = with_client_columns(labelled, behaviour(purchases))
        frame = frame.select(KEY, *MODEL_FEATURES, *LABELS)
    else:
        frame = with_client_columns(labelled, wide_behaviour(purchases))
        frame = frame.drop("first_issue_date", "first_redeem_date", "store_visit_intensity")
    return S.sanitize_numerics(frame, exclude=(KEY, *LABELS), na_fill=na_fill)


def audit_features(
    clients: DataFrame, campaign: DataFrame, purchases: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """Labelled frame of the experiment audit; ``extra`` names further columns to keep."""
    labelled = C.labelled_clients(clients, campaign)
    frame = with_client_columns(labelled, behaviour(purchases))
    return S.sanitize_numerics(
        frame.select(KEY, *AUDIT_FEATURES, *extra, *LABELS), exclude=(KEY, *LABELS)
    )


def scoring_features(
    clients: DataFrame,
    purchases: DataFrame,
    age_statistics: DataFrame | None = None,
    drop_redundant: bool = True,
) -> DataFrame:
    """Unlabelled feature frame of every submitted client, numeric nulls as 0.

    Pass the statistics fitted on training clients; without them the submitted
    clients are used.
    """
    submitted = C.first_client_row(C.require_columns(clients, KEY))
    C.require_columns(purchases, KEY)
    log = behaviour(purchases) if drop_redundant else wide_behaviour(purchases)
    frame = with_client_columns(submitted, log, age_statistics)
    if drop_redundant:
        frame = frame.select(KEY, *MODEL_FEATURES)
    else:
        frame = frame.drop("first_issue_date", "first_redeem_date", "store_visit_intensity")
    return S.sanitize_numerics(frame, exclude=(KEY,), na_fill=0.0)


def business_features(
    clients: DataFrame, campaign: DataFrame, purchases: DataFrame, names: tuple[str, ...]
) -> DataFrame:
    """Selected ratios of the labelled clients, before sanitising."""
    labelled = C.labelled_clients(clients, campaign)
    joined = C.add_static(labelled).join(behaviour(purchases), KEY, "left")
    return add_business_features(joined).select(KEY, *(F.col(n) for n in names))
