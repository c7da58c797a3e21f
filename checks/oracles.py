"""The same results as plain SQL over the raw tables."""

from __future__ import annotations

from checks.queries import (
    AUDIT_NUMERIC,
    CRAMER_FEATURES,
    HABIT_COLUMNS,
    POINT_COLUMNS,
    PROFILED,
    STORE_COLUMNS,
    TIME_COLUMNS,
)
from nudgelab.operators.business import BUSINESS_FEATURES
from nudgelab.plans.features import AUDIT_FEATURES, MODEL_FEATURES
from nudgelab.sources.driver_tables import view_sql

DAY = 86400000000


def r(sql: str, digits: int = 6) -> str:
    """Half-even rounding, by way of 9 places, without a negative zero."""
    fine = f"round_even(CAST({sql} AS DOUBLE), 9)" if digits < 9 else f"CAST({sql} AS DOUBLE)"
    return f"(round_even({fine}, {digits}) + 0.0)"


def total(column: str) -> str:
    """Plain sum, 0 over nothing but nulls."""
    return f"coalesce(sum(CAST({column} AS DOUBLE)), 0.0)"


def quarter_label(d: str) -> str:
    return f"CAST(year({d}) AS VARCHAR) || 'Q' || CAST(quarter({d}) AS VARCHAR)"


def quarter_index(d: str) -> str:
    return f"CAST(year({d}) * 4 + quarter({d}) AS BIGINT)"


def floor_days(a: str, b: str) -> str:
    return f"CAST(floor((epoch_us({b}) - epoch_us({a})) / CAST({DAY} AS DOUBLE)) AS BIGINT)"


def div(a: str, b: str) -> str:
    return f"(CASE WHEN {b} = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END)"


POINTS = (
    "regular_points_received",
    "express_points_received",
    "regular_points_spent",
    "express_points_spent",
)

CTES: dict[str, str] = dict(view_sql())
CTES["labelled"] = (
    "SELECT c.client_id, treatment_flg, target, first_issue_date, first_redeem_date, age, gender "
    "FROM campaign JOIN clients c ON campaign.client_id = c.client_id"
)
CTES["cleaned"] = (
    "SELECT client_id, transaction_id, transaction_datetime, regular_points_received, "
    "express_points_received, abs(regular_points_spent) AS regular_points_spent, "
    "abs(express_points_spent) AS express_points_spent, purchase_sum, store_id, product_id, "
    "product_quantity, trn_sum_from_iss, "
    "coalesce(trn_sum_from_red, trn_sum_from_iss) AS trn_sum_from_red FROM purchases"
)
CTES["tx"] = (
    "SELECT client_id, transaction_id, "
    + ", ".join(
        f"min({c}) AS {c}"
        for c in ("transaction_datetime", *POINTS, "purchase_sum", "store_id")
    )
    + " FROM cleaned GROUP BY client_id, transaction_id"
)


def _mode(value: str, name: str) -> str:
    return (
        f"SELECT client_id, v AS {name} FROM (SELECT client_id, {value} AS v, "
        f"row_number() OVER (PARTITION BY client_id ORDER BY count(*) DESC, {value}) AS rn "
        f"FROM tx GROUP BY client_id, {value}) q WHERE rn = 1"
    )


CTES["weekdays"] = _mode(
    "CAST(isodow(transaction_datetime) - 1 AS BIGINT)", "most_frequent_weekday"
)
CTES["hours"] = _mode("CAST(hour(transaction_datetime) AS BIGINT)", "most_frequent_hour")
CTES["favourites"] = _mode("store_id", "most_frequent_store")
CTES["stores"] = (
    "SELECT client_id, count(store_id) AS unique_stores_visited, "
    "CAST(max(k) AS DOUBLE) / CAST(sum(k) AS DOUBLE) AS store_loyalty_ratio "
    "FROM (SELECT client_id, store_id, count(*) AS k FROM tx GROUP BY client_id, store_id) s "
    "GROUP BY client_id"
)
RECEIVED = f"({total('regular_points_received')} + {total('express_points_received')})"
SPENT = f"({total('regular_points_spent')} + {total('express_points_spent')})"
CTES["visits"] = (
    "SELECT client_id, count(*) AS total_transactions, "
    f"{total('purchase_sum')} AS total_purchase_sum, "
    f"{total('purchase_sum')} / count(purchase_sum) AS avg_transaction_amount, "
    "stddev_samp(purchase_sum) AS std_transaction_amount, "
    "max(purchase_sum) AS max_transaction_amount, min(purchase_sum) AS min_transaction_amount, "
    'quantile_cont(purchase_sum, 0.25) AS "transaction_amount_q0.25", '
    'quantile_cont(purchase_sum, 0.5) AS "transaction_amount_q0.5", '
    'quantile_cont(purchase_sum, 0.75) AS "transaction_amount_q0.75", '
    + ", ".join(f"{total(c)} AS total_{c}" for c in POINTS)
    + f", {total('regular_points_received')} / count(regular_points_received) AS avg_regular_points_per_transaction, "
    f"{total('express_points_received')} / count(express_points_received) AS avg_express_points_per_transaction, "
    f"{RECEIVED} / ({SPENT} + 1) AS points_earned_to_spent_ratio, "
    "min(transaction_datetime) AS first_transaction_date, "
    "max(transaction_datetime) AS last_transaction_date FROM tx GROUP BY client_id"
)
PERIOD = floor_days("first_transaction_date", "last_transaction_date")
CTES["behaviour"] = (
    f"SELECT v.*, {PERIOD} AS transaction_period_days, "
    f"{quarter_label('first_transaction_date')} AS first_transaction_quarter, "
    f"{quarter_index('first_transaction_date')} AS first_transaction_year_quarter_idx, "
    f"CAST(total_transactions AS DOUBLE) / ({PERIOD} + 1) AS transactions_per_day, "
    "unique_stores_visited, store_loyalty_ratio, most_frequent_weekday, most_frequent_hour, "
    "most_frequent_store FROM visits v JOIN stores USING (client_id) "
    "JOIN weekdays USING (client_id) JOIN hours USING (client_id) "
    "JOIN favourites USING (client_id)"
)
CTES["products"] = (
    f"SELECT client_id, {total('product_quantity')} AS total_products_purchased, "
    "count(DISTINCT product_id) AS unique_products_count, "
    f"{total('trn_sum_from_iss')} AS total_trn_sum_from_iss, "
    f"{total('trn_sum_from_red')} AS total_trn_sum_from_red, "
    f"{total('product_quantity')} / count(product_quantity) AS avg_product_quantity "
    "FROM cleaned GROUP BY client_id"
)
STATIC = {
    "first_issue_month": "CAST(month(first_issue_date) AS BIGINT)",
    "first_issue_weekday": "CAST(isodow(first_issue_date) - 1 AS BIGINT)",
    "first_issue_quarter": quarter_label("first_issue_date"),
    "first_issue_year_quarter_idx": quarter_index("first_issue_date"),
    "redeem_lag_days": floor_days("first_issue_date", "first_redeem_date"),
    "is_activated": "CAST(first_redeem_date IS NOT NULL AS INTEGER)",
}
STATIC_SQL = ", ".join(f"{sql} AS {name}" for name, sql in STATIC.items())


def age_stats_sql(source: str) -> str:
    valid = f"(SELECT age FROM {source} WHERE age BETWEEN 15 AND 100)"
    return (
        "SELECT q1 AS age_q1, q2 AS age_q2, q3 AS age_q3, "
        "avg(age) FILTER (age <= q1) AS mean_low, "
        "avg(age) FILTER (age > q1 AND age <= q2) AS mean_mid_low, "
        "avg(age) FILTER (age > q2 AND age <= q3) AS mean_mid_high, "
        "avg(age) FILTER (age > q3) AS mean_high, avg(age) AS mean_all "
        f"FROM {valid} v, (SELECT quantile_cont(age, 0.25) AS q1, quantile_cont(age, 0.5) AS q2, "
        f"quantile_cont(age, 0.75) AS q3 FROM {valid} w) q GROUP BY q1, q2, q3"
    )


CTES["ages"] = age_stats_sql("labelled")
AGE = (
    "CASE WHEN age BETWEEN 15 AND 100 THEN CAST(age AS DOUBLE) WHEN age < 15 THEN mean_low "
    "WHEN age > 100 AND age <= 200 THEN mean_high ELSE mean_all END"
)
N, DAYS = "greatest(total_transactions, 1)", "greatest(transaction_period_days, 1)"
GOT = "(total_regular_points_received + total_express_points_received)"
GAVE = "(total_regular_points_spent + total_express_points_spent)"
LOG_TOTAL = "ln(1 + total_purchase_sum)"
LOYAL = "CASE WHEN store_loyalty_ratio >= 0.9 THEN 1 ELSE 0 END"
BUSINESS = {
    "avg_purchase_per_day": div("total_purchase_sum", DAYS),
    "spend_per_transaction": div("total_purchase_sum", N),
    "transactions_per_month": div("total_transactions", f"(CAST({DAYS} AS DOUBLE) / 30)"),
    "points_earn_ratio": div(GOT, N),
    "points_spend_ratio": div(GAVE, N),
    "points_balance_ratio": div(GOT, f"({GAVE} + 1)"),
    "avg_points_per_purchase": div(GOT, N),
    "loyal_store_flag": LOYAL,
    "unique_store_intensity": div("unique_stores_visited", N),
    "activity_density": div("total_transactions", DAYS),
    "log_total_purchase_sum": LOG_TOTAL,
    "seasonal_quarter_code": "CAST(coalesce(quarter(first_transaction_date), 0) AS INTEGER)",
    "avg_items_per_transaction": div("total_products_purchased", N),
    "spend_points_per_transaction": div("total_regular_points_spent", N),
    "transaction_value_density": div(LOG_TOTAL, DAYS),
    "is_super_loyal": LOYAL,
    "store_visit_intensity": div("unique_stores_visited", N),
}
BUSINESS_SQL = ", ".join(f"{sql} AS {name}" for name, sql in BUSINESS.items())


def frame_sql(source: str, labels: bool) -> str:
    """All feature columns of the clients in ``source``."""
    flags = "treatment_flg, target, " if labels else ""
    return (
        f"SELECT s.client_id, {flags}first_issue_month, first_issue_weekday, first_issue_quarter, "
        "first_issue_year_quarter_idx, redeem_lag_days, is_activated, fixed_age AS age, gender, "
        f"b.* EXCLUDE (client_id), p.* EXCLUDE (client_id), {BUSINESS_SQL} "
        f"FROM (SELECT *, {STATIC_SQL}, {AGE} AS fixed_age FROM {source}, ages) s "
        "LEFT JOIN behaviour b ON s.client_id = b.client_id "
        "LEFT JOIN products p ON s.client_id = p.client_id"
    )


CTES["frame"] = frame_sql("labelled", labels=True)
CTES["all_frame"] = frame_sql("clients", labels=False)

TEXT = {"gender", "first_transaction_quarter", "first_issue_quarter"}
WHOLE_NUMBERS = {
    "first_issue_month",
    "first_issue_weekday",
    "first_issue_year_quarter_idx",
    "redeem_lag_days",
    "is_activated",
    "total_transactions",
    "transaction_period_days",
    "first_transaction_year_quarter_idx",
    "unique_stores_visited",
    "unique_products_count",
    "seasonal_quarter_code",
    "is_super_loyal",
    "loyal_store_flag",
    *HABIT_COLUMNS,
}
DATES = {"first_transaction_date", "last_transaction_date"}


def cell(name: str, fill: bool = False) -> str:
    quoted = f'"{name}"'
    if name in TEXT or name in DATES:
        return quoted
    value = f"coalesce({quoted}, 0)" if fill else quoted
    if name in WHOLE_NUMBERS:
        return f"{value} AS {quoted}"
    clipped = f"CASE WHEN {value} IS NOT NULL THEN least(greatest({value}, -1e9), 1e9) END"
    return f"{r(clipped)} AS {quoted}"


def cells(names: tuple[str, ...], fill: bool = False) -> str:
    return ", ".join(cell(n, fill) for n in names)


WIDE_FEATURES = (
    "age",
    "gender",
    *STATIC,
    "total_transactions",
    "total_purchase_sum",
    "avg_transaction_amount",
    "std_transaction_amount",
    "max_transaction_amount",
    "min_transaction_amount",
    "transaction_amount_q0.25",
    "transaction_amount_q0.5",
    "transaction_amount_q0.75",
    *POINT_COLUMNS,
    "total_products_purchased",
    "unique_products_count",
    "total_trn_sum_from_iss",
    "total_trn_sum_from_red",
    "avg_product_quantity",
    *TIME_COLUMNS,
    *HABIT_COLUMNS,
    *STORE_COLUMNS,
    *BUSINESS_FEATURES,
)
CTES["audit"] = f"SELECT client_id, {cells(AUDIT_FEATURES)}, treatment_flg, target FROM frame"
CTES["log"] = (
    # The documents hold numbers only, so every comma and colon is a separator.
    "SELECT id, ts, processing_time, CAST(strlen(json(input_data)) "
    "+ length(regexp_replace(json(input_data), '[^,:]', '', 'g')) AS BIGINT) AS input_size, "
    "CAST(1 + length(regexp_replace(json(input_data), '[^,:]', '', 'g')) AS BIGINT) AS input_tokens, "
    "CAST(status_code AS INTEGER) AS status_code, input_data FROM request_log"
)

NEEDS = {
    "scores": ("campaign",),
    "labelled": ("clients", "campaign"),
    "cleaned": ("purchases",),
    "tx": ("cleaned",),
    "weekdays": ("tx",),
    "hours": ("tx",),
    "favourites": ("tx",),
    "stores": ("tx",),
    "visits": ("tx",),
    "behaviour": ("visits", "stores", "weekdays", "hours", "favourites"),
    "products": ("cleaned",),
    "ages": ("labelled",),
    "frame": ("labelled", "ages", "behaviour", "products"),
    "all_frame": ("clients", "ages", "behaviour", "products"),
    "audit": ("frame",),
    "log": ("request_log",),
}


def with_ctes(sql: str, *names: str, **extra: str) -> str:
    """Prefix ``sql`` with the named tables, what they need, and extra ones."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, ()):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({CTES[n]})" for n in ordered]
    parts += [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH {', '.join(parts)} {sql}"


ORACLES: dict[str, str] = {}

PURCHASE_CELLS = (
    "client_id, transaction_id, transaction_datetime, "
    + ", ".join(f"{r(c)} AS {c}" for c in PROFILED)
    + ", store_id, product_id"
)
for _name in ("scan_purchases", "csv_scan", "payload_explode"):
    ORACLES[_name] = with_ctes(f"SELECT {PURCHASE_CELLS} FROM purchases", "purchases")
ORACLES["clean_purchases"] = with_ctes(f"SELECT {PURCHASE_CELLS} FROM cleaned", "cleaned")
ORACLES["tx_dedup"] = with_ctes(
    "SELECT client_id, transaction_id, transaction_datetime, "
    + ", ".join(f"{r(c)} AS {c}" for c in (*POINTS, "purchase_sum"))
    + ", store_id FROM tx",
    "tx",
)
ORACLES["quarantine_bad_rows"] = with_ctes(
    "SELECT client_id, age, gender, CASE WHEN client_id IS NULL THEN 'missing key' "
    "WHEN try_cast(client_id AS BIGINT) IS NULL THEN 'key is not an integer' ELSE 'ok' END "
    "AS row_status, CASE WHEN try_cast(client_id AS BIGINT) IS NULL THEN 400 ELSE 200 END "
    "AS status_code, try_cast(client_id AS BIGINT) AS parsed_key FROM submitted",
    "clients",
    submitted=(
        "SELECT CASE WHEN client_id % 13 = 0 THEN NULL WHEN client_id % 17 = 0 "
        "THEN 'x' || CAST(client_id AS VARCHAR) ELSE CAST(client_id AS VARCHAR) END AS client_id, "
        "age, gender FROM clients"
    ),
)
ORACLES["labelled_clients"] = with_ctes("SELECT * FROM labelled", "labelled")
ORACLES["score_log_append"] = with_ctes(
    f"SELECT * REPLACE ({r('processing_time')} AS processing_time) FROM log", "log"
)
ORACLES["score_log_truncate"] = with_ctes(
    f"SELECT id, ts, {r('processing_time')} AS processing_time, input_size FROM log WHERE id % 2 = 0",
    "log",
)
ORACLES["score_log_latest"] = with_ctes(
    "SELECT * REPLACE (CASE WHEN json_valid(input_data) "
    "THEN CAST(json(input_data) AS VARCHAR) ELSE input_data END AS input_data) "
    "FROM log ORDER BY id DESC",
    "log",
)
ORACLES["request_size"] = with_ctes("SELECT id, input_size, input_tokens FROM log", "log")
ORACLES["latency_stats"] = with_ctes(
    f"SELECT {r('avg(processing_time)')} AS mean, count(*) AS n, "
    f"{r('sum(processing_time)')} AS total, "
    + ", ".join(f"{r(f'quantile_cont(processing_time, {p / 100})')} AS p{p}" for p in (50, 95, 99))
    + " FROM log WHERE processing_time > 0",
    "log",
)
ORACLES["latency_windows"] = with_ctes(
    "SELECT window_start, window_end, count(*) AS n, "
    f"{r('sum(processing_time)')} AS total, {r('avg(processing_time)')} AS mean, "
    f"{r('min(processing_time)')} AS least, {r('max(processing_time)')} AS most, "
    + ", ".join(f"{r(f'quantile_disc(processing_time, {p / 100})')} AS p{p}" for p in (50, 95, 99))
    + " FROM arrived a WHERE window_end <= (SELECT max(ts) - INTERVAL 2 DAY FROM arrived) "
    "AND coalesce(window_end > (SELECT max(b.ts) - INTERVAL 2 DAY FROM arrived b "
    "WHERE b.arrival < a.arrival), true) GROUP BY window_start, window_end",
    "log",
    arrived=(
        "SELECT ts, processing_time, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, "
        "time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, "
        "least(4, CAST(floor((day(ts) - 1) / 6) AS INTEGER) + CASE WHEN id % 29 = 0 THEN 3 "
        "WHEN id % 13 = 0 THEN 1 ELSE 0 END) AS arrival FROM log WHERE processing_time > 0"
    ),
)
ORACLES["input_stats"] = with_ctes(
    " UNION ALL ".join(
        f"SELECT '{c}' AS measure, {r(f'coalesce(avg(nullif({c}, 0)), 0)')} AS mean, "
        f"CAST(coalesce(sum(nullif({c}, 0)), 0) AS DOUBLE) AS total, count(nullif({c}, 0)) AS n "
        "FROM log WHERE processing_time > 0"
        for c in ("input_size", "input_tokens")
    ),
    "log",
)
ORACLES["status_counts"] = with_ctes(
    "SELECT status_code, CASE status_code WHEN 200 THEN 'scored' WHEN 400 THEN 'bad request' "
    "ELSE 'scoring failed' END AS outcome, count(*) AS n FROM log GROUP BY ALL",
    "log",
)

# --- features --------------------------------------------------------------------------

ORACLES["first_client_row"] = with_ctes(
    "SELECT client_id, first_issue_date, first_redeem_date, age, gender FROM "
    "(SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY first_issue_date, age) AS rn "
    "FROM submitted) s WHERE rn = 1",
    "clients",
    submitted=(
        "SELECT client_id, first_issue_date, first_redeem_date, age, gender FROM clients "
        "UNION ALL SELECT client_id, first_issue_date + INTERVAL '1' DAY, first_redeem_date, "
        "age + 1, gender FROM clients"
    ),
)
ORACLES["client_static"] = with_ctes(f"SELECT client_id, {STATIC_SQL} FROM clients", "clients")
ORACLES["age_stats"] = with_ctes(
    "SELECT "
    + ", ".join(
        f"{r(c)} AS {c}"
        for c in (
            "age_q1",
            "age_q2",
            "age_q3",
            "mean_low",
            "mean_mid_low",
            "mean_mid_high",
            "mean_high",
            "mean_all",
        )
    )
    + " FROM ages",
    "ages",
)
ORACLES["age_impute"] = with_ctes(f"SELECT client_id, {r(AGE)} AS age FROM labelled, ages", "ages")


def _columns(table: str, names: tuple[str, ...]) -> str:
    return with_ctes(f"SELECT client_id, {cells(names)} FROM {table}", table)


ORACLES["client_tx"] = _columns(
    "visits",
    (
        "total_transactions",
        "total_purchase_sum",
        "avg_transaction_amount",
        "std_transaction_amount",
        "max_transaction_amount",
        "min_transaction_amount",
    ),
)
ORACLES["client_quantiles"] = _columns(
    "visits", ("transaction_amount_q0.25", "transaction_amount_q0.5", "transaction_amount_q0.75")
)
ORACLES["client_points"] = _columns("behaviour", POINT_COLUMNS)
ORACLES["client_time"] = _columns("behaviour", TIME_COLUMNS)
ORACLES["client_stores"] = _columns("behaviour", STORE_COLUMNS)
ORACLES["client_modes"] = _columns("behaviour", HABIT_COLUMNS)
ORACLES["client_products"] = _columns(
    "products",
    (
        "total_products_purchased",
        "unique_products_count",
        "total_trn_sum_from_iss",
        "total_trn_sum_from_red",
        "avg_product_quantity",
    ),
)
ORACLES["client_business"] = _columns("frame", BUSINESS_FEATURES)
ORACLES["client_final"] = with_ctes("SELECT * FROM audit", "audit")
ORACLES["client_final_scoring"] = with_ctes(
    f"SELECT client_id, {cells(MODEL_FEATURES, fill=True)}, treatment_flg, target FROM frame",
    "frame",
)
ORACLES["client_features"] = with_ctes(
    f"SELECT client_id, {cells(MODEL_FEATURES)}, treatment_flg, target FROM frame", "frame"
)
ORACLES["client_features_wide"] = with_ctes(
    f"SELECT client_id, {cells(WIDE_FEATURES)}, treatment_flg, target FROM frame", "frame"
)
ORACLES["client_features_scoring"] = with_ctes(
    f"SELECT client_id, {cells(MODEL_FEATURES, fill=True)} FROM all_frame", "all_frame"
)

# --- profiling -------------------------------------------------------------------------

PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)
ORACLES["profile_numeric"] = with_ctes(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, {r(f'avg({c})')} AS mean, "
        f"{r(f'stddev_samp({c})')} AS std, {r(f'min({c})')} AS min, {r(f'max({c})')} AS max, "
        + ", ".join(f"{r(f'quantile_cont({c}, {p / 100})')} AS p{p}" for p in PERCENTILES)
        + " FROM purchases"
        for c in PROFILED
    ),
    "purchases",
)
ORACLES["profile_numeric_clients"] = with_ctes(
    f"SELECT 'age' AS \"column\", count(age) AS n, {r('avg(age)')} AS mean, "
    f"{r('stddev_samp(age)')} AS std, {r('CAST(min(age) AS DOUBLE)')} AS min, "
    f"{r('CAST(max(age) AS DOUBLE)')} AS max, "
    + ", ".join(f"{r(f'quantile_cont(age, {p / 100})')} AS p{p}" for p in PERCENTILES)
    + " FROM clients",
    "clients",
)
ORACLES["profile_categorical"] = with_ctes(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(sum(k) AS BIGINT) AS n, count(*) AS \"unique\", "
        "min_by(v, (-k, v)) AS top, max(k) AS freq "
        f"FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS k FROM purchases "
        f"WHERE {c} IS NOT NULL GROUP BY 1) t"
        for c in ("store_id", "product_id")
    ),
    "purchases",
)
PURCHASE_COLUMNS = (
    "client_id",
    "transaction_id",
    "transaction_datetime",
    *PROFILED,
    "store_id",
    "product_id",
)
_null_rows = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM purchases"
    for c in PURCHASE_COLUMNS
)
ORACLES["null_counts"] = with_ctes(
    "SELECT * FROM counted UNION ALL SELECT '(all)', CAST(sum(nulls) AS BIGINT) FROM counted",
    "purchases",
    counted=_null_rows,
)
ORACLES["null_counts_clients"] = with_ctes(
    "SELECT * FROM counted UNION ALL SELECT '(all)', CAST(sum(nulls) AS BIGINT) FROM counted",
    "clients",
    counted=" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM clients"
        for c in ("client_id", "first_issue_date", "first_redeem_date", "age", "gender")
    ),
)
ORACLES["profile_gender"] = with_ctes(
    "SELECT 'gender' AS \"column\", CAST(sum(k) AS BIGINT) AS n, count(*) AS \"unique\", "
    "min_by(v, (-k, v)) AS top, max(k) AS freq FROM (SELECT gender AS v, count(*) AS k "
    "FROM clients WHERE gender IS NOT NULL GROUP BY 1) t",
    "clients",
)
ORACLES["profile_distinct"] = with_ctes(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values, CAST("
        + (
            f"count(DISTINCT {c}) < 100"
            if c in TEXT
            else f"count(DISTINCT {c}) <= 2 AND min({c}) >= 0 AND max({c}) <= 1"
        )
        + " AS INTEGER) AS is_categorical FROM static"
        for c in (
            "gender",
            "first_issue_quarter",
            "first_issue_month",
            "is_activated",
            "treatment_flg",
            "target",
        )
    ),
    "labelled",
    static=f"SELECT *, {STATIC_SQL} FROM labelled",
)
ORACLES["rare_levels"] = with_ctes(
    "SELECT level, n, CASE WHEN CAST(n AS DOUBLE) / (SELECT sum(n) FROM counted) < 0.02 "
    "THEN 'RARE' ELSE level END AS reported_level FROM counted",
    "labelled",
    counted=(
        f"SELECT {STATIC['first_issue_quarter']} AS level, count(*) AS n FROM labelled GROUP BY 1"
    ),
)
ORACLES["target_encode"] = with_ctes(
    f"SELECT client_id, level, {r('avg(target) OVER (PARTITION BY level)')} AS encoded "
    f"FROM (SELECT *, {STATIC['first_issue_quarter']} AS level FROM labelled) s",
    "labelled",
)
ORACLES["score_summary"] = with_ctes(
    f"SELECT count(uplift) AS n, {r('min(uplift)')} AS min_score, {r('max(uplift)')} AS max_score, "
    f"{r('avg(uplift)')} AS mean_score FROM scores",
    "scores",
)
ORACLES["score_histogram"] = with_ctes(
    f"SELECT CAST(i AS INTEGER) AS bin, {r('lo + i * width')} AS left_edge, "
    "(SELECT count(*) FROM scores s WHERE least(floor((s.uplift - lo) / width), 49) = i) AS n "
    "FROM (SELECT min(uplift) AS lo, (max(uplift) - min(uplift)) / 50 AS width FROM scores) b, "
    "range(50) t(i)",
    "scores",
)
_classes = []
for c in (0, 1):
    hit = f"count(*) FILTER (target = {c} AND guess = {c})"
    missed = f"count(*) FILTER (target = {c} AND guess = {1 - c})"
    false = f"count(*) FILTER (target = {1 - c} AND guess = {c})"
    _classes.append(
        f"SELECT {c} AS class, count(*) FILTER (target = {c} AND guess = 0) AS predicted_0, "
        f"count(*) FILTER (target = {c} AND guess = 1) AS predicted_1, "
        f"{r(f'{hit} / CAST({hit} + {false} AS DOUBLE)')} AS precision, "
        f"{r(f'{hit} / CAST({hit} + {missed} AS DOUBLE)')} AS recall, "
        f"{r(f'2 * {hit} / CAST(2 * {hit} + {false} + {missed} AS DOUBLE)')} AS f1, "
        f"{hit} + {missed} AS support FROM guessed"
    )
ORACLES["confusion_matrix"] = with_ctes(
    " UNION ALL ".join(_classes),
    "scores",
    guessed="SELECT target, CAST(uplift > 0.5 AS INTEGER) AS guess FROM scores",
)

_report_classes = " UNION ALL ".join(
    f"SELECT {c} AS class, 1.0 * hit / nullif(guessed_n, 0) AS precision, "
    "1.0 * hit / nullif(support, 0) AS recall, 2.0 * hit / nullif(guessed_n + support, 0) AS f1, "
    "support, hit FROM "
    f"(SELECT count(*) FILTER (target = {c} AND guess = {c}) AS hit, "
    f"count(*) FILTER (guess = {c}) AS guessed_n, count(*) FILTER (target = {c}) AS support "
    "FROM guessed) k"
    for c in (0, 1)
)
_measures = ("precision", "recall", "f1")
ORACLES["classification_report"] = with_ctes(
    "SELECT CAST(class AS VARCHAR) AS line, "
    + ", ".join(f"{r(m)} AS {m}" for m in _measures)
    + ", support FROM report UNION ALL SELECT 'accuracy', NULL, NULL, "
    + f"{r('sum(hit) / CAST(sum(support) AS DOUBLE)')}, CAST(sum(support) AS BIGINT) FROM report "
    + "UNION ALL SELECT 'macro avg', "
    + ", ".join(r(f"avg({m})") for m in _measures)
    + ", CAST(sum(support) AS BIGINT) FROM report UNION ALL SELECT 'weighted avg', "
    + ", ".join(r(f"sum({m} * support) / sum(support)") for m in _measures)
    + ", CAST(sum(support) AS BIGINT) FROM report",
    "scores",
    guessed="SELECT target, CAST(uplift > 0.5 AS INTEGER) AS guess FROM scores",
    report=_report_classes,
)

# --- experiment ------------------------------------------------------------------------

ORACLES["target_distribution"] = with_ctes(
    f"SELECT target, count(*) AS n, {r('count(*) * 100.0 / sum(count(*)) OVER ()')} AS percent "
    "FROM campaign GROUP BY target",
    "campaign",
)
ORACLES["crosstab_treatment_target"] = with_ctes(
    "SELECT treatment_flg, count(*) FILTER (target = 0) AS n_0, "
    "count(*) FILTER (target = 1) AS n_1, "
    f"{r('avg(1 - target) * 100')} AS percent_0, {r('avg(target) * 100')} AS percent_1 "
    "FROM campaign GROUP BY treatment_flg",
    "campaign",
)
ARMS = (
    "SELECT count(*) FILTER (treatment_flg = 0) AS n_control, "
    "count(*) FILTER (treatment_flg = 1) AS n_treated, "
    "count(*) FILTER (treatment_flg = 0 AND target = 1) AS y_control, "
    "count(*) FILTER (treatment_flg = 1 AND target = 1) AS y_treated, "
    "avg(target) AS conversion, "
    "avg(target) FILTER (treatment_flg = 0) AS conversion_control, "
    "avg(target) FILTER (treatment_flg = 1) AS conversion_treated FROM campaign"
)
P0, P1 = "conversion_control", "conversion_treated"
ORACLES["ate_summary"] = with_ctes(
    f"SELECT n_control, n_treated, y_control, y_treated, {r('conversion')} AS conversion, "
    f"{r(P0)} AS conversion_control, {r(P1)} AS conversion_treated, "
    f"{r(f'{P1} - {P0}')} AS lift, {r(f'({P1} - {P0}) / {P0}')} AS relative_lift FROM arms",
    "campaign",
    arms=ARMS,
)
_z = f"({P1} - {P0}) / sqrt(conversion * (1 - conversion) * (1.0 / n_control + 1.0 / n_treated))"
ORACLES["ztest"] = with_ctes(f"SELECT {r(_z)} AS z FROM arms", "campaign", arms=ARMS)
ORACLES["ttest"] = with_ctes(
    "SELECT "
    + r(
        "(m1 - m0) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1))"
    )
    + " AS t, n0 + n1 - 2 AS degrees_of_freedom FROM moments",
    "campaign",
    moments=(
        "SELECT count(*) FILTER (treatment_flg = 0) AS n0, "
        "count(*) FILTER (treatment_flg = 1) AS n1, "
        "avg(target) FILTER (treatment_flg = 0) AS m0, "
        "avg(target) FILTER (treatment_flg = 1) AS m1, "
        "var_samp(target) FILTER (treatment_flg = 0) AS v0, "
        "var_samp(target) FILTER (treatment_flg = 1) AS v1 FROM campaign"
    ),
)
_v0, _v1 = f"{P0} * (1 - {P0}) / n_control", f"{P1} * (1 - {P1}) / n_treated"
ORACLES["conversion_ci"] = with_ctes(
    " UNION ALL ".join(
        f"SELECT '{name}' AS quantity, {r(estimate)} AS estimate, "
        f"{r(f'({estimate}) - 1.959963984540054 * sqrt({v})')} AS low, "
        f"{r(f'({estimate}) + 1.959963984540054 * sqrt({v})')} AS high FROM arms"
        for name, estimate, v in (
            ("control", P0, _v0),
            ("treated", P1, _v1),
            ("difference", f"{P1} - {P0}", f"{_v0} + {_v1}"),
        )
    ),
    "campaign",
    arms=ARMS,
)
AUDIT_TEXT = ("gender", "first_transaction_quarter")
_encoded = " UNION ALL ".join(
    [
        f"SELECT treatment_flg, '{c}' AS feature, CAST(coalesce({c}, 0) AS DOUBLE) AS v FROM audit"
        for c in AUDIT_NUMERIC
    ]
    + [
        f"SELECT treatment_flg, '{c}_' || l.level AS feature, "
        f"CAST(coalesce({c}, 'nan') = l.level AS DOUBLE) AS v "
        f"FROM audit, (SELECT DISTINCT coalesce({c}, 'nan') AS level FROM audit) l"
        for c in AUDIT_TEXT
    ]
)
SMD = "CASE WHEN v0 + v1 > 0 THEN (m1 - m0) / sqrt((v0 + v1) / 2) END"
ORACLES["smd_balance"] = with_ctes(
    f"SELECT feature, {r('smd')} AS abs_smd, CASE WHEN smd > 0.2 THEN 'large' "
    "WHEN smd > 0.1 THEN 'moderate' ELSE 'balanced' END AS balance FROM "
    f"(SELECT feature, abs({SMD}) AS smd FROM moments) s",
    "audit",
    encoded=_encoded,
    moments=(
        "SELECT feature, avg(v) FILTER (treatment_flg = 0) AS m0, "
        "avg(v) FILTER (treatment_flg = 1) AS m1, "
        "var_samp(v) FILTER (treatment_flg = 0) AS v0, "
        "var_samp(v) FILTER (treatment_flg = 1) AS v1 FROM encoded GROUP BY feature"
    ),
)

# --- association -----------------------------------------------------------------------


def _corr(a: str, b: str) -> str:
    return f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS corr FROM audit"


_pairs = [
    (a, b) for i, a in enumerate(AUDIT_NUMERIC) for j, b in enumerate(AUDIT_NUMERIC) if i < j
]
_pair_sql = (
    "SELECT feature_1, feature_2, CASE WHEN isfinite(corr) THEN corr END AS corr FROM ("
    + " UNION ALL ".join(_corr(a, b) for a, b in _pairs)
    + ") p"
)
ORACLES["corr_pairs"] = with_ctes(
    f"SELECT feature_1, feature_2, {r('corr')} AS corr FROM pairs WHERE abs(corr) > 0.7",
    "audit",
    pairs=_pair_sql,
)
_diagonal = " UNION ALL ".join(
    f"SELECT '{c}', '{c}', CASE WHEN min({c}) < max({c}) THEN 1.0 END FROM audit"
    for c in AUDIT_NUMERIC
)
ORACLES["corr_matrix"] = with_ctes(
    f"SELECT feature_1, feature_2, {r('corr')} AS corr FROM (SELECT * FROM pairs UNION ALL "
    f"SELECT feature_2, feature_1, corr FROM pairs UNION ALL {_diagonal}) m",
    "audit",
    pairs=_pair_sql,
)
_cells = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, CAST({a} AS VARCHAR) AS v1, "
    f"CAST({b} AS VARCHAR) AS v2, CAST(count(*) AS DOUBLE) AS o FROM audit "
    f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL"
    for i, a in enumerate(CRAMER_FEATURES)
    for j, b in enumerate(CRAMER_FEATURES)
    if i <= j
)
ORACLES["cramers_v"] = with_ctes(
    "SELECT feature_1, feature_2, "
    + r(
        "CASE WHEN least(kc, rc) - 1 > 0 THEN sqrt(greatest(0, phi2 - (k - 1) * (r - 1) / (n - 1))"
        " / (least(kc, rc) - 1)) END"
    )
    + " AS v_cramer FROM (SELECT *, r - (r - 1) * (r - 1) / (n - 1) AS rc, "
    "k - (k - 1) * (k - 1) / (n - 1) AS kc FROM stats) t",
    "audit",
    cells=_cells,
    margins=(
        "SELECT *, sum(o) OVER (PARTITION BY feature_1, feature_2, v1) AS ro, "
        "sum(o) OVER (PARTITION BY feature_1, feature_2, v2) AS co, "
        "sum(o) OVER (PARTITION BY feature_1, feature_2) AS n FROM cells"
    ),
    stats=(
        "SELECT feature_1, feature_2, CAST(count(DISTINCT v1) AS DOUBLE) AS r, "
        "CAST(count(DISTINCT v2) AS DOUBLE) AS k, max(n) AS n, "
        # chi2 over all cells, the empty ones through their expected counts
        "(sum((o - ro * co / n) * (o - ro * co / n) / (ro * co / n)) + max(n) "
        "- sum(ro * co / n)) / max(n) AS phi2 FROM margins GROUP BY feature_1, feature_2"
    ),
)

_detectable = (*AUDIT_FEATURES, "first_issue_quarter", "treatment_flg", "target")
ORACLES["cramers_v_detected"] = with_ctes(
    "SELECT feature_1, feature_2, "
    + r(
        "CASE WHEN least(kc, rc) - 1 > 0 THEN sqrt(greatest(0, phi2 - (k - 1) * (r - 1) / (n - 1))"
        " / (least(kc, rc) - 1)) END"
    )
    + " AS v_cramer FROM (SELECT *, r - (r - 1) * (r - 1) / (n - 1) AS rc, "
    "k - (k - 1) * (k - 1) / (n - 1) AS kc FROM stats) t",
    "frame",
    listed=" UNION ALL ".join(
        f"SELECT client_id, {i} AS place, '{c}' AS feature, CAST({c} AS VARCHAR) AS v, "
        f"{c in TEXT} AS is_text FROM frame WHERE {c} IS NOT NULL"
        for i, c in enumerate(_detectable)
    ),
    detected=(
        "SELECT feature FROM listed GROUP BY feature, is_text HAVING CASE WHEN is_text "
        "THEN count(DISTINCT v) < 100 ELSE bool_and(TRY_CAST(v AS DOUBLE) IN (0, 1)) END"
    ),
    kept="SELECT * FROM listed WHERE feature IN (SELECT feature FROM detected)",
    cells=(
        "SELECT a.feature AS feature_1, b.feature AS feature_2, a.v AS v1, b.v AS v2, "
        "CAST(count(*) AS DOUBLE) AS o FROM kept a JOIN kept b ON a.client_id = b.client_id "
        "AND a.place <= b.place GROUP BY ALL"
    ),
    margins=(
        "SELECT *, sum(o) OVER (PARTITION BY feature_1, feature_2, v1) AS ro, "
        "sum(o) OVER (PARTITION BY feature_1, feature_2, v2) AS co, "
        "sum(o) OVER (PARTITION BY feature_1, feature_2) AS n FROM cells"
    ),
    stats=(
        "SELECT feature_1, feature_2, CAST(count(DISTINCT v1) AS DOUBLE) AS r, "
        "CAST(count(DISTINCT v2) AS DOUBLE) AS k, max(n) AS n, "
        "(sum((o - ro * co / n) * (o - ro * co / n) / (ro * co / n)) + max(n) "
        "- sum(ro * co / n)) / max(n) AS phi2 FROM margins GROUP BY feature_1, feature_2"
    ),
)


def association_ctes(arm: str) -> dict[str, str]:
    """Association of every audit feature with the response, per value of ``arm``."""
    numeric = " UNION ALL ".join(
        f"SELECT {arm} AS arm, target AS y, '{c}' AS feature, CAST({c} AS DOUBLE) AS v "
        f"FROM audit WHERE {c} IS NOT NULL"
        for c in AUDIT_NUMERIC
    )
    levels = " UNION ALL ".join(
        f"SELECT {arm} AS arm, target AS y, '{c}' AS feature, {c} AS level FROM audit"
        for c in AUDIT_TEXT
    )
    auc = (
        "SELECT arm, feature, sum(neg * (pos_run - pos / 2.0)) / "
        "(sum(pos) * CAST(sum(neg) AS DOUBLE)) AS auc FROM "
        "(SELECT *, sum(pos) OVER (PARTITION BY arm, feature ORDER BY v DESC) AS pos_run FROM "
        "(SELECT arm, feature, v, sum(y) AS pos, sum(1 - y) AS neg FROM {source} GROUP BY ALL) g) c"
        " GROUP BY arm, feature"
    )
    return {
        "numbers": numeric,
        "moments": (
            "SELECT arm, feature, CASE WHEN isfinite(corr(v, y)) THEN corr(v, y) END AS r0, "
            "avg(v) FILTER (y = 0) AS m0, avg(v) FILTER (y = 1) AS m1, "
            "var_samp(v) FILTER (y = 0) AS v0, var_samp(v) FILTER (y = 1) AS v1, "
            "bool_and(v IN (0, 1)) AS is_flag FROM numbers GROUP BY arm, feature"
        ),
        "number_auc": auc.format(source="numbers"),
        "number_rows": (
            "SELECT arm, feature, CASE WHEN is_flag THEN 'binary' ELSE 'numeric' END AS kind, "
            "CASE WHEN is_flag THEN coalesce(r0, 0) ELSE r0 END AS r, auc, "
            f"{SMD} AS smd, CAST(NULL AS DOUBLE) AS eta2 "
            "FROM moments JOIN number_auc USING (arm, feature)"
        ),
        "texts": levels,
        "level_sizes": (
            "SELECT arm, feature, level, CAST(count(*) AS DOUBLE) / (sum(count(*)) FILTER "
            "(level IS NOT NULL) OVER (PARTITION BY arm, feature)) AS share "
            "FROM texts GROUP BY arm, feature, level"
        ),
        "folded": (
            "SELECT t.arm, t.feature, t.y, CASE WHEN t.level IS NULL THEN 'nan' "
            "WHEN share < 0.005 THEN 'RARE' ELSE t.level END AS level FROM texts t "
            "JOIN level_sizes s ON t.arm = s.arm AND t.feature = s.feature "
            "AND t.level IS NOT DISTINCT FROM s.level"
        ),
        "encoded": (
            "SELECT arm, feature, y, avg(y) OVER (PARTITION BY arm, feature, level) AS v, "
            "avg(y) OVER (PARTITION BY arm, feature) AS mu FROM folded"
        ),
        "level_auc": auc.format(source="encoded"),
        "level_rows": (
            "SELECT e.arm, e.feature, 'categorical' AS kind, CAST(NULL AS DOUBLE) AS r, "
            "max(auc) AS auc, CAST(NULL AS DOUBLE) AS smd, "
            "sum((v - mu) * (v - mu)) / sum((y - mu) * (y - mu)) AS eta2 "
            "FROM encoded e JOIN level_auc a ON e.arm = a.arm AND e.feature = a.feature "
            "GROUP BY e.arm, e.feature"
        ),
        "scaled": (
            "SELECT arm, feature, kind, coalesce(abs(r), eta2) AS score, r AS sign, auc, "
            "abs(auc - 0.5) * 2 AS auc_norm, smd, "
            "CASE WHEN smd IS NOT NULL THEN least(abs(smd) / 0.8, 1.0) END AS smd_norm, eta2 "
            "FROM (SELECT * FROM number_rows UNION ALL SELECT * FROM level_rows) u"
        ),
        "summary": (
            "SELECT *, (coalesce(score, 0) + coalesce(auc_norm, 0) + coalesce(smd_norm, 0)) / "
            "nullif(CAST(score IS NOT NULL AS INTEGER) + CAST(auc_norm IS NOT NULL AS INTEGER) "
            "+ CAST(smd_norm IS NOT NULL AS INTEGER), 0) AS combined FROM scaled"
        ),
    }


ORACLES["association"] = with_ctes(
    "SELECT feature, kind, "
    + ", ".join(
        f"{r(c)} AS {c}"
        for c in ("score", "sign", "auc", "auc_norm", "smd", "smd_norm", "eta2", "combined")
    )
    + " FROM summary",
    "audit",
    **association_ctes("0"),
)
ORACLES["association_cat"] = with_ctes(
    f"SELECT feature, {r('eta2')} AS eta2, {r('auc')} AS auc FROM level_rows",
    "audit",
    **association_ctes("0"),
)
_compared = (
    "SELECT a.feature, a.kind, a.combined AS combined_t0, b.combined AS combined_t1, "
    "b.combined - a.combined AS delta FROM summary a JOIN summary b ON a.feature = b.feature "
    "WHERE a.arm = 0 AND b.arm = 1"
)
COMPARED = (
    f"feature, kind, {r('combined_t0')} AS combined_t0, {r('combined_t1')} AS combined_t1, "
    f"{r('delta')} AS delta"
)
ORACLES["association_by_arm"] = with_ctes(
    f"SELECT {COMPARED} FROM compared",
    "audit",
    **association_ctes("treatment_flg"),
    compared=_compared,
)
ORACLES["top_features"] = with_ctes(
    f"SELECT {COMPARED}, 'rising' AS side FROM (SELECT * FROM compared "
    "ORDER BY compared.delta DESC, compared.feature LIMIT 10) a UNION ALL "
    f"SELECT {COMPARED}, 'falling' AS side FROM (SELECT * FROM compared "
    "ORDER BY compared.delta, compared.feature DESC LIMIT 10) b",
    "audit",
    **association_ctes("treatment_flg"),
    compared=_compared,
)

# --- ranking ---------------------------------------------------------------------------

ORDER = "ORDER BY uplift DESC, client_id"
RANKED = (
    f"SELECT *, row_number() OVER ({ORDER}) AS position, count(*) OVER () AS n_rows, "
    f"ntile(10) OVER ({ORDER}) AS bin FROM scores"
)
ORACLES["rank_clients"] = with_ctes(
    "SELECT client_id, uplift, position FROM ranked", "scores", ranked=RANKED
)


def _gain_ctes(score: str, label: str) -> dict[str, str]:
    """Curve points and areas for one score expression."""
    return {
        f"{label}_groups": (
            f"SELECT {score} AS s, sum(treatment_flg) AS t, sum(1 - treatment_flg) AS c, "
            "sum(treatment_flg * target) AS yt, sum((1 - treatment_flg) * target) AS yc "
            "FROM scored GROUP BY 1"
        ),
        f"{label}_points": (
            "SELECT sum(t) OVER w AS nt, sum(c) OVER w AS nc, sum(yt) OVER w AS yt, "
            f"sum(yc) OVER w AS yc, s FROM {label}_groups WINDOW w AS (ORDER BY s DESC)"
        ),
        f"{label}_curves": (
            "SELECT s, CAST(nt + nc AS DOUBLE) AS n, "
            f"({div('yt', 'nt')} - {div('yc', 'nc')}) * (nt + nc) AS auuc, "
            f"yt - yc * {div('nt', 'nc')} AS qini FROM {label}_points"
        ),
        f"{label}_areas": (
            "SELECT "
            + ", ".join(
                f"sum((n - n0) * ({c} + {c}0) / 2) AS {c}, max_by({c}, n) AS {c}_end"
                for c in ("auuc", "qini")
            )
            + ", max(n) AS n FROM (SELECT *, lag(n, 1, 0) OVER o AS n0, "
            "lag(auuc, 1, 0) OVER o AS auuc0, lag(qini, 1, 0) OVER o AS qini0 "
            f"FROM {label}_curves WINDOW o AS (ORDER BY s DESC)) l"
        ),
    }


SCORED = {
    "scored": (
        "SELECT *, (SELECT count(*) FILTER (target = 1 AND treatment_flg = 0) > "
        "count(*) FILTER (target = 0 AND treatment_flg = 1) FROM scores) AS response_first "
        "FROM scores"
    )
}
IDEAL_AUUC = (
    "2 * CAST(target = treatment_flg AS INTEGER) + "
    "CASE WHEN response_first THEN target ELSE treatment_flg END"
)
IDEAL_QINI = "target * treatment_flg - target * (1 - treatment_flg)"
for _curve, _ideal in (("auuc", IDEAL_AUUC), ("qini", IDEAL_QINI)):
    _diag = f"p.{_curve}_end * p.n / 2"
    _key = "auuc" if _curve == "auuc" else "qini_auc"
    ORACLES[_key] = with_ctes(
        "SELECT "
        + r(f"(a.{_curve} - {_diag}) / (p.{_curve} - {_diag})", 9)
        + f" AS {_curve} FROM actual_areas a, perfect_areas p",
        "scores",
        **SCORED,
        **_gain_ctes("uplift", "actual"),
        **_gain_ctes(_ideal, "perfect"),
    )
ORACLES["perfect_curve"] = with_ctes(
    " UNION ALL ".join(
        f"SELECT '{c}' AS curve, 'perfect' AS line, CAST(n AS BIGINT) AS n, {r(c)} AS gain "
        f"FROM {c}_ideal_curves UNION ALL SELECT '{c}', 'random', CAST(n AS BIGINT), "
        f"{r(f'{c}_end')} FROM {c}_ideal_areas"
        for c in ("auuc", "qini")
    ),
    "scores",
    **SCORED,
    **_gain_ctes(IDEAL_AUUC, "auuc_ideal"),
    **_gain_ctes(IDEAL_QINI, "qini_ideal"),
)


def _rate(arm: int, condition: str = "true") -> str:
    return f"avg(target) FILTER (treatment_flg = {arm} AND {condition})"


def _top(k: float) -> str:
    head = f"position <= floor(n_rows * CAST({k} AS DOUBLE))"
    return r(f"{_rate(1, head)} - {_rate(0, head)}")


ORACLES["uplift_at_k"] = with_ctes(
    "SELECT "
    + ", ".join(f"{_top(k)} AS uplift_at_{round(k * 100)}" for k in (0.1, 0.2, 0.3, 0.5))
    + " FROM ranked",
    "scores",
    ranked=RANKED,
)
DECILES = (
    "SELECT CAST(bin AS INTEGER) AS bin, CAST(sum(treatment_flg) AS BIGINT) AS n_treated, "
    "CAST(sum(1 - treatment_flg) AS BIGINT) AS n_control, "
    f"{_rate(1)} AS rate_treated, {_rate(0)} AS rate_control, {_rate(1)} - {_rate(0)} AS bin_uplift "
    "FROM ranked GROUP BY bin"
)
ORACLES["uplift_deciles"] = with_ctes(
    "SELECT * REPLACE ("
    + ", ".join(f"{r(c)} AS {c}" for c in ("rate_treated", "rate_control", "bin_uplift"))
    + ") FROM deciles",
    "scores",
    ranked=RANKED,
    deciles=DECILES,
)
ORACLES["weighted_avg_uplift"] = with_ctes(
    "SELECT CASE WHEN count(*) = count(bin_uplift) "
    f"THEN {r('sum(bin_uplift * n_treated) / sum(n_treated)')} END AS wau FROM deciles",
    "scores",
    ranked=RANKED,
    deciles=DECILES,
)
RUNNING = (
    "SELECT position, CAST(position AS DOUBLE) / n_rows AS fraction, "
    "sum(treatment_flg) OVER w AS nt, sum(1 - treatment_flg) OVER w AS nc, "
    "sum(treatment_flg * target) OVER w AS yt, sum((1 - treatment_flg) * target) OVER w AS yc, "
    "sum(treatment_flg) OVER () AS all_t, sum(1 - treatment_flg) OVER () AS all_c "
    "FROM ranked WINDOW w AS (ORDER BY position)"
)
ORACLES["qini_curve"] = with_ctes(
    f"SELECT position, {r('fraction')} AS fraction, "
    f"{r('yt - yc * (CAST(all_t AS DOUBLE) / all_c)')} AS qini FROM running",
    "scores",
    ranked=RANKED,
    running=RUNNING,
)
ORACLES["uplift_curve"] = with_ctes(
    f"SELECT position, {r('fraction')} AS fraction, "
    + r(
        "coalesce(d, last_value(d IGNORE NULLS) OVER (ORDER BY position), "
        "first_value(d IGNORE NULLS) OVER (ORDER BY position ROWS BETWEEN CURRENT ROW "
        "AND UNBOUNDED FOLLOWING), 0)"
    )
    + " AS uplift_curve FROM (SELECT *, yt / CAST(nullif(nt, 0) AS DOUBLE) "
    "- yc / CAST(nullif(nc, 0) AS DOUBLE) AS d FROM running) x",
    "scores",
    ranked=RANKED,
    running=RUNNING,
)
ROC = {
    "groups": (
        "SELECT uplift AS threshold, sum(target) AS pos, sum(1 - target) AS neg "
        "FROM scores GROUP BY uplift"
    ),
    "points": (
        "SELECT *, sum(pos) OVER w AS pos_run, sum(neg) OVER w AS neg_run, "
        "CAST(sum(pos) OVER () AS DOUBLE) AS pos_all, CAST(sum(neg) OVER () AS DOUBLE) AS neg_all "
        "FROM groups WINDOW w AS (ORDER BY threshold DESC)"
    ),
}
ORACLES["roc_auc"] = with_ctes(
    f"SELECT {r('sum(neg * (pos_run - pos / 2.0)) / max(pos_all * neg_all)', 9)} AS auc "
    "FROM points",
    "scores",
    **ROC,
)
ORACLES["roc_curve"] = with_ctes(
    f"SELECT {r('threshold')} AS threshold, {r('neg_run / neg_all')} AS fpr, "
    f"{r('pos_run / pos_all')} AS tpr FROM points",
    "scores",
    **ROC,
)
ORACLES["uplift_by_segment"] = with_ctes(
    f"SELECT gender, count(v) AS count, {r('avg(v)', 4)} AS mean, {r('stddev_samp(v)', 4)} AS std, "
    f"min(v) AS min, max(v) AS max, {r('median(v)', 4)} AS median FROM (SELECT gender, "
    f"{r('uplift * 100', 4)} AS v FROM clients LEFT JOIN scores USING (client_id)) m "
    "WHERE gender IS NOT NULL GROUP BY gender",
    "clients",
    "scores",
)

# --- splits ----------------------------------------------------------------------------


def _split(strata: str, borders: dict[str, str], last: str, out: str) -> str:
    """The first rows of each stratum by hash and key, up to the given cumulative shares."""
    label = " ".join(
        f"WHEN place <= floor(total * {share} + 0.5) THEN {name}" for name, share in borders.items()
    )
    return with_ctes(
        f"SELECT client_id, treatment_flg, target, CASE {label} ELSE {last} END AS {out} FROM placed",
        "campaign",
        placed=(
            "SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY hash, CAST(client_id AS VARCHAR)) "
            "AS place, count(*) OVER (PARTITION BY stratum) AS total FROM "
            f"(SELECT *, {strata} AS stratum, md5('42:' || CAST(client_id AS VARCHAR)) AS hash FROM campaign) h"
        ),
    )


PAIR = "CAST(treatment_flg AS VARCHAR) || '_' || CAST(target AS VARCHAR)"
ORACLES["stratified_split"] = _split(PAIR, {"'test'": "CAST(0.3 AS DOUBLE)"}, "'train'", "part")
ORACLES["stratified_split_3way"] = _split(
    PAIR,
    {"'test'": "CAST(0.2 AS DOUBLE)", "'validation'": "CAST(0.4 AS DOUBLE)"},
    "'train'",
    "part",
)
_third = "(CAST(1 AS DOUBLE) / 3)"
ORACLES["kfold_assign"] = _split(
    "CAST(target AS VARCHAR)", {"0": _third, "1": f"({_third} + {_third})"}, "2", "fold"
)

ORACLES["stratified_split_target"] = _split(
    "CAST(target AS VARCHAR)", {"'test'": "CAST(0.2 AS DOUBLE)"}, "'train'", "part"
)

# Every request holds one valid line, so all of them are scored.
ORACLES["score_stream"] = with_ctes(
    "SELECT client_id, 200 AS status_code, true AS own, true AS usable, true AS told FROM purchases",
    "purchases",
)

# --- what SQL can state about fitted models --------------------------------------------

LEARNERS = ("t_learner", "s_learner", "x_learner", "baseline")


def _tested(*models: str) -> str:
    """The test clients once per model, with usable scores that vary."""
    rows = " UNION ALL ".join(
        f"SELECT client_id, '{m}' AS model, treatment_flg, target, true AS usable, "
        "true AS scores_vary FROM parted WHERE part = 'test'" for m in models
    )
    return f"WITH parted AS ({ORACLES['stratified_split']}) {rows}"


for _model in LEARNERS:
    _name = "baseline_response" if _model == "baseline" else _model
    ORACLES[_name] = _tested(_model)
ORACLES["t_learner_candidates"] = _tested("logreg", "forest", "boosted")
ORACLES["model_comparison"] = (
    f"SELECT model, count(*) AS n, true AS scores_vary, true AS measured "
    f"FROM ({_tested(*LEARNERS)}) GROUP BY model"
)
ORACLES["tune_t_learner"] = (
    "SELECT CAST(i AS INTEGER) AS trial, 'logreg' AS family, true AS in_range, true AS measured, "
    "true AS refitted FROM range(10) t(i)"
)
ORACLES["tune_x_learner"] = (
    "SELECT CAST(0 AS INTEGER) AS trial, true AS in_range, true AS measured, true AS refitted"
)
ORACLES["propensity"] = with_ctes(
    "SELECT count(*) AS n, round_even(avg(treatment_flg), 3) AS mean_score, true AS usable, "
    f"count(*) >= {20 * len(AUDIT_FEATURES)} AS enough_clients, true AS arms_look_random FROM audit",
    "audit",
)
ORACLES["propensity_histogram"] = with_ctes(
    "SELECT count(*) AS n, true AS inside FROM audit", "audit"
)


def _features(columns: str, without: tuple[str, ...] = ()) -> str:
    names = ", ".join(f"('{f}')" for f in MODEL_FEATURES if f not in without)
    return f"SELECT feature, {columns} FROM (VALUES {names}) t(feature)"


ORACLES["importance_t"] = _features("true AS usable", ("gender",))
ORACLES["importance_tree"] = _features("true AS fine, true AS sums_to_one")
ORACLES["importance_x"] = _features("true AS fine, true AS sums_to_one")
_SUMS = ", ".join(f"true AS {m}_sums_to_one" for m in (*LEARNERS, "mean_importance"))
ORACLES["importance_table"] = (
    f"{_features(_SUMS)} UNION ALL SELECT 'treatment_flg' AS feature, {_SUMS}"
)
ORACLES["train_job"] = _features("true AS survives_saving", ("gender",))
ORACLES["score_batch"] = with_ctes(
    "SELECT client_id, true AS usable, true AS survives_saving FROM clients", "clients"
)
