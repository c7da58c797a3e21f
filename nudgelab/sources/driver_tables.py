"""Campaign tables derived from the order/customer tables used for checks.

Each table is a set of plain SQL expressions, so the same text defines the
Spark frame (``selectExpr``) and the view the SQL check runs on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ID_HASH = "((c_custkey+1)*1103515245+12345)%2147483648"

CLIENT_EXPRESSIONS = {
    "client_id": "c_custkey",
    "first_issue_date": "d - INTERVAL '1' DAY * CAST(c_custkey % 200 AS INT)",
    "first_redeem_date": (
        "CASE WHEN c_custkey % 11 = 0 THEN NULL "
        "ELSE d + INTERVAL '1' HOUR * CAST((c_custkey*31) % 4000 AS INT) END"
    ),
    "age": (
        "CASE WHEN c_custkey % 97 = 5 THEN 1852 WHEN c_custkey % 89 = 7 THEN -7491 "
        "ELSE CAST(floor(c_acctbal/80) AS INT) END"
    ),
    "gender": (
        "CASE c_mktsegment WHEN 'MACHINERY' THEN 'M' WHEN 'BUILDING' THEN 'F' ELSE 'U' END"
    ),
}

ARM = f"CAST(floor(({ID_HASH})/65536) AS BIGINT) % 2"
RESPONSE_DRAW = f"CAST(floor(({ID_HASH})/1024) AS BIGINT) % 100"
CAMPAIGN_FILTER = "c_custkey % 10 <> 3"

CAMPAIGN_EXPRESSIONS = {
    "client_id": "c_custkey",
    "treatment_flg": f"CAST({ARM} AS INT)",
    "target": f"CASE WHEN {RESPONSE_DRAW} < 60 + 4*({ARM}) THEN 1 ELSE 0 END",
}

PURCHASE_EXPRESSIONS = {
    "client_id": "o_custkey",
    "transaction_id": "o_orderkey",
    "transaction_datetime": (
        "o_orderdate + INTERVAL '1' MINUTE * CAST((o_orderkey*37) % 1440 AS INT)"
    ),
    "regular_points_received": "CAST(floor(o_totalprice/1000) AS DOUBLE)",
    "express_points_received": "CASE WHEN o_orderstatus='P' THEN 10.0E0 ELSE 0.0E0 END",
    "regular_points_spent": (
        "CASE WHEN o_orderkey % 5 = 0 THEN -1.0E0*floor(o_totalprice/5000) ELSE 0.0E0 END"
    ),
    "express_points_spent": "CASE WHEN o_orderkey % 7 = 0 THEN -10.0E0 ELSE 0.0E0 END",
    "purchase_sum": "o_totalprice",
    "store_id": "CASE WHEN o_orderkey % 4 < 3 THEN o_custkey % 50 ELSE o_orderkey % 50 END",
    "product_id": "l_partkey",
    "product_quantity": "l_quantity",
    "trn_sum_from_iss": "l_extendedprice",
    "trn_sum_from_red": (
        "CASE WHEN l_returnflag='R' THEN l_extendedprice*(1-l_discount) ELSE NULL END"
    ),
}

SCORE_EXPRESSION = "floor((((client_id+1)*1597334677)%2147483648)/2097152)/1000"

REQUEST_LOG_EXPRESSIONS = {
    "id": "event_id",
    "ts": "ts",
    "processing_time": "value",
    "input_size": "CAST(length(props) AS BIGINT)",
    "status_code": (
        "CASE WHEN event_type='error' THEN 403 WHEN event_type='signup' THEN 400 ELSE 200 END"
    ),
    "input_data": "props",
}


def _select(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{sql} AS {name}" for name, sql in expressions.items()))


# Declared, so that opening a table starts no schema-reading job.
TABLE_SCHEMAS = {
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
}


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def clients(spark: SparkSession, folder: str) -> DataFrame:
    """One row per client that has an order."""
    first_order = (
        _read(spark, folder, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("d"))
    )
    customer = _read(spark, folder, "customer")
    joined = customer.join(first_order, F.col("c_custkey") == F.col("o_custkey"))
    return _select(joined, CLIENT_EXPRESSIONS)


def campaign(spark: SparkSession, folder: str) -> DataFrame:
    """Arm and response of the clients in the experiment."""
    return _select(_read(spark, folder, "customer").where(CAMPAIGN_FILTER), CAMPAIGN_EXPRESSIONS)


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """One row per product line, transaction columns repeated on each."""
    lines = _read(spark, folder, "lineitem")
    orders = _read(spark, folder, "orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return _select(joined, PURCHASE_EXPRESSIONS)


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed score per experiment client, with ties, next to arm and response."""
    return campaign(spark, folder).selectExpr(
        "client_id", f"CAST({SCORE_EXPRESSION} AS DOUBLE) AS uplift", "treatment_flg", "target"
    )


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """One row per scoring request."""
    return _select(_read(spark, folder, "events"), REQUEST_LOG_EXPRESSIONS)


def view_sql() -> dict[str, str]:
    """The same five tables as SQL over the raw views."""

    def projection(expressions: dict[str, str]) -> str:
        return ", ".join(f"{sql} AS {name}" for name, sql in expressions.items())

    return {
        "clients": (
            f"SELECT {projection(CLIENT_EXPRESSIONS)} FROM customer JOIN (SELECT o_custkey, "
            "min(o_orderdate) AS d FROM orders GROUP BY o_custkey) fo ON c_custkey = fo.o_custkey"
        ),
        "campaign": (
            f"SELECT {projection(CAMPAIGN_EXPRESSIONS)} FROM customer WHERE {CAMPAIGN_FILTER}"
        ),
        "purchases": (
            f"SELECT {projection(PURCHASE_EXPRESSIONS)} "
            "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
        ),
        "scores": (
            f"SELECT client_id, CAST({SCORE_EXPRESSION} AS DOUBLE) AS uplift, treatment_flg, "
            "target FROM campaign"
        ),
        "request_log": f"SELECT {projection(REQUEST_LOG_EXPRESSIONS)} FROM events",
    }
