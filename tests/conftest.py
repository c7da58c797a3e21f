"""Shared local session and the two-client request used across tests."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="nudgelab-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture(scope="session")
def request_rows():
    """Two clients and three lines: a shared transaction id, no redeem date, a zero amount."""
    clients = [
        {"client_id": 123, "age": 35, "gender": "F", "first_issue_date": "2022-01-10",
         "first_redeem_date": None},
        {"client_id": 555, "age": 42, "gender": "M", "first_issue_date": "2021-05-15",
         "first_redeem_date": "2021-06-20"},
    ]

    def line(client, tx, at, amount, store, got, express, gave, product, quantity):
        return {
            "client_id": client, "transaction_id": tx, "transaction_datetime": at,
            "purchase_sum": amount, "store_id": store, "regular_points_received": got,
            "express_points_received": express, "regular_points_spent": gave,
            "express_points_spent": 0, "product_id": product, "product_quantity": quantity,
            "trn_sum_from_iss": amount, "trn_sum_from_red": 0,
        }

    purchases = [
        line(123, 1, "2024-02-01 12:30:00", 540, "54a4a11a29", 20, 0, 0, "9a80204f78", 2),
        line(123, 2, "2024-02-02 15:45:00", 1200, "b2c3d4e5f6", 48, 10, 0, "1b2c3d4e5f", 3),
        line(555, 1, "2024-02-01 12:30:00", 340, "54a4a11a29", 12, 0, 5, "9a80204f78", 1),
    ]
    return {"client": clients, "purchases": purchases}
