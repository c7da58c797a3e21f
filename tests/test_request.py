"""Hand-computed features of the two-client request, through the JSON source."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from nudgelab.operators import age as A
from nudgelab.operators import clean as C
from nudgelab.operators import client_aggregates as G
from nudgelab.plans import features as P
from nudgelab.sources import files


@pytest.fixture(scope="module")
def parsed(spark, request_rows):
    texts = [
        (1, json.dumps(request_rows)),
        (2, "not json"),
        (3, json.dumps({"client": [{"age": 3}], "purchases": [{"client_id": 1}]})),
        (4, json.dumps({"client": [{"client_id": 1}]})),
        (6, json.dumps({"client": [{"client_id": 1}], "purchases": []})),
        (7, json.dumps({"client": [{"client_id": "x1"}], "purchases": [{"client_id": "x1"}]})),
        (5, json.dumps({
            "client": [{"client_id": 1}],
            "purchases": [{"client_id": 1, "transaction_datetime": "yesterday"}],
        })),
    ]
    return files.parse_requests(spark.createDataFrame(texts, "id long, input_data string"))


def test_request_status(parsed):
    status = {r["id"]: r["status_code"] for r in parsed.collect()}
    assert status == {1: 200, 2: 400, 3: 400, 4: 400, 5: 403, 6: 400, 7: 403}


def test_request_features(parsed):
    clients, lines = files.request_clients(parsed), files.request_purchases(parsed)
    rows = {r["client_id"]: r for r in P.scoring_features(clients, lines).collect()}
    assert set(rows) == {123, 555}
    a, b = rows[123], rows[555]
    assert a["total_transactions"] == 2 and b["total_transactions"] == 1
    assert a["avg_transaction_amount"] == 870.0
    assert a["transaction_period_days"] == 1 and b["transaction_period_days"] == 0
    assert a["store_loyalty_ratio"] == 0.5 and b["store_loyalty_ratio"] == 1.0
    assert a["points_balance_ratio"] == 78.0 and b["points_balance_ratio"] == 2.0
    assert (a["is_super_loyal"], b["is_super_loyal"]) == (0, 1)
    assert (a["is_activated"], b["is_activated"]) == (0, 1)
    assert a["seasonal_quarter_code"] == 1
    assert a["first_transaction_quarter"] == "2024Q1"
    assert len(a) == 1 + len(P.MODEL_FEATURES)


def test_wide_request_features(parsed):
    clients, lines = files.request_clients(parsed), files.request_purchases(parsed)
    rows = P.scoring_features(clients, lines, drop_redundant=False).collect()
    a = next(r for r in rows if r["client_id"] == 123)
    assert a["most_frequent_store"] == "54a4a11a29" and a["redeem_lag_days"] == 0
    assert a["transaction_amount_q0.25"] == 705.0 and a["std_transaction_amount"] == 466.690476
    b = next(r for r in rows if r["client_id"] == 555)
    assert b["redeem_lag_days"] == 36 and b["std_transaction_amount"] == 0.0


def test_habits_and_spread(parsed):
    lines = C.clean_purchases(files.request_purchases(parsed))
    tx = G.transactions(lines)
    habits = {r["client_id"]: r for r in G.transaction_features(tx, habits=True).collect()}
    assert habits[123]["most_frequent_store"] == "54a4a11a29"  # tie: the smallest
    assert habits[123]["most_frequent_weekday"] == 3  # Thursday before Friday
    assert habits[123]["most_frequent_hour"] == 12
    assert habits[123]["total_purchase_sum"] == 1740.0
    spread = {r[0]: r[1] for r in G.amount_spread(tx).collect()}
    assert spread[555] is None and spread[123] == pytest.approx(466.690476, abs=1e-6)


def test_zero_redeemed_amount_is_not_missing(parsed):
    lines = C.clean_purchases(files.request_purchases(parsed))
    assert lines.agg(F.sum("trn_sum_from_red")).first()[0] == 0.0


def test_client_without_purchases_keeps_its_row(spark, parsed):
    clients = files.request_clients(parsed)
    extra = clients.where("client_id = 123").withColumn("client_id", F.lit(9).cast("long"))
    lines = files.request_purchases(parsed)
    row = P.scoring_features(clients.unionByName(extra), lines).where("client_id = 9").first()
    assert row["total_transactions"] == 0 and row["seasonal_quarter_code"] == 0
    assert row["first_transaction_quarter"] is None


def test_missing_key_column_is_rejected(spark):
    with pytest.raises(ValueError, match="client_id"):
        C.require_columns(spark.range(1), "client_id")


def test_age_rule(spark):
    ages = [-7491, 3, 15, 20, 30, 40, 50, 100, 150, 200, 201, 1852, None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "client_id long, age int")
    stats = A.age_stats(df).first()
    valid = [15, 20, 30, 40, 50, 100]
    assert (stats["age_q1"], stats["age_q3"]) == (22.5, 47.5)
    assert stats["mean_low"] == 17.5 and stats["mean_high"] == 75.0
    mean = sum(valid) / len(valid)
    model = A.AgeImputer().fit(df)
    expected = [17.5, 17.5, *map(float, valid), 75.0, 75.0, mean, mean, mean]
    lazy = A.impute_age(df, A.age_stats(df)).orderBy("client_id")
    for fixed in (model.transform(df).orderBy("client_id"), lazy):
        assert [r["age"] for r in fixed.collect()] == pytest.approx(expected)


def test_age_model_survives_saving(spark, tmp_path):
    df = spark.createDataFrame([(a,) for a in (20, 30, 40, 900)], "age int")
    model = A.AgeImputer().fit(df)
    model.write().overwrite().save(str(tmp_path / "ages"))
    again = A.AgeImputerModel.load(str(tmp_path / "ages"))
    assert again.transform(df).collect() == model.transform(df).collect()
    single = A.AgeImputer().fit(spark.createDataFrame([(33,)], "age int"))
    assert single.as_frame(spark).first()["mean_high"] == 33.0
