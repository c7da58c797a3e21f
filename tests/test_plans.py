"""Physical plans stay distributed, and hot clients do not gather in one task."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from nudgelab.operators import clean as C
from nudgelab.operators import client_aggregates as G
from nudgelab.plans import features as P
from nudgelab.session import discard, materialize
from nudgelab.sources import driver_tables as D


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, folder):
    return D.clients(spark, folder), D.campaign(spark, folder), D.purchases(spark, folder)


def test_feature_plan(spark, tables):
    plan = plan_of(P.client_features(*tables))
    # Only the one-row age statistics may meet in one partition.
    for line in plan.splitlines():
        if "SinglePartition" in line:
            following = plan.split(line, 1)[1].splitlines()[1]
            assert "partial_sum" in following or "partial_percentile" in following
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "SortAggregate" not in plan


def test_scan_reads_only_needed_columns(spark, tables):
    plan = plan_of(P.client_features(*tables))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    lines = [s for s in scans if "l_orderkey" in s]
    assert lines and all("l_tax" not in s and "l_shipdate" not in s for s in lines)


def test_no_raw_rows_are_shuffled_by_client_alone(spark, tables):
    """Every exchange on the client is above a per-client partial aggregate."""
    tx = G.transactions(C.clean_purchases(tables[2]))
    plan = plan_of(G.transaction_features(tx)).splitlines()
    for i, line in enumerate(plan):
        if re.search(r"Exchange hashpartitioning\(client_id#\d+L?, \d+\)", line):
            assert re.search(r"HashAggregate\(keys=\[client_id#\d+L?\], functions=\[partial", plan[i + 1])


def test_one_client_with_most_of_the_log(spark):
    """Whole results for a client holding most lines, checked against plain sums."""
    log = spark.range(60000).select(
        F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 50 + 2).cast("long")
        .alias("client_id"),
        (F.col("id") / 3).cast("long").alias("transaction_id"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + INTERVAL '1' MINUTE * CAST(id / 3 AS INT)")
        .alias("transaction_datetime"),
        *(F.lit(1.0).alias(c) for c in G.POINTS),
        ((F.col("id") / 3).cast("long") % 97).cast("double").alias("purchase_sum"),
        ((F.col("id") / 3).cast("long") % 11).alias("store_id"),
        (F.col("id") % 1000).alias("product_id"),
        F.lit(2.0).alias("product_quantity"),
        F.lit(3.0).alias("trn_sum_from_iss"),
        F.lit(None).cast("double").alias("trn_sum_from_red"),
    )
    got = P.behaviour(log).where("client_id = 1").first()
    mine = log.where("client_id = 1").toPandas()
    tx = mine.drop_duplicates("transaction_id")
    assert got["total_transactions"] == len(tx)
    assert got["total_purchase_sum"] == tx["purchase_sum"].sum()
    assert got["unique_products_count"] == mine["product_id"].nunique()
    assert got["total_trn_sum_from_red"] == 3.0 * len(mine)
    share = tx["store_id"].value_counts().iloc[0] / len(tx)
    assert got["store_loyalty_ratio"] == pytest.approx(share)
    quartiles = G.amount_quantiles(G.transactions(log)).where("client_id = 1").first()
    expected = tx["purchase_sum"].quantile([0.25, 0.5, 0.75]).tolist()
    assert list(quartiles)[1:] == pytest.approx(expected)


def test_discarded_tables_are_gone(spark, tmp_path):
    """Only tables of the library are removed."""
    table = materialize(spark.range(10))
    folder = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(folder)
    discard(table)
    assert not os.path.exists(folder)
    spark.range(3).write.parquet(str(tmp_path / "own"))
    with pytest.raises(ValueError, match="not a table"):
        discard(spark.read.parquet(str(tmp_path / "own")))
    assert (tmp_path / "own").is_dir()
