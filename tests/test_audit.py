"""Association, balance and profile edge cases."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import queries
from nudgelab.operators import association as L
from nudgelab.operators import experiment as E
from nudgelab.operators import profiling as Q
from nudgelab.operators import segments, split
from nudgelab.operators.levels import bounded_levels


def test_balance_ignores_arm_names(spark):
    rows = [(i % 2, float(i % 7 + 2 * (i % 2)), "xyz"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "treatment_flg int, a double, g string")
    swapped = df.withColumn("treatment_flg", 1 - F.col("treatment_flg"))
    first, second = ({r["feature"]: r["abs_smd"] for r in E.balance(x).collect()}
                     for x in (df, swapped))
    assert first == pytest.approx(second)
    assert set(first) == {"a", "g_x", "g_y", "g_z"}


def test_constant_features(spark):
    rows = [(i % 2, 1, 5.0, "same") for i in range(20)]
    df = spark.createDataFrame(rows, "target int, flag int, number double, word string")
    got = {r["feature"]: r for r in L.association(df, "target").collect()}
    assert got["flag"]["kind"] == "binary" and got["flag"]["sign"] == 0.0
    assert got["number"]["sign"] is None and got["number"]["smd"] is None
    assert got["number"]["auc"] == 0.5
    assert got["word"]["eta2"] == pytest.approx(0.0)


def test_rare_levels_fold(spark):
    rows = [("a", 1)] * 150 + [("b", 0)] * 147 + [("c", 1), ("d", 0), ("e", 1)]
    df = spark.createDataFrame(rows, "g string, target int")
    got = L.categorical_association(df, "target", ["g"], min_share=0.005).first()
    means = {"a": (150, 1.0), "b": (147, 0.0), "RARE": (3, 2 / 3)}
    mu = 152 / 300
    between = sum(n * (m - mu) ** 2 for n, m in means.values())
    assert got["eta2"] == pytest.approx(between / (300 * mu * (1 - mu)))


def test_cramers_v_limits(spark):
    rows = [(i % 2, i % 2, i % 3, 1) for i in range(600)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int")
    got = {(r["feature_1"], r["feature_2"]): r["v_cramer"]
           for r in L.cramers_v(df, ["a", "b", "c", "d"]).collect()}
    assert got["a", "b"] == pytest.approx(1.0, abs=1e-6)
    assert got["a", "c"] == pytest.approx(0.0, abs=1e-6)
    assert got["a", "d"] is None


def test_correlation_skips_incomplete_rows(spark):
    rows = [(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.5, 3.0), (None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["feature_1"], r["feature_2"]): r["corr"]
           for r in L.correlation_pairs(df).collect()}
    table = df.toPandas().corr()
    for (a, b), value in got.items():
        assert value == pytest.approx(table.loc[a, b])
    assert len(got) == 3


def test_significance_is_symmetric(spark):
    rows = [(t, int(i < k)) for t, k in ((0, 60), (1, 75)) for i in range(100)]
    df = spark.createDataFrame(rows, "treatment_flg int, target int")
    got = E.significance(df)
    assert got["z"] == pytest.approx(2.2645540682891911)
    assert got["p_z"] == pytest.approx(math.erfc(got["z"] / math.sqrt(2)))
    flipped = E.significance(df.withColumn("treatment_flg", 1 - F.col("treatment_flg")))
    assert flipped["z"] == pytest.approx(-got["z"])


def test_histogram_keeps_empty_bins_and_the_right_edge(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (1.0,), (None,)], "v double")
    bins = {r["bin"]: r["n"] for r in Q.histogram(df, "v", 4, 0.0, 1.0).collect()}
    assert bins == {0: 2, 1: 0, 2: 0, 3: 1}
    constant = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert sum(r["n"] for r in Q.histogram(constant, "v", 3).collect()) == 2


def test_distinct_profile(spark):
    rows = [(str(i), i % 2, i % 3, None if i else 1.0) for i in range(120)]
    df = spark.createDataFrame(rows, "many string, flag int, three int, one double")
    got = {r["column"]: (r["distinct_values"], r["is_categorical"])
           for r in Q.profile_distinct(df).collect()}
    assert got == {"many": (120, 0), "flag": (2, 1), "three": (3, 0), "one": (1, 1)}


def test_split_shares(spark):
    df = spark.range(20000).select(
        F.col("id").alias("client_id"),
        (F.col("id") % 2).cast("int").alias("treatment_flg"),
        (F.col("id") % 3 == 0).cast("int").alias("target"),
    )
    parts = split.three_way_split(df)
    shares = parts.groupBy("treatment_flg", "target", "part").count().collect()
    totals = {(r[0], r[1]): r["count"] for r in df.groupBy("treatment_flg", "target").count().collect()}
    for r in shares:
        wanted = {"test": 0.2, "validation": 0.2, "train": 0.6}[r["part"]]
        assert r["count"] / totals[r["treatment_flg"], r["target"]] == pytest.approx(wanted, abs=2e-3)
    assert parts.count() == 20000
    again = split.three_way_split(df.repartition(7))
    assert again.exceptAll(parts).count() == 0
    folds = split.assign_folds(df).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2]
    assert max(r["count"] for r in folds) - min(r["count"] for r in folds) < 20


def test_segments_leave_out_null_keys(spark):
    clients = spark.createDataFrame([("1", "F"), ("2", None), ("3", "F"), ("4", "M")],
                                    "client_id string, gender string")
    scores = spark.createDataFrame([(1, 0.1), (2, 0.5), (3, 0.3)], "client_id long, uplift double")
    got = {r["gender"]: r for r in segments.uplift_by_segment(clients, scores, ["gender"]).collect()}
    assert set(got) == {"F", "M"}
    assert got["F"]["count"] == 2 and got["F"]["median"] == 20.0
    assert got["M"]["count"] == 0 and got["M"]["median"] is None


def test_detector_feeds_cramers_v_with_the_issue_quarter(spark, folder):
    rows = queries.REGISTRY["cramers_v_detected"](spark, folder).collect()
    pairs = {frozenset((r["feature_1"], r["feature_2"])) for r in rows}
    assert frozenset(("first_issue_quarter", "first_transaction_quarter")) in pairs
    known = queries.REGISTRY["cramers_v"](spark, folder).collect()
    assert {frozenset((r["feature_1"], r["feature_2"])) for r in known} <= pairs


def test_client_numbers_are_profiled(spark, folder):
    rows = queries.REGISTRY["profile_numeric_clients"](spark, folder).collect()
    assert [r["column"] for r in rows] == ["age"]


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_split_sizes_are_exact(spark, monkeypatch, rounds):
    """Every part has the rounded share of every stratum, however many counting rounds there are."""
    monkeypatch.setattr(split, "ROUNDS", rounds)
    df = spark.range(2000).selectExpr(
        "id client_id", "cast(id % 7 = 0 as int) treatment_flg", "cast(id % 5 < 2 as int) target"
    ).unionByName(spark.createDataFrame([(5001, 9, 9)], "client_id long, treatment_flg int, target int"))
    shares = {"test": 0.2, "validation": 0.2, "train": 0.6}
    got = split.three_way_split(df)
    assert got.count() == 2001
    sizes = {(r[0], r[1], r[2]): r[3] for r in
             got.groupBy("treatment_flg", "target", "part").count().collect()}
    for t, y in {k[:2] for k in sizes}:
        n = sum(v for k, v in sizes.items() if k[:2] == (t, y))
        ends = [int(n * c + 0.5) for c in (0.2, 0.4)] + [n]
        want = dict(zip(shares, [ends[0], ends[1] - ends[0], n - ends[1]], strict=True))
        assert {p: sizes.get((t, y, p), 0) for p in shares} == want
    again = {r[0]: r[1] for r in split.three_way_split(df.repartition(3)).select("client_id", "part").collect()}
    assert again == {r[0]: r[1] for r in got.select("client_id", "part").collect()}


def test_split_of_repeated_keys_and_empty_tables(spark):
    rows = [(1, 0, 0)] * 30 + [(i, 0, 0) for i in range(2, 50)] + [(None, 0, 0)]
    df = spark.createDataFrame(rows, "client_id long, treatment_flg int, target int")
    got = split.holdout_split(df)
    assert got.count() == len(rows)
    assert got.where("client_id = 1").select("part").distinct().count() == 1
    assert split.assign_folds(df.where("false")).count() == 0


def test_rows_of_a_split_do_not_move(spark):
    df = spark.range(100).selectExpr("id client_id", "1 treatment_flg", "0 target")
    plan = split.holdout_split(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "rightHint=(strategy=broadcast)" in plan


def test_pair_sums_know_what_is_missing(spark):
    """Pairs over their common rows, far from zero, constants inside the common rows included."""
    rng = random.Random(4)
    rows = []
    for i in range(500):
        x = 1e9 + rng.gauss(0, 1)
        rows.append((x, x * 2 + rng.gauss(0, 1) if i % 3 else None, 5.0 if i % 3 else float(i), None))
    df = spark.createDataFrame(rows, "a double, b double, c double, none double").repartition(7)
    got = {(r["feature_1"], r["feature_2"]): r["corr"] for r in L.correlation_matrix(df).collect()}
    assert len(got) == 16
    a, b = np.array([(x, y) for x, y, *_ in rows if y is not None]).T
    assert got["a", "b"] == got["b", "a"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9)
    a, c = np.array([(x, z) for x, _, z, _ in rows]).T
    assert got["a", "c"] == pytest.approx(np.corrcoef(a, c)[0, 1], abs=1e-9)
    assert got["b", "c"] is None  # constant where b is known
    assert got["a", "a"] == 1.0 and got["none", "none"] is None and got["a", "none"] is None
    plan = L.correlation_pairs(df)._jdf.queryExecution().toString()
    assert "Generate" not in plan


def test_levels_stop_at_the_limit(spark):
    df = spark.range(1000, numPartitions=5).selectExpr(
        "concat('k', id) wide", "concat('v', id % 99) most", "concat('v', id % 100) many",
        "if(id % 2 = 0, 'x', null) gaps", "cast(null as string) none",
    )
    got = bounded_levels(df, df.columns, 100)
    assert got["wide"] is None and got["many"] is None and got["gaps"] == ["x"] and got["none"] == []
    assert sorted(got["most"]) == sorted(f"v{i}" for i in range(99))
    assert Q.categorical_columns(df) == ["most", "gaps"]


def test_cramers_v_of_long_columns_equals_that_of_coded_ones(spark, monkeypatch):
    df = spark.range(3000, numPartitions=4).selectExpr(
        "concat('a', id % 12) a", "if(id % 5 = 0, null, concat('b', hash(id) % 7 + id % 12)) b", "'one' c"
    )
    key = lambda rows: {(r[0], r[1]): r[2] and round(r[2], 12) for r in rows.collect()}
    coded = key(L.cramers_v(df, df.columns))
    monkeypatch.setattr(L, "DENSE_LEVELS", 5)
    assert key(L.cramers_v(df, df.columns)) == coded and len(coded) == 6
