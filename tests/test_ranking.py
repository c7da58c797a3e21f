"""Properties of the ranking metrics, and brute force on small tables."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nudgelab.operators import ranking as R

SCHEMA = "client_id long, uplift double, treatment_flg int, target int"


def rows_of(n=600, seed=5, distinct=25):
    rng = random.Random(seed)
    return [
        (i, rng.randrange(distinct) / distinct, rng.randrange(2), int(rng.random() < 0.6))
        for i in range(n)
    ]


def curve(rows, kind):
    """(n, gain) at each distinct score, by loops."""
    points, seen = [(0, 0.0)], []
    for score in sorted({r[1] for r in rows}, reverse=True):
        seen += [r for r in rows if r[1] == score]
        nt = sum(r[2] for r in seen)
        nc = len(seen) - nt
        yt = sum(r[3] for r in seen if r[2])
        yc = sum(r[3] for r in seen if not r[2])
        if kind == "auuc":
            gain = ((yt / nt if nt else 0) - (yc / nc if nc else 0)) * len(seen)
        else:
            gain = yt - yc * (nt / nc if nc else 0)
        points.append((len(seen), gain))
    return points


def area(points):
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))


def brute_force(rows, kind):
    control_responders = sum(1 for r in rows if r[3] and not r[2])
    treated_silent = sum(1 for r in rows if not r[3] and r[2])

    def ideal(r):
        if kind == "qini":
            return r[3] * r[2] - r[3] * (1 - r[2])
        return 2 * int(r[3] == r[2]) + (r[3] if control_responders > treated_silent else r[2])

    perfect = curve([(r[0], ideal(r), r[2], r[3]) for r in rows], kind)
    diagonal = perfect[-1][0] * perfect[-1][1] / 2
    return (area(curve(rows, kind)) - diagonal) / (area(perfect) - diagonal)


@pytest.mark.parametrize("distinct", [1, 4, 25, 600])
def test_areas_match_brute_force(spark, distinct):
    rows = rows_of(distinct=distinct)
    got = R.gain_areas(spark.createDataFrame(rows, SCHEMA).repartition(5)).first()
    assert got["auuc"] == pytest.approx(brute_force(rows, "auuc"), abs=1e-9)
    assert got["qini"] == pytest.approx(brute_force(rows, "qini"), abs=1e-9)


def test_perfect_score_is_one(spark):
    scored = spark.createDataFrame(rows_of(), SCHEMA)
    t, y = F.col("treatment_flg"), F.col("target")
    qini = scored.withColumn("uplift", (y * t - y * (1 - t)).cast("double"))
    assert R.gain_areas(qini).first()["qini"] == pytest.approx(1.0)
    counts = scored.agg(
        F.sum(y * (1 - t)).alias("control"), F.sum((1 - y) * t).alias("silent")
    ).first()
    last = y if counts["control"] > counts["silent"] else t
    auuc = scored.withColumn("uplift", (2 * (t == y).cast("int") + last).cast("double"))
    assert R.gain_areas(auuc).first()["auuc"] == pytest.approx(1.0)


def test_monotone_maps_change_nothing(spark):
    scored = spark.createDataFrame(rows_of(), SCHEMA)
    mapped = scored.withColumn("uplift", F.exp(F.col("uplift") * 3) - 7)
    assert R.gain_areas(mapped).first() == R.gain_areas(scored).first()
    auc = [R.roc_auc(s, "uplift", "target").first()["auc"] for s in (scored, mapped)]
    assert auc[0] == auc[1]


def test_metrics_per_model_match_single_runs(spark):
    a, b = rows_of(seed=1), rows_of(seed=2, n=301)
    frames = {n: spark.createDataFrame(r, SCHEMA) for n, r in (("a", a), ("b", b))}
    both = frames["a"].withColumn("model", F.lit("a")).unionByName(
        frames["b"].withColumn("model", F.lit("b"))
    )
    table = {r["model"]: r for r in R.metric_table(both, ["model"]).collect()}
    for name, frame in frames.items():
        alone = frame.withColumn("model", F.lit(name))
        single = R.metric_table(alone, ["model"]).first()
        assert table[name].asDict() == pytest.approx(single.asDict())


def test_top_share_of_everything_is_the_arm_difference(spark):
    rows = rows_of()
    ranked = R.rank_clients(spark.createDataFrame(rows, SCHEMA))
    got = R.uplift_at_k(ranked, [1.0]).first()["uplift_at_100"]
    treated = [r[3] for r in rows if r[2]]
    control = [r[3] for r in rows if not r[2]]
    assert got == pytest.approx(np.mean(treated) - np.mean(control))


@pytest.mark.parametrize("n", [3, 10, 11, 19, 25])
def test_bins_follow_ntile(spark, n):
    from pyspark.sql import Window

    df = spark.range(1, n + 1).withColumnRenamed("id", "p")
    both = df.select(
        R.equal_bin(F.col("p"), F.lit(n), 10).alias("mine"),
        F.ntile(10).over(Window.orderBy("p")).alias("theirs"),
    ).collect()
    assert all(r["mine"] == r["theirs"] for r in both)


def test_uplift_curve_head_takes_the_first_defined_value(spark):
    rows = [(1, 0.9, 1, 1), (2, 0.8, 1, 0), (3, 0.7, 0, 1), (4, 0.6, 1, 1)]
    ranked = R.rank_clients(spark.createDataFrame(rows, SCHEMA))
    points = R.uplift_curve(ranked).orderBy("position").collect()
    values = [r["uplift_curve"] for r in points]
    assert values == pytest.approx([-0.5, -0.5, -0.5, 2 / 3 - 1])
    one_arm = R.rank_clients(spark.createDataFrame(rows[:2], SCHEMA))
    assert [r["uplift_curve"] for r in R.uplift_curve(one_arm).collect()] == [0.0, 0.0]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 4), st.integers(0, 1)), min_size=2, max_size=40
    )
)
def test_auc_matches_pair_counting(spark, pairs):
    df = spark.createDataFrame([(float(s), y) for s, y in pairs], "s double, y int")
    got = R.roc_auc(df, "s", "y").first()["auc"]
    positive = [s for s, y in pairs if y]
    negative = [s for s, y in pairs if not y]
    if not positive or not negative:
        assert got is None
        return
    wins = sum((p > q) + 0.5 * (p == q) for p in positive for q in negative)
    assert got == pytest.approx(wins / (len(positive) * len(negative)))
