"""Running totals and quantiles against brute force, with hot groups and heavy ties."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nudgelab.operators import prefix, quantiles
from nudgelab.operators.prefix import running_totals
from nudgelab.operators.quantiles import column_quantiles, exact_quantiles


def skewed_rows(n=4000, seed=3):
    """A third of the rows share one group, and a third of those share one value."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = 7 if rng.random() < 0.34 else rng.randrange(40)
        value = 50.0 if rng.random() < 0.34 else float(rng.randrange(500))
        rows.append((i, group, value, rng.randrange(5)))
    return rows


def test_global_running_sum(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "id long, g long, v double, w long").repartition(6)
    got = running_totals(df, [F.col("v").desc(), F.col("id")], ["w"]).collect()
    run = {r["id"]: (r["w_run"], r["w_all"]) for r in got}
    total, expected = sum(r[3] for r in rows), 0
    for row in sorted(rows, key=lambda r: (-r[2], r[0])):
        expected += row[3]
        assert run[row[0]] == (expected, total)
    assert len(got) == len(rows)


def test_grouped_running_sum_with_a_hot_group(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "id long, g long, v double, w long").repartition(6)
    got = running_totals(df, [F.col("v"), F.col("id")], ["w"], ["g"]).collect()
    run = {r["id"]: (r["w_run"], r["w_all"]) for r in got}
    for group in {r[1] for r in rows}:
        members = sorted((r for r in rows if r[1] == group), key=lambda r: (r[2], r[0]))
        total, so_far = sum(r[3] for r in members), 0
        for row in members:
            so_far += row[3]
            assert run[row[0]] == (so_far, total)


@pytest.mark.parametrize("held", [1, 7, 200_000])
@pytest.mark.parametrize("batch", ["3", "10000"])
def test_groups_that_end_anywhere(spark, monkeypatch, held, batch):
    """Groups cut by slices, by Arrow batches and by their own size; null keys, zeros and doubles."""
    monkeypatch.setattr(prefix, "HELD_ROWS", held)
    rng = random.Random(held)
    rows = [(i, rng.choice([None, 1, 2, 3, 3, 3, 9]), rng.choice(["a", None]), 0 if i % 3 else i, rng.random())
            for i in range(600)]
    rows += [(1000 + i, 5, "z", 0, 0.0) for i in range(60)] + [(2000, 7, "z", None, None)]
    df = spark.createDataFrame(rows, "id long, g long, h string, w int, x double").repartition(5)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, batch)
    try:
        got = {r["id"]: r for r in running_totals(df, [F.col("id").desc()], ["w", "x"], ["g", "h"]).collect()}
    finally:
        spark.conf.set(setting, before)
    assert len(got) == len(rows)
    for g, h in {(r[1], r[2]) for r in rows}:
        members = sorted((r for r in rows if (r[1], r[2]) == (g, h)), key=lambda r: -r[0])
        w = x = 0
        for r in members:
            w, x = w + (r[3] or 0), x + (r[4] or 0.0)
            assert got[r[0]]["w_run"] == w and got[r[0]]["x_run"] == pytest.approx(x)
        for r in members:
            assert got[r[0]]["w_all"] == w and got[r[0]]["x_all"] == pytest.approx(x)


def test_rows_are_shuffled_once(spark):
    """One exchange writes the slices, and what reads them exchanges marked rows only."""
    df = spark.range(5000, numPartitions=4).selectExpr("id", "id % 7 v", "1L w")
    plan = running_totals(df, [F.col("v"), F.col("id")], ["w"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") <= 1 and "rangepartitioning" not in plan
    assert "Sort" not in plan.split("BroadcastExchange")[0]


def test_hot_group_is_cut_into_several_slices(spark):
    """One group of all rows must not end up in one task."""
    df = spark.range(20000).select(F.lit(1).alias("g"), F.col("id"))
    ranged = df.repartitionByRange(4, "g", "id").withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in ranged.groupBy("p").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 0.5 * 20000


@pytest.mark.parametrize("limit", [2, 60, 100_000])
@pytest.mark.parametrize("by", [(), ("g",), ("g", "h")])
def test_quantiles_match_numpy(spark, by, limit):
    rows = [(i, None if g == 7 else g, "ab"[i % 2], v) for i, g, v, _ in skewed_rows(3000)]
    rows += [(9001, 99, "a", 4.0), (9002, 98, "b", None)]
    df = spark.createDataFrame(rows, "id long, g long, h string, v double").repartition(5)
    probabilities = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q95": 0.95, "q100": 1.0}
    got = exact_quantiles(df, "v", probabilities, by, group_limit=limit).collect()
    groups: dict = {}
    place = {"g": 1, "h": 2}
    for row in rows:
        if row[3] is not None:
            groups.setdefault(tuple(row[place[b]] for b in by), []).append(row[3])
    assert len(got) == len(groups)
    for row in got:
        values = groups[tuple(row[b] for b in by)]
        for name, p in probabilities.items():
            assert row[name] == pytest.approx(np.quantile(values, p), abs=1e-9)


@pytest.mark.parametrize("k", [8, 200, 4096])
@pytest.mark.parametrize("largest", [10, 100_000])
def test_column_quantiles_do_not_depend_on_the_sketch(spark, monkeypatch, k, largest):
    """Heavy tails, heavy ties, nulls, NaN and a constant column; the sketch may be tiny."""
    monkeypatch.setattr(quantiles, "GROUP_LIMIT", largest)
    rng = random.Random(8)
    rows = [
        (rng.lognormvariate(0, 4) if i else float("nan"), 50.0 if rng.random() < 0.4 else float(rng.randrange(9)),
         None if i % 3 else float(i), 7, None)
        for i in range(3000)
    ]
    schema = "`a.b` double, ties double, gaps double, same int, none double"
    df = spark.createDataFrame(rows, schema).repartition(5)
    probabilities = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    got = {r["column"]: r for r in column_quantiles(df, df.columns, probabilities, k).collect()}
    assert set(got) == {"a.b", "ties", "gaps", "same"}
    for i, name in enumerate(df.columns[:4]):
        values = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
        for q, p in probabilities.items():
            assert got[name][q] == pytest.approx(np.quantile(values, p), rel=1e-12)
    empty = column_quantiles(df.select("none"), ["none"], probabilities)
    assert empty.columns == ["column", *probabilities] and empty.count() == 0


def test_a_bracket_that_misses_is_opened(spark, monkeypatch):
    """Brackets put next to the wanted positions: one more count, the same result."""
    df = spark.range(1000).selectExpr("double(id) v")
    real = quantiles._sketch_ranks
    monkeypatch.setattr(
        quantiles, "_sketch_ranks", lambda *a: ({"c0": [(900.0, 910.0)]}, real(*a)[1])
    )
    row = column_quantiles(df, ["v"], {"p50": 0.5, "p90": 0.905}).first()
    assert (row["p50"], row["p90"]) == pytest.approx((499.5, 904.095))


def test_two_reads_whatever_the_columns(spark, tmp_path):
    """The input is scanned by two jobs only, one for the sketches and one for the counts."""
    path = str(tmp_path / "t")
    spark.range(5000).selectExpr(*[f"double(hash(id, {i})) c{i}" for i in range(6)]).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def passed(batches):
        reads.add(1)
        yield from batches

    table = spark.read.parquet(path).coalesce(1)
    seen = table.mapInArrow(passed, table.schema)
    assert column_quantiles(seen, table.columns, {"p10": 0.1, "p50": 0.5, "p99": 0.99}).count() == 6
    assert reads.value == 2
