"""Windowed latency: late rows, restarts, merged windows and the sketch's error."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from nudgelab.sources import scorelog
from nudgelab.streaming import latency

START = datetime(2024, 5, 1)
ROWS = "id long, ts timestamp_ntz, processing_time double"


def land(spark, path, rows):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(path)


def run(spark, *paths, **settings):
    query = latency.start_windows(spark, *paths, length="10 minutes", late="20 minutes", **settings)
    query.awaitTermination(120)
    assert query.exception() is None
    return {
        r["window_start"]: r for r in latency.readings(latency.read_windows(spark, paths[1])).collect()
    }


def at(minute):
    return START + timedelta(minutes=minute)


def test_late_rows_and_restarts(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("landing", "windows", "state")]
    land(spark, paths[0], [(1, at(1), 1.0), (2, at(2), 3.0), (3, at(12), 5.0), (4, None, 9.0)])
    assert run(spark, *paths) == {}  # nothing is twenty minutes past its window's end
    # Out of order but in time for the first window; unmeasured requests count for nothing.
    land(spark, paths[0], [(5, at(3), 8.0), (6, at(31), 2.0), (7, at(4), None), (8, at(4), 0.0)])
    done = run(spark, *paths)
    assert {k: (r["n"], r["total"], r["p50"], r["least"], r["most"]) for k, r in done.items()} == {
        at(0): (3, 12.0, 3.0, 1.0, 8.0)
    }
    # Too late for the first window, in time for the second, which closes now.
    land(spark, paths[0], [(9, at(5), 100.0), (10, at(13), 7.0), (11, at(45), 4.0)])
    done = run(spark, *paths)
    assert {k: (r["n"], r["total"]) for k, r in done.items()} == {at(0): (3, 12.0), at(10): (2, 12.0)}
    assert run(spark, *paths) == done  # no new file, no new row


def test_micro_batches_give_the_table_s_windows(spark, tmp_path):
    """Several micro-batches of one run: closed windows equal those of the whole table."""
    rng = random.Random(2)
    paths = [str(tmp_path / n) for n in ("landing", "windows", "state")]
    rows = []
    for part in range(4):
        new = [(part * 500 + i, at(part * 40 + rng.random() * 45), rng.expovariate(1)) for i in range(500)]
        land(spark, paths[0], new)
        rows += new
    done = run(spark, *paths, files_at_once=1)
    whole = defaultdict(list)
    for _, ts, seconds in rows:
        whole[START + timedelta(minutes=10 * int((ts - START).seconds // 600))].append(seconds)
    last = max(ts for _, ts, _ in rows)
    closed = {k: v for k, v in whole.items() if k + timedelta(minutes=30) <= last}
    assert set(done) == set(closed) and len(done) > 10
    for k, seconds in closed.items():
        ordered, r = sorted(seconds), done[k]
        assert r["n"] == len(seconds) and r["total"] == pytest.approx(sum(seconds))
        for name, share in latency.SHARES.items():
            assert r[name] == ordered[math.ceil(share * len(ordered)) - 1]


def test_longer_windows_need_no_second_reading(spark):
    rng = random.Random(3)
    rows = [(i, at(rng.random() * 120), rng.random()) for i in range(700)]
    log = spark.createDataFrame(rows, ROWS).selectExpr("id", "cast(ts as timestamp) ts", "processing_time")
    short = latency.window_states(log, "10 minutes")
    merged = {r["window_start"]: r for r in latency.readings(latency.longer_windows(short, "1 hour")).collect()}
    direct = {r["window_start"]: r for r in latency.readings(latency.window_states(log, "1 hour")).collect()}
    assert set(merged) == set(direct) and len(merged) == 2
    for k, r in merged.items():
        assert r["n"] == direct[k]["n"] and r["total"] == pytest.approx(direct[k]["total"])
        assert [r[c] for c in ("p50", "p95", "p99", "least", "most")] == [
            direct[k][c] for c in ("p50", "p95", "p99", "least", "most")
        ]


def test_large_windows_stay_inside_the_stated_error(spark):
    """Two hundred thousand requests of one window, in many partial sketches."""
    n, k = 200_000, 200
    log = spark.range(n, numPartitions=16).selectExpr(
        "id", "timestamp'2024-05-01 00:00:00' ts", "(id * 7919 % 200000 + 1) / 1000D processing_time"
    )
    row = latency.readings(latency.window_states(log, "1 hour", k)).first()
    assert row["n"] == n and row["least"] == 0.001 and row["most"] == 200.0
    for name, share in latency.SHARES.items():
        assert abs(row[name] * 1000 / n - share) <= 2 * 1.65 / k**0.9


def test_follows_the_score_log(spark, tmp_path):
    """The log that scoring writes, batch by batch and day by day, can be followed directly."""
    paths = [str(tmp_path / n) for n in ("log", "windows", "state")]
    for part, minute in enumerate((1, 55)):
        rows = spark.createDataFrame([(part, at(minute), 0.5)], ROWS).selectExpr(
            "*", "1L input_size", "1L input_tokens", "200 status_code", "'' input_data", "'' output_data"
        )
        scorelog.write_batch(rows, paths[0], part)
    assert [k for k in run(spark, *paths)] == [at(0)]
