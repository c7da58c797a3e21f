"""Counting rounds of a split."""

from __future__ import annotations

from nudgelab.operators import split


def parts(df):
    return {r[0]: r[1] for r in split.three_way_split(df).select("client_id", "part").collect()}


def test_small_buckets_are_ranked_after_one_round(spark, monkeypatch):
    """The second round used to run whatever the first one had left."""
    df = spark.range(3000).selectExpr("id client_id", "cast(id % 2 as int) treatment_flg", "0 target")
    tables, real = [], split.materialize
    monkeypatch.setattr(split, "materialize", lambda made: tables.append(made) or real(made))
    short = parts(df)
    assert len(tables) == 2
    monkeypatch.setattr(split, "RANKED_ROWS", 0)
    assert parts(df) == short
    assert len(tables) == 5
