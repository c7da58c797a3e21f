"""Fences come from the groups' own sketches."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from nudgelab.llm import quality_rules as q


def fences(spark, rows):
    kinds = "lang string, source string, " + ", ".join(f"{m} double" for m in q.METRICS)
    out = q.thresholds(spark.createDataFrame(rows, kinds)).collect()
    return {(r.lang, r.source, r.metric): (r.low, r.high) for r in out}


def group(lang, source, n, scale, seed):
    rng = random.Random(seed)
    return [(lang, source, *[rng.random() * scale for _ in q.METRICS]) for _ in range(n)]


def test_groups_of_other_distributions_have_other_fences(spark):
    """On every metric, the fence follows the values' scale."""
    got = fences(spark, group("en", "a", 3000, 1.0, 1) + group("en", "b", 3000, 5.0, 2))
    for m in q.METRICS:
        assert 3 < got["en", "b", m][1] / got["en", "a", m][1] < 6
    assert got["en", "a", "word_length"][0] is not None and got["en", "a", "repeat_share"][0] is None


def test_small_groups_lean_on_their_language_without_a_switch(spark):
    """The fence moves steadily from the language's to the group's own as the group grows."""
    others = group("en", "a", 4000, 1.0, 1)
    highs = [
        fences(spark, others + group("en", "b", n, 5.0, 3))["en", "b", "symbol_share"][1]
        for n in (1, 40, 99, 101, 400, 4000)
    ]
    assert highs == sorted(highs) and highs[-1] > 2.5 * highs[0]
    assert highs[3] / highs[2] < 1.1


def test_the_spread_comes_from_the_first_quantile_that_has_one(spark):
    rare = [("en", "a", 0.0, 0.0, 0.0, 5.0) for _ in range(970)]
    rare += [("en", "a", 0.4, 0.0, 0.2, 5.0) for _ in range(30)]
    got = fences(spark, rare)
    assert abs(got["en", "a", "symbol_share"][1] - 1.6) < 0.05  # from the 0.99 quantile
    assert got["en", "a", "duplicate_line_share"] == (None, None)  # no spread, no fence
    assert got["en", "a", "word_length"] == (None, None)


def test_rows_without_a_fence_are_kept(spark):
    docs = spark.createDataFrame(
        [(i, "w" * 5 + " one two three four five six seven eight nine ten", None, None) for i in range(5)],
        "doc_id long, text string, lang string, source string",
    )
    assert q.judged(docs).where(F.col("kept")).count() == 5
