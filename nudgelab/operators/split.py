"""Stratified assignment with exact part sizes by a hash of the key: no rows move."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nudgelab.session import materialize

#: Hex digits of the hash that one counting round looks at, and the rounds before rows are ranked at most.
HASH_DIGITS, ROUNDS = 4, 2
#: Rows of a bucket that are ranked without another round.
RANKED_ROWS = 1000
STRATUM, PLACE = "_stratum", "_place"


def stratum(*columns: str) -> Column:
    """Strata key such as ``1_0``."""
    return F.concat_ws("_", *(F.col(c).cast("string") for c in columns))


def hash_place(key: str, seed: int) -> Column:
    """The row's place in its stratum: a hash as fixed-length hex text, then the key."""
    text = F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))
    return F.concat(F.md5(text.cast("binary")), F.lit(":"), F.coalesce(F.col(key).cast("string"), F.lit("")))


def stratified_assign(
    df: DataFrame,
    key: str,
    strata: Sequence[str],
    shares: dict[str, float],
    seed: int = 42,
    out: str = "part",
) -> DataFrame:
    """Label each row with one of ``shares``; a part has round(share * n) rows of every stratum.

    Sizes are those of the cumulative shares, rounded half up, so they add up. The rows of a part
    are those with the smallest hashes of the stratum: the last one is found by counting hashes by
    their first digits, then the rows of that one bucket by the next digits, and ranking what is
    left, which is a few rows. Rows are labelled in place. Rows that repeat a key stay together, so
    a part may exceed its size by such rows.
    """
    names = list(shares)
    borders = list(accumulate(shares.values()))[:-1]
    tagged = df.withColumns({STRATUM: stratum(*strata), PLACE: hash_place(key, seed)})
    last = _last_places(tagged.select(STRATUM, PLACE), borders)
    label = F.lit(names[-1])
    for i in reversed(range(len(borders))):
        label = F.when(F.col(PLACE) <= F.col("_last")[i], F.lit(names[i])).otherwise(label)
    # As many rows as strata (pairs of 0/1 flags).
    return tagged.join(F.broadcast(last), STRATUM).withColumn(out, label).drop(STRATUM, PLACE, "_last")


def _last_places(places: DataFrame, borders: Sequence[float]) -> DataFrame:
    """(stratum, [last place of the part below each border]); null where the part is empty.

    Each round leaves one bucket for a stratum and border, 65,536 times smaller than the one before;
    the last round is left out if all buckets are small before it.
    """
    sizes = places.groupBy(STRATUM).agg(F.count("*").alias("n"))
    wanted = F.array(*[
        F.struct(F.lit(i).alias("border"), F.floor(F.col("n") * F.lit(b) + 0.5).alias("rank"))
        for i, b in enumerate(borders)
    ]).cast("array<struct<border:int,rank:bigint>>")
    sought = materialize(
        sizes.select(STRATUM, F.inline(wanted)).withColumn("prefix", F.lit(""))
    )
    digits = 0
    for done in range(0, HASH_DIGITS * ROUNDS, HASH_DIGITS):
        digits = done + HASH_DIGITS
        counts = _inside(places, sought, done).groupBy(
            STRATUM, "border", "rank", F.substring(PLACE, 1, digits).alias("prefix")
        ).agg(F.count("*").alias("n"))
        upto = Window.partitionBy(STRATUM, "border").orderBy("prefix")
        run = counts.withColumn("run", F.sum("n").over(upto))
        held = run.where("run >= rank AND run - n < rank")
        left = (F.col("rank") - F.col("run") + F.col("n")).alias("rank")
        buckets = materialize(held.select(STRATUM, "border", left, "prefix", "n"))
        sought = buckets.drop("n")
        if (buckets.agg(F.max("n")).first()[0] or 0) <= RANKED_ROWS:
            break
    rank = F.row_number().over(Window.partitionBy(STRATUM, "border").orderBy(PLACE))
    found = _inside(places, sought, digits).withColumn("place", rank)
    of = lambda i: F.max(F.when((F.col("border") == i) & (F.col("place") == F.col("rank")), F.col(PLACE)))
    ends = found.groupBy(STRATUM).agg(F.array(*[of(i) for i in range(len(borders))]).alias("_last"))
    none = F.array(*[F.lit(None).cast("string") for _ in borders]).cast("array<string>")
    return sizes.select(STRATUM).join(ends, STRATUM, "left").withColumn("_last", F.coalesce("_last", none))


def _inside(places: DataFrame, sought: DataFrame, digits: int) -> DataFrame:
    """The places that begin with a sought prefix; one row for each stratum and border of it."""
    listed = sought.withColumnsRenamed({STRATUM: "_of", "prefix": "_begin"})
    same = (F.col(STRATUM) == F.col("_of")) & (F.substring(PLACE, 1, digits) == F.col("_begin"))
    return places.join(F.broadcast(listed), same).drop("_of", "_begin")


def holdout_split(
    df: DataFrame,
    key: str = "client_id",
    strata: Sequence[str] = ("treatment_flg", "target"),
    test_share: float = 0.3,
    seed: int = 42,
) -> DataFrame:
    """Two parts, ``test`` and ``train``."""
    shares = {"test": test_share, "train": 1 - test_share}
    return stratified_assign(df, key, strata, shares, seed)


def three_way_split(
    df: DataFrame,
    key: str = "client_id",
    strata: Sequence[str] = ("treatment_flg", "target"),
    seed: int = 42,
) -> DataFrame:
    """20 % test, then a quarter of the rest for validation: 60 / 20 / 20."""
    shares = {"test": 0.2, "validation": 0.8 * 0.25, "train": 0.8 * 0.75}
    return stratified_assign(df, key, strata, shares, seed)


def assign_folds(
    df: DataFrame,
    folds: int = 3,
    key: str = "client_id",
    strata: Sequence[str] = ("target",),
    seed: int = 42,
) -> DataFrame:
    """Fold number 0..folds-1 in column ``fold``, balanced inside every stratum."""
    shares = {str(i): 1 / folds for i in range(folds)}
    return stratified_assign(df, key, strata, shares, seed, out="fold").withColumn(
        "fold", F.col("fold").cast("int")
    )
