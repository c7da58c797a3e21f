"""How filters interact: what each removes in every order of applying them.

1. Every text gets a mask with one bit per filter that it fails. Equal texts share the bits that
   depend on the text alone, so rows fold to (text digest, part, labels) before anything else; the
   smallest id of a digest decides which rows are copies.
2. Counts fold on to mask cells: at most 32 masks for each part (language).
3. Each cell is folded through the array of all orders with higher-order functions: ``transform``
   over the orders, ``aggregate`` over the letters of one order, which gives 120 * 5 structs
   weighted by the cell's counts. The cells of a part are added up element by element.

Everything is DataFrame functions. No group larger than the distinct (part, labels) pairs of one
digest, or the 32 cells of one part, ever meets in a task.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nudgelab.llm.common import quoted

LETTERS = "ABCDE"
ORDERS = ["".join(x) for x in permutations(LETTERS)]
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITAL_PERCENT = 3

_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_STEP = "struct<letter:string," + ",".join(f"{c}:bigint" for c in _COUNTS) + ">"


def text_failures(text: Column) -> Column:
    """Bits 1, 2, 4 and 8 of the filters A to D for a text that is not null.

    A: fewer than 200 words. B: fewer than half of the words distinct, in their case. C: more than
    3 % of the code points are A-Z. D: one of ``#$%&*|`` occurs. An empty text has no words, so it
    fails A alone.
    """
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (
        n < LEAST_WORDS,
        100 * distinct.cast("long") < LEAST_DISTINCT_PERCENT * n.cast("long"),
        100 * capitals.cast("long") > MOST_CAPITAL_PERCENT * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    )
    return sum(
        (F.when(x, F.lit(1 << i)).otherwise(F.lit(0)) for i, x in enumerate(fails)), F.lit(0)
    )


def mask_cells(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Return (part, mask, n, n_good, n_toxic): documents of each part by the filters they fail.

    Bit 16 is filter E: an equal text has a smaller id, whatever its part and whether it is removed
    by another filter. Null texts count as empty, null parts as the empty string. Rows without an
    id are copies of nothing and have no labels; rows that repeat an id and its text count each,
    and neither is a copy of the other. An id with several label rows is good (toxic) if one of them says
    so. Other columns are not read.
    """
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    measured = docs.select(
        F.col(quoted(id_col)).cast("long").alias("doc_id"),
        F.coalesce(F.col(quoted(part_col)).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text_failures(text).alias("mask"),
    )
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    labelled = measured.join(marks, "doc_id", "left").select(
        *measured.columns, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    )
    text_key = ["digest", "part", "mask", "good", "toxic"]
    of_id = labelled.groupBy("doc_id", *text_key).agg(F.count(F.lit(1)).alias("n"))
    of_text = of_id.groupBy(*text_key).agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_without"),
    )
    smallest = F.min("first").over(Window.partitionBy("digest"))
    originals = F.col("n_without") + F.when(F.col("first") == smallest, F.col("n_first")).otherwise(0)
    split = of_text.withColumn("originals", originals).select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("mask"), F.col("originals").alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("originals")).alias("n")),
        )).alias("cell"),
    )
    n = F.col("cell.n")
    return split.groupBy("part", F.col("cell.mask").alias("mask")).agg(
        F.sum(n).alias("n"),
        F.sum(F.when(F.col("good"), n).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("n_toxic"),
    )


def audit(cells: DataFrame) -> DataFrame:
    """Return (part, filter_order, step, letter, the six counts, shapley) from :func:`mask_cells`.

    600 rows for each part. ``shapley`` is what the step's filter removes, summed over all orders.
    No cells give no rows.
    """
    merged = (
        cells.withColumn("steps", _fold_orders())
        .groupBy("part")
        .agg(F.collect_list("steps").alias("cells"))
        .withColumn("steps", _element_sums(F.col("cells")))
    )
    shares = F.map_from_entries(
        F.array(*[F.struct(F.lit(x), _removed_by(F.col("steps"), x)) for x in LETTERS])
    )
    place = F.col("place")
    return (
        merged.select("part", shares.alias("shares"), F.posexplode("steps").alias("place", "of"))
        .select(
            "part",
            _orders()[F.floor(place / len(LETTERS)).cast("int")].alias("filter_order"),
            (place % len(LETTERS) + 1).cast("int").alias("step"),
            F.col("of.letter").alias("letter"),
            *[F.col(f"of.{c}").alias(c) for c in _COUNTS],
            F.col("shares")[F.col("of.letter")].alias("shapley"),
        )
    )


def _removed_by(steps: Column, letter: str) -> Column:
    own = F.filter(steps, lambda s: s["letter"] == letter)
    return F.aggregate(own, F.lit(0).cast("long"), lambda total, s: total + s["removed"])


def _orders() -> Column:
    return F.array(*[F.lit(x) for x in ORDERS])


def _fold_orders() -> Column:
    """The 600 structs of one cell: its counts at every step of every order."""
    positions = F.array(*[F.lit(i) for i in range(1, len(LETTERS) + 1)])
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(f"array<{_STEP}>").alias("steps"))

    def one_order(order: Column) -> Column:
        def apply(state: Column, at: Column) -> Column:
            letter = F.substr(order, at, F.lit(1))
            bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(len(LETTERS))]),
                               F.ascii(letter) - ord("A") + 1)
            fails = F.col("mask").bitwiseAND(bit) != 0
            count = lambda condition, c: F.when(condition, F.col(c)).otherwise(F.lit(0)).cast("long")
            falls = fails & ~state["gone"]
            step = F.struct(
                letter.alias("letter"),
                count(~fails & ~state["gone"], "n").alias("kept"),
                count(falls, "n").alias("removed"),
                count(fails & state["gone"], "n").alias("redundant"),
                count(F.col("mask") == bit, "n").alias("unique_fails"),
                count(falls, "n_good").alias("good_lost"),
                count(falls, "n_toxic").alias("toxic_lost"),
            )
            return F.struct(
                (state["gone"] | fails).alias("gone"),
                F.concat(state["steps"], F.array(step)).alias("steps"),
            )

        return F.aggregate(positions, start, apply, lambda state: state["steps"])

    return F.flatten(F.transform(_orders(), one_order))


def _element_sums(cells: Column) -> Column:
    """Arrays of the same 600 steps added up place by place."""

    def add(a: Column, b: Column) -> Column:
        return F.struct(
            a["letter"].alias("letter"), *[(a[c] + b[c]).alias(c) for c in _COUNTS]
        )

    return F.aggregate(
        F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), cells[0],
        lambda total, one: F.zip_with(total, one, add),
    )
