"""Connected components of a link table by alternating stars, wholly distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nudgelab.session import materialize

ROUNDS = 60
#: Up to so many links the minima of all nodes, two rows a link at most, are joined by broadcast.
FEW_LINKS = 100_000
#: Beyond, only those of nodes with more than a ten-thousandth of all links.
FEW_NODES = 10_000


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from every node of ``links(u, v)``.

    Returns (node, component), one row per node that has a link to another node. Links may
    repeat and point either way; self links and links with nulls count for nothing; no links
    give no rows. Each round hangs the neighbours of a node below the smallest of them; the
    table never holds more rows than there are links, and it is written to the shared folder
    after each round. Minima are combined before they are shuffled, and those of nodes with very many
    links (at most twice ``FEW_NODES`` of them) are joined by broadcast, so none is a hot group.
    """
    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    stars = materialize(links.where("u <> v").select(high, low).distinct())
    seen = _mark(stars)
    for _ in range(ROUNDS):
        if not seen[0]:
            break
        stars = materialize(_small(_large(stars, seen[0]), seen[0]))
        now = _mark(stars)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixed point after {ROUNDS} rounds")
    roots = stars.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(stars: DataFrame) -> tuple[int, str]:
    """Number of rows and an order-free fingerprint."""
    row = stars.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return row[0], str(row[1])


def _with_least(links: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """``links`` with ``root`` of their ``u``; ``least`` holds (u, root, n) of every u."""
    if total <= FEW_LINKS:
        return links.join(F.broadcast(least.drop("n")), "u")
    hot = F.broadcast(least.where(F.col("n") > total // FEW_NODES).drop("n"))
    rest = links.join(hot.select("u"), "u", "left_anti").join(least.drop("n"), "u")
    return rest.unionByName(links.join(hot, "u"))


def _large(stars: DataFrame, total: int) -> DataFrame:
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("root"), F.count(F.lit(1)).alias("n")
    )
    return (
        _with_least(both, least, total)
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("root").alias("v"))
    )


def _small(stars: DataFrame, total: int) -> DataFrame:
    least = stars.groupBy("u").agg(F.min("v").alias("root"), F.count(F.lit(1)).alias("n"))
    child = F.when(F.col("v") == F.col("root"), F.col("u")).otherwise(F.col("v"))
    return (
        _with_least(stars, least, total)
        .select(child.alias("u"), F.col("root").alias("v"))
        .distinct()
    )
