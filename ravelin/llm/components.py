"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.llm.common import stored

ROUNDS = 60


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least node around it."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return _pairs(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _pairs(moved.unionAll(least.select("a", F.col("least").alias("b"))))


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that `links` (a, b) names; root is the least node of its component.

    Large-star and small-star steps alternate until nothing changes; every round is stored. A node with many links costs
    a partial minimum and a join whose skewed side Spark splits. Links of a node with itself and nulls are left out.
    """
    links = stored(_pairs(links.where("a is not null and b is not null").select("a", "b")), "links")
    mark = _mark(links)
    for _ in range(ROUNDS):
        if not mark[0]:
            break
        links = stored(_small_star(_large_star(links)), "links")
        before, mark = mark, _mark(links)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
