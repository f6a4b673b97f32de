"""Connected components of a large set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logmill.functions.scratch import discard
from logmill.llm.common import materialize


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root``: the smallest node reachable, for each node of ``links`` (a, b).

    Rounds of large-star and small-star steps (each node's larger neighbours, then its smaller
    ones, move to the smallest) until all links are stars; every round is a written table. The
    minimum of a node's neighbours is an aggregate with a partial step, and a node with very
    many neighbours is the skewed side of a plain join: nothing gathers them in one task.
    """
    now = _written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b"))
    for _ in range(most_rounds):
        if _are_stars(now):
            break
        after = _written(_small_star(_large_star(now)))
        discard(now)
        now = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _written(links: DataFrame) -> DataFrame:
    return materialize(links.distinct(), "links")[0]


def _are_stars(links: DataFrame) -> bool:
    """Whether every node stands in links of one smallest node only: a round would change nothing."""
    of = links.select(F.explode(F.array("a", "b")).alias("node"), "a").groupBy("node")
    return not of.agg(F.min("a").alias("lo"), F.max("a").alias("hi")).filter("lo <> hi").count()


def _both(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """For every node u and neighbour v > u: v with the smallest of u and its neighbours. A row for
    each link: what comes several times goes at the end of the round."""
    least = _both(links).groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return links.join(least, "a").select(F.col("m").alias("a"), "b")


def _small_star(links: DataFrame) -> DataFrame:
    """For every node u: its smaller neighbours and itself with the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least, "b").select("m", F.explode(F.array("a", "b")).alias("node"))
    return moved.filter("m <> node").select(F.col("m").alias("a"), F.col("node").alias("b"))
