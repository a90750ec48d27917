"""Connected components of a table of links, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.llm.storage import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's least neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked with the least of them.  Links have a < b."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    joined = links.join(least, "b")
    return (
        joined.select(F.col("m").alias("a"), F.col("a").alias("b"))
        .unionByName(joined.select(F.col("m").alias("a"), "b"))
        .filter("a < b")
        .distinct()
    )


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of links(a, b); component is the least node that is reachable.

    Alternating large-star and small-star steps (Kiveris et al., 2014).  Each
    round is written to the shared folder.  Links are two numbers, so a centre of
    very many is left to the planner's splitting of skewed joins.  The only figures that come to the
    driver are a count and a hash sum, which tell whether a round changed
    anything.  Loops, nulls and repeated links are ignored; an empty table gives
    an empty one.
    """
    now = materialise(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a < b")
        .distinct(),
        "links",
    )
    digest = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    seen = tuple(now.agg(*digest).first())
    for _ in range(max_rounds):
        now = materialise(_small_star(_large_star(now)), "links")
        got = tuple(now.agg(*digest).first())
        if got == seen:
            break
        seen = got
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (
        now.select(F.col("b").alias("node"), F.col("a").alias("component"))
        .unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")))
        .distinct()
    )
