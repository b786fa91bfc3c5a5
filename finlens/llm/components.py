"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum and one join; links live in written tables, never on the driver.  A node with
very many links is one key of the join, which adaptive execution splits, and its minimum is partially
aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.llm.kit import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (u, v), u > v.  Large star: each node sends its greater neighbours to the least of its
    neighbours and itself; small star: each node sends its smaller neighbours and itself to the least."""
    both = links.union(links.select(F.col("v"), F.col("u"))) if large else links
    both = both.toDF("x", "y")
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    moved = both.join(least, "x")
    if large:
        out = moved.where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("y").alias("u"), F.col("m").alias("v")).union(
            least.select(F.col("x").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """links: two columns of comparable ids (any order, repeats and self-links allowed, nulls ignored).
    Returns (node, component): each linked node and the least node that it can reach."""
    a, b = (F.col(c) for c in links.columns[:2])
    now = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where("u is not null and v is not null and u <> v").distinct(), "links")
    seen = None
    for _ in range(rounds):
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if state == seen or not state[0]:
            break
        seen = state
        now = stored(_star(_star(now, True), False), "links")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
