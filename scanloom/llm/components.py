"""Connected components of a table of links, by alternating stars.

Each round replaces links by links to the least neighbour, once seen from larger
and once from smaller ends, until nothing changes; that takes a number of rounds
in the order of the logarithm of the longest path. Least neighbours are minima
with partial sums, so a hub's links never gather in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import settled


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link in (a, b) to another but the least one of each component, which names it."""
    now = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = settled(now, "links")
    before = None
    while True:
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = settled(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links", now)
