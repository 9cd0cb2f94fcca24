"""Connected components over a table of links, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_lake.llm.common import cut


def _digest(e: DataFrame) -> tuple:
    """Two numbers that tell whether a round changed the links."""
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; ``root`` is the smallest node it reaches.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each step is one
    aggregation per node and one join, and the links shrink to stars in a logarithmic
    number of rounds.  Lineage is cut once a round in the shared checkpoint folder.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e, seen = cut(e), None
    while (now := _digest(e)) != seen:
        seen = now
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u goes to the smallest node around u
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low2, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .unionAll(low2.select("u", F.col("m").alias("v"))).distinct()
        e = cut(small)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
