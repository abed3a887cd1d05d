"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retentia.llm.common import stored


def _starred(neighbours: DataFrame) -> DataFrame:
    """``u``, ``v`` and the least of u and all its v; an aggregation and an equi join, so a hub can be split."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("_least"))
    return neighbours.join(least, "u").withColumn("_least", F.least("u", "_least"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``root`` (least node reachable) for every node of the links, which are numbers.

    Each round rewires links towards smaller neighbours and is written to the shared folder; the number
    of rounds grows with the logarithm of the longest chain. Nothing but a fingerprint of the links
    reaches the driver.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges, before = stored(edges, "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _starred(both).filter("v > u").select(F.col("v").alias("u"), F.col("_least").alias("v")).filter("u > v").distinct()
        small = _starred(large)
        hooked = small.select(F.col("v").alias("u"), F.col("_least").alias("v"))
        centres = small.select("u", F.col("_least").alias("v"))
        edges = stored(hooked.unionByName(centres).filter("u > v").distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
