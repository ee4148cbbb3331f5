"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crewcast.llm.storage import stored


def _nearest(edges: DataFrame) -> DataFrame:
    """Every directed edge (u, v) with the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("m", "u"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _nearest(both).filter("v > u AND v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    seen = _nearest(edges)
    others = seen.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(seen.select("u", F.col("m").alias("v"))).distinct()


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in a link to a smaller id; the component is its smallest id.

    Each round is written to the shared folder. Every component is a star after a number of rounds
    that grows with the logarithm of its size; the loop ends when a round changes nothing.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges, before = stored(edges), None
    while True:
        stars = stored(_small(_large(edges)))
        after = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("u").cast("decimal(38,0)"))).first()
        if after == before:
            return stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
        edges, before = stars, after
