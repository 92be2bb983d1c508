"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewright.llm.common import discard, settle


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (`large`) or the smaller neighbours of every node to its smallest neighbour."""
    if large:
        links = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    met = links.join(least, "u")
    if large:
        return met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node it reaches) for every node of `links` (u, v: long) that is not a root.

    Large-star and small-star rounds, each reduced before its shuffle and written to the shared folder;
    the driver sees a count and a checksum of each round.
    """
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        known, links = links, settle(_stars(_stars(links, True).distinct(), False).distinct(), "components")
        if before is not None:
            discard(known)
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
