"""Connected components of a table of links, as a loop of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept


def components(links: DataFrame) -> DataFrame:
    """(id, root) for each id in the links (a, b): root is the smallest id it reaches.

    Alternates large-star and small-star steps: every node hands its larger
    neighbours, then its smaller ones, to the smallest it knows, until only
    stars are left; that takes a number of rounds that grows with the
    logarithm of the component sizes. Each round is checkpointed in the
    shared folder. The minima are checkpointed before they meet the links, so
    that Spark can split the join at a node with many links. An empty table
    gives an empty result; links with a null end or equal ends are ignored.
    """
    stars = kept(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
        if now == before or not now[0]:
            break
        before = now
        both = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(stars.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = kept(large)
        near = kept(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(near, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(near.select("a", F.col("m").alias("b")))
        stars = kept(small.where("a <> b").distinct())
    roots = stars.select(F.col("b").alias("id")).distinct().withColumn("root", F.col("id"))
    return stars.select(F.col("a").alias("id"), F.col("b").alias("root")).unionAll(roots)
