"""Connected components of a link table by alternating star contraction (Kiveris et al., 2014)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.sources.lake import staged


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of numbered nodes -> (node, component), the least node reachable, for every
    node that has a link to another. Every round is a written table; no round gathers a node's
    links in one place: minima combine before the shuffle and joins split at busy nodes."""
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = staged(pairs.filter("u > v").distinct(), "links")
    before = None
    while True:
        after = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = after
        pairs = staged(small_star(staged(large_star(pairs), "links")), "links")


def large_star(pairs: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its least neighbour."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.distinct()


def small_star(pairs: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are linked to the least of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    out = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return out.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
