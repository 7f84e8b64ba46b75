"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.operators.skew import lookup_join
from newslens.settings import stored


def _star(links: DataFrame) -> DataFrame:
    """(u, v): every v hangs on the smallest neighbour of u."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return lookup_join(links, least, ["u"], ["v"], "inner")


def _step(links: DataFrame) -> DataFrame:
    """A large star, then a small one; ``links`` are (u, v) with u > v, distinct."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _star(both).where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    found = _star(large)
    own = found.where("u > m").select("u", F.col("m").alias("v"))
    others = found.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(others).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node that has a link.

    ``links`` has long columns u and v. Each step is written, so that a lost executor
    repeats one step; the steps grow with the logarithm of the longest chain.
    """
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(ordered.distinct(), "links")
    print_of = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while print_of[0]:
        then = stored(_step(now), "links")
        new = then.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now, print_of, before = then, new, print_of
        if new == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
