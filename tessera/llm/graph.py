"""Connected components over a DataFrame of links, by minimum-label contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is its smallest node.

    Alternates large-star and small-star steps (Kiveris et al. 2014): each
    links a node's neighbours to the least of them, so stars form in
    O(log^2 n) rounds without a node's neighbours ever being collected; the
    minima are combinable aggregates.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = scratch.put(edges, f"{name}-0")
    step, last = 0, None
    while True:
        # The minima are tables of their own: Spark can split a join's hot key only where both sides are plain exchanges.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.put(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-large-{step}")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        step += 1
        large = scratch.put(large, f"{name}-{step}")
        least = scratch.put(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-small-{step}")
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        step += 1
        small = scratch.put(small, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}", f"{name}-{step - 2}", f"{name}-large-{step - 2}", f"{name}-small-{step - 1}")
        # Stars are a fixed point: every node has one, smaller neighbour that is itself a centre.
        state = small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            return small.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(small.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()).groupBy("node").agg(F.min("component").alias("component"))
        last, edges = state, small
