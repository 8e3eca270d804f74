"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.sources.writers import Scratch, stored


def connected_components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``node, root`` for each node of ``edges (a, b)``; the root is the component's least node.

    Each step is a minimum with partial sums and a join on the node, so a hub is not gathered in
    a task.  Steps stop when one leaves the edges as they are; each is written, so lost executors
    do not repeat earlier ones.  Nodes without a link to another node have no row.  With ``scratch``
    a step's table is dropped once the next is written.
    """
    store = scratch.store if scratch else stored
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = store(now, "components")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        before, now = now, store(small.where("u <> v").distinct(), "components")
        if scratch:
            scratch.drop(before)
