"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` -> ``root`` (the smallest node reachable) for every node that
    is not its own root.

    ``edges`` has two comparable columns a, b of any number of repeats.  Each
    round points a node's neighbours at the smallest of them with one grouped
    minimum and one join, and is written out, so neither a node with many
    neighbours nor a large component meets in one task.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                      F.least("a", "b").alias("v")).distinct()
    e, before = written(e, "components"), None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # read from a table, the minima do not tie the edges to their own partitioning,
        # and Spark may split the edges of one node over tasks
        low = written(both.groupBy("u").agg(F.min("v").alias("m"))
                      .select("u", F.least("u", "m").alias("m")), "components-low")
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"),
                                                            F.col("m").alias("v"))).distinct()
        large = written(large, "components")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "components-low")
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"),
                                                             F.col("m").alias("v"))
        e = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "components")
