"""Connected components of a graph of links, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, c): for each end of an edge but the smallest of its component, that smallest one.

    Large star and small star in turn (Kiveris et al., 2014), each round written to the shared folder, until the edges
    stay the same; rounds grow with the logarithm of a component's size. No component is ever held by one task.
    """
    now = materialize(edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("c")).filter("v <> c").distinct())
    mark = None
    while (seen := now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("v", "c").cast("decimal(38,0)")).alias("s")).first()) != mark:
        mark = seen
        both = now.union(now.select("c", "v")).toDF("u", "w")
        least = both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("w > u").join(least, "u").select(F.col("w").alias("v"), F.col("m").alias("c")).distinct()
        low = large.groupBy("v").agg(F.min("c").alias("m"))
        small = large.join(low, "v").filter("c <> m").select(F.col("c").alias("v"), F.col("m").alias("c")).union(low.select("v", F.col("m").alias("c")))
        now = materialize(small.filter("v <> c").distinct())
    return now
