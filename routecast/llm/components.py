"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.llm.common import written


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node in
    ``links`` (u, v). Each round hangs larger neighbours on the smallest one
    and writes the new links; it ends when nothing changes, after a number of
    rounds that grows with the logarithm of the largest component. A hub's
    rows are combined before they meet, and its joins are of the kind that
    adaptive execution splits."""
    links = links.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    state = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(spark, small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "links", slim=True)
        row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (row.n, row.x) == state:
            break
        state = (row.n, row.x)
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
