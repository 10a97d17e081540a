"""Connected components by alternating large and small stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import Scratch


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the least node reachable) of every node of ``edges(a, b)``.

    Each round joins neighbours to their least neighbour, first the larger ones, then the
    rest, so that chains shorten by about half; a node of very many links is only reduced
    to a least value by partial aggregates. The rounds end when no edge changes.
    """
    now = scratch.keep(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        ends = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ends.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        now = scratch.keep(small.filter("u <> v").distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
    return now.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
