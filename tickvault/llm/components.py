"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import stage_measured


def _stored(edges: DataFrame) -> tuple[DataFrame, dict]:
    """Edges written to the shared folder; their number and hash come from the write itself."""
    return stage_measured(edges, "edges", n=F.count("*"), h=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node of its component) of every node in ``edges`` (a, b: long).

    Every step is a grouped minimum (summed map-side) and a join back, written to the shared
    folder in one job, so neither lineage nor driver memory grows with the number of steps.
    Steps go on until one changes nothing; their number grows with the logarithm of a
    component's length.
    """
    now, was = _stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while was.get("n"):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))       # edges point downwards: b < a
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")) \
            .select("e.a", "e.b").where("a <> b").distinct()
        now, seen = _stored(small)
        if seen == was:
            break
        was = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")) \
        .unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
