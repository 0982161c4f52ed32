"""Counts and extremes of stored tables from their Parquet footers (A1, A4, O3).

Parquet keeps the minimum, maximum and number of values of each column chunk.  Spark's second
Parquet source answers such aggregates from the footers alone; its settings are made in a
session of their own, so the caller's scans stay as they are.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Types whose footer statistics are exact and ordered as Spark orders them.
ORDERED = frozenset("boolean tinyint smallint int bigint float double date".split())


def footer_stats(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row: ``n`` rows, and ``min_c`` / ``max_c`` of each column; no data page is read."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = own.read.parquet(path)
    wrong = [c for c in columns if table.schema[c].dataType.simpleString() not in ORDERED]
    if wrong:
        raise ValueError(f"no exact footer statistics for {wrong}")
    found = table.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{k}_{c}") for c in columns for k, f in (("min", F.min), ("max", F.max))])
    # Pushed down, a count is a sum of the files' counts: NULL without a row group, though Spark
    # takes it for never NULL, so that coalesce would be dropped.
    return found.withColumn("n", F.when(F.col("n") > 0, F.col("n")).otherwise(F.lit(0).cast("long")))


def is_empty(spark: SparkSession, path: str) -> bool:
    """The emptiness test (O3) of a stored table, by its footers."""
    return footer_stats(spark, path, []).first()["n"] in (None, 0)


__all__ = ["ORDERED", "footer_stats", "is_empty"]
