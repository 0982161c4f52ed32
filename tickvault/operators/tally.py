"""Per-ticker ingest outcome: tally and failed list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ingest_tally(requested: DataFrame, ingested: DataFrame, key: str = "ticker") -> DataFrame:
    """One row per requested ticker: rows ingested and success / failed."""
    counts = ingested.groupBy(key).agg(F.count(F.lit(1)).alias("rows_ingested"))
    out = requested.select(key).distinct().join(counts, key, "left")
    n = F.coalesce(F.col("rows_ingested"), F.lit(0)).cast("bigint")
    return out.select(key, n.alias("rows_ingested"),
                      F.when(n > 0, "success").otherwise("failed").alias("status"))


def failed_tickers(requested: DataFrame, ingested: DataFrame, key: str = "ticker") -> DataFrame:
    """Requested tickers that produced no rows (requested minus ingested)."""
    return requested.select(key).distinct().join(ingested.select(key).distinct(), key, "left_anti")


def rows_per_day(df: DataFrame, key: str = "ticker", date_col: str = "date") -> DataFrame:
    """Rows of a batch per (ticker, trading day): the per-day groups a daily
    layout writes as one folder each (A6, A7)."""
    return (df.groupBy(key, F.to_date(F.col(date_col)).alias(date_col))
              .agg(F.count(F.lit(1)).alias("rows")))
