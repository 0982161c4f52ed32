"""Date-series generator (S6): inclusive bounds, one-day step."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The date dimension's default range.
DIM_DATE_START = "2015-01-01"
DIM_DATE_END = "2030-12-31"


def date_series(spark: SparkSession, start: str = DIM_DATE_START, end: str = DIM_DATE_END,
                name: str = "full_date") -> DataFrame:
    """One row per day in [start, end], generated in parallel by ``range``."""
    lo = dt.date.fromisoformat(start)
    hi = dt.date.fromisoformat(end)
    n = (hi - lo).days + 1
    return spark.range(0, max(n, 0)).select(
        F.date_add(F.lit(lo), F.col("id").cast("int")).alias(name))


def date_series_between(bounds: DataFrame, lo: str | Column, hi: str | Column,
                        name: str = "full_date") -> DataFrame:
    """Days between two DATE columns of each row of ``bounds`` (inclusive).

    Used when the range comes from data (e.g. min/max of a table); the array
    per row is as long as the calendar span, not the row count.
    """
    lo = F.col(lo) if isinstance(lo, str) else lo
    hi = F.col(hi) if isinstance(hi, str) else hi
    return bounds.where(lo.isNotNull() & hi.isNotNull()).select(
        F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias(name))
