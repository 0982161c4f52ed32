"""Clean tables bucketed by ticker and month.

Rows are dealt to a fixed number of buckets by (ticker, month) and sorted within them when they
are written, once.  De-duplication, the return window and an upsert all need rows of a (ticker,
month) together; on such tables Spark finds them so and shuffles nothing on the stored side.  A
ticker that holds a third of all rows is spread over its months.  The number of buckets is
fixed when a table is made: choose it from the table's bytes, about 256 MB a bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.operators import enrich, quality
from tickvault.sinks.files import path_exists

MONTH = "month"
KEYS = ["ticker", MONTH]


def bucket_count(stored_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    return max(1, -(-stored_bytes // bucket_bytes))


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, date_col: str = "date") -> None:
    """Store ``df`` as the catalog table ``table`` at ``path``; rows need a ticker and a date."""
    spark = df.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(path)
    rows = df.withColumn(MONTH, F.trunc(date_col, "month"))
    (rows.repartition(buckets, *KEYS).write.bucketBy(buckets, *KEYS).sortBy("ticker", date_col)
         .option("path", path).saveAsTable(table))


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    """The table with its bucketing; ``KEYS`` give its distribution."""
    return spark.table(table)


def dedup_bucketed(df: DataFrame, tiebreak: str | None = "src_id") -> DataFrame:
    """``quality.dedup_latest`` of a bucketed table: (ticker, date) lies within (ticker, month)."""
    kept = quality.dedup_latest(df, keys=("ticker", MONTH, "date"), tiebreak=tiebreak)
    return kept.select(*df.columns)


def daily_returns(df: DataFrame, tiebreak: str = "src_id") -> DataFrame:
    """``enrich.with_daily_return`` of a bucketed table; only the per-month summary is shuffled."""
    prev = enrich.lag_bucketed(df, ["ticker"], ["date", tiebreak], "close", "prev_close", F.col(MONTH))
    return prev.withColumn("daily_return", enrich.daily_return("close", "prev_close")).drop("prev_close")


__all__ = ["KEYS", "MONTH", "bucket_count", "daily_returns", "dedup_bucketed", "read_bucketed", "write_bucketed"]
