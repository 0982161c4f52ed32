"""Windowed derived columns: previous close, daily return, price range."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickvault.functions.prices import daily_return, price_range

_BUCKET = "_lag_bucket"
_PREV_BUCKET_LAST = "_prev_bucket_last"


def month_bucket(date_col: str = "date") -> Column:
    return F.trunc(F.col(date_col), "month")


def lag_bucketed(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                 value_col: str, out_col: str, bucket: Column, earlier: DataFrame | None = None) -> DataFrame:
    """``lag(value_col, 1) OVER (PARTITION BY partition_cols ORDER BY order_cols)``
    computed without putting a whole key into one task.

    ``bucket`` must be non-decreasing in ``order_cols`` (e.g. the month of the
    date).  The window runs per (key, bucket), so a key holding a third of all
    rows is spread over its buckets.  The first row of a bucket takes the last
    value of the key's previous non-empty bucket, found on a per-bucket summary
    (one row per key and bucket, partial-aggregated before its shuffle).  The
    summary is joined on the window's own partition keys, so the big input is
    shuffled once.  Partition and order columns must be non-NULL.

    ``earlier``: the last rows (partition, order and value columns) of further buckets, which
    ``df`` has no rows of; they join the summary alone.
    """
    keys = [*partition_cols, _BUCKET]
    d = df.withColumn(_BUCKET, bucket)
    order = F.struct(*[F.col(c) for c in order_cols])
    last = d.groupBy(*keys).agg(F.max_by(F.col(value_col), order).alias("_bucket_last"))
    if earlier is not None:
        last = last.unionByName(earlier.withColumn(_BUCKET, bucket).select(*keys, F.col(value_col).alias("_bucket_last")))
    prev = (last.withColumn(_PREV_BUCKET_LAST,
                            F.lag("_bucket_last").over(
                                Window.partitionBy(*partition_cols).orderBy(_BUCKET)))
                .drop("_bucket_last"))
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    out = (d.join(prev, keys, "left")
            .withColumn(out_col, F.when(F.row_number().over(w) == 1, F.col(_PREV_BUCKET_LAST))
                                  .otherwise(F.lag(value_col).over(w))))
    return out.drop(_BUCKET, _PREV_BUCKET_LAST).select(*df.columns, out_col)


def with_prev_close(df: DataFrame, key: str = "ticker", date_col: str = "date",
                    tiebreak: Sequence[str] = (), value_col: str = "close",
                    out_col: str = "prev_close", earlier: DataFrame | None = None) -> DataFrame:
    """Previous accepted close per ticker in date order (W1); ``earlier`` has the last rows of months
    that aren't in ``df``."""
    return lag_bucketed(df, [key], [date_col, *tiebreak], value_col, out_col,
                        month_bucket(date_col), earlier)


def with_daily_return(df: DataFrame, key: str = "ticker", date_col: str = "date",
                      tiebreak: Sequence[str] = ()) -> DataFrame:
    """Adds ``daily_return`` = round((close - prev_close) / prev_close, 6)."""
    return (with_prev_close(df, key, date_col, tiebreak)
            .withColumn("daily_return", daily_return("close", "prev_close"))
            .drop("prev_close"))


def with_price_range(df: DataFrame) -> DataFrame:
    return df.withColumn("price_range", price_range("high", "low"))


def enrich_silver(clean: DataFrame, processed_at: str, key: str = "ticker",
                  date_col: str = "date", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Clean rows -> silver rows: daily_return, price_range, processed_at, layer."""
    out = with_price_range(with_daily_return(clean, key, date_col, tiebreak))
    return out.withColumns({"processed_at": F.lit(processed_at),
                            "layer": F.lit("silver")})
