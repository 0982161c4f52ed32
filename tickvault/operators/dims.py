"""Date and ticker dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.functions.calendar import calendar_columns
from tickvault.operators.keys import global_row_number
from tickvault.sources.calendar import (DIM_DATE_END, DIM_DATE_START, date_series,
                                        date_series_between)

DIM_TICKER_ATTRS = ["company_name", "sector", "exchange"]
# Fixed value: the currency every ticker is quoted in.
CURRENCY = "USD"


def calendar(days: DataFrame, col: str = "full_date", padded_names: bool = True) -> DataFrame:
    """Calendar attributes for a one-column DataFrame of dates."""
    return days.select(*calendar_columns(F.col(col), padded_names))


def dim_date(spark: SparkSession, start: str = DIM_DATE_START, end: str = DIM_DATE_END,
             padded_names: bool = True) -> DataFrame:
    """The date dimension over a fixed inclusive range (5,844 rows by default)."""
    return calendar(date_series(spark, start, end), padded_names=padded_names)


def dim_date_rows(start: str = DIM_DATE_START, end: str = DIM_DATE_END) -> int:
    """Row count of ``dim_date(start, end)``: one per day."""
    import datetime as dt
    return (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1


def dim_date_spanning(df: DataFrame, date_col: str = "date", padded_names: bool = True) -> DataFrame:
    """The date dimension over the span [min(date), max(date)] of a table."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return calendar(date_series_between(bounds, "lo", "hi"), padded_names=padded_names)


def dim_ticker(silver: DataFrame, created_at: Column | None = None) -> DataFrame:
    """DISTINCT ticker attributes, keyed by ROW_NUMBER() in ticker order.

    A ticker whose attributes changed yields one row per version (as the
    reference does); ``dim_ticker_type1`` keeps one row per ticker.
    """
    ts = created_at if created_at is not None else F.current_timestamp()
    src = (silver.where(F.col("ticker").isNotNull())
                 .select(F.col("ticker").alias("ticker_symbol"), *DIM_TICKER_ATTRS)
                 .distinct())
    keyed = global_row_number(src, ["ticker_symbol", *DIM_TICKER_ATTRS], "ticker_key")
    return keyed.select(
        "ticker_key", "ticker_symbol", "company_name", "sector",
        F.lit(None).cast("string").alias("industry"), "exchange",
        F.lit(CURRENCY).alias("currency"),
        ts.alias("created_at"), ts.alias("updated_at"))


def dim_ticker_type1(silver: DataFrame, existing: DataFrame | None = None,
                     updated_at: Column | None = None, version_col: str = "ingested_at") -> DataFrame:
    """Type-1 ticker dimension: one row per ticker, latest attributes win, keys stable.

    Tickers already in ``existing`` keep their key and ``created_at``; new
    tickers are numbered after the current maximum key in ticker order.
    """
    ts = updated_at if updated_at is not None else F.current_timestamp()
    latest = (silver.where(F.col("ticker").isNotNull())
                    .groupBy(F.col("ticker").alias("ticker_symbol"))
                    .agg(F.max_by(F.struct(*DIM_TICKER_ATTRS),
                                  F.struct(F.col(version_col), *[F.col(a) for a in DIM_TICKER_ATTRS]))
                          .alias("_a"))
                    .select("ticker_symbol", *[F.col(f"_a.{a}").alias(a) for a in DIM_TICKER_ATTRS]))
    if existing is None:
        keyed = global_row_number(latest, ["ticker_symbol"], "ticker_key")
        keyed = keyed.withColumn("created_at", ts)
    else:
        old = existing.select("ticker_symbol", "ticker_key", "created_at")
        known = latest.join(old, "ticker_symbol", "inner")
        new = latest.join(old, "ticker_symbol", "left_anti")
        # The current maximum key is one scalar; it is read once and used as a literal.
        base = existing.agg(F.max("ticker_key")).first()[0] or 0
        numbered = global_row_number(new, ["ticker_symbol"], "_rn")
        new_keyed = (numbered.withColumn("ticker_key", (F.lit(base) + F.col("_rn")).cast("bigint"))
                             .drop("_rn").withColumn("created_at", ts))
        keyed = known.unionByName(new_keyed)
        # Tickers no longer in the source stay in the dimension unchanged.
        gone = existing.join(latest.select("ticker_symbol"), "ticker_symbol", "left_anti")
        keyed = keyed.unionByName(gone.select("ticker_symbol", *DIM_TICKER_ATTRS,
                                              "ticker_key", "created_at"))
    return keyed.select(
        "ticker_key", "ticker_symbol", "company_name", "sector",
        F.lit(None).cast("string").alias("industry"), "exchange",
        F.lit(CURRENCY).alias("currency"), "created_at", ts.alias("updated_at"))
