"""Star join of clean prices to the dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.operators.lookup import broadcast_if_bounded

FACT_KEYS = ["date_key", "ticker_key"]

RENAMES = [("open", "open_price"), ("high", "high_price"), ("low", "low_price"),
           ("close", "close_price"), ("adj_close", "adj_close_price"), ("volume", "volume"),
           ("daily_return", "daily_return"), ("price_range", "price_range")]


def fact_prices(silver: DataFrame, dim_date: DataFrame, dim_ticker: DataFrame,
                created_at: Column | None = None,
                dim_rows: dict[str, int] | None = None) -> DataFrame:
    """Inner joins on full_date = date and ticker_symbol = ticker.

    Both dimensions are broadcast only after a row-count check (a calendar
    has one row per day of its range, the ticker dimension one per ticker).
    Rows outside the calendar or without a ticker row are dropped, as an
    inner join does.  ``dim_rows`` holds known row counts
    (``{"dim_date": n, "dim_ticker": m}``) to skip the checks.
    """
    ts = created_at if created_at is not None else F.current_timestamp()
    known = dim_rows or {}
    dd = broadcast_if_bounded(dim_date.select("date_key", "full_date"),
                              known_rows=known.get("dim_date"))
    dt = broadcast_if_bounded(dim_ticker.select("ticker_key", "ticker_symbol"),
                              known_rows=known.get("dim_ticker"))
    s = silver.select("date", "ticker", *[src for src, _ in RENAMES])
    joined = (s.join(dd, s["date"] == dd["full_date"], "inner")
               .join(dt, s["ticker"] == dt["ticker_symbol"], "inner"))
    return joined.select("date_key", "ticker_key",
                         *[F.col(src).alias(dst) for src, dst in RENAMES],
                         ts.alias("created_at"))
