"""Derived price columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def daily_return(close: str | Column = "close", prev_close: str | Column = "prev_close") -> Column:
    """round((close - prev) / prev, 6); NULL on the first row and for prev = 0."""
    close = F.col(close) if isinstance(close, str) else close
    prev = F.col(prev_close) if isinstance(prev_close, str) else prev_close
    return F.round(F.try_divide(close - prev, prev), 6)


def price_range(high: str = "high", low: str = "low") -> Column:
    return F.round(F.col(high) - F.col(low), 4)
