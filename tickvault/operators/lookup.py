"""Reference-table lookups and size-checked broadcast."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side we broadcast, in bytes.
BROADCAST_MAX_BYTES = 32 << 20


def estimated_bytes(df: DataFrame, known_rows: int | None = None) -> int:
    """Size of ``df``: a known row count times the schema's row width, else the
    optimizer's estimate from file sizes (an upper bound for filters and
    projections).  Runs no job."""
    if known_rows is not None:
        return known_rows * int(df._jdf.schema().defaultSize())
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_bounded(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES, known_rows: int | None = None) -> bool:
    return estimated_bytes(df, known_rows) <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES,
                         known_rows: int | None = None) -> DataFrame:
    """Broadcast hint only behind a check of the size in bytes; otherwise the
    planner (AQE, with its own runtime threshold) picks the join.  A caller
    that knows the row count (observed when the table was written, or a
    calendar's day count) passes ``known_rows``."""
    return F.broadcast(df) if is_bounded(df, max_bytes, known_rows) else df


def lookup_metadata(df: DataFrame, meta: DataFrame, key: str = "ticker",
                    fields: Sequence[str] = ("company_name", "sector", "exchange"),
                    default: str = "", max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left join to the reference table; unknown keys get ``default`` ('' not NULL)."""
    m = meta.select(F.col(key).alias("_mkey"), *[F.col(f).alias(f"_m_{f}") for f in fields])
    m = broadcast_if_bounded(m, max_broadcast_bytes)
    base = df.drop(*[f for f in fields if f in df.columns])
    joined = base.join(m, base[key] == m["_mkey"], "left")
    return joined.select(*base.columns,
                         *[F.coalesce(F.col(f"_m_{f}"), F.lit(default)).alias(f) for f in fields])
