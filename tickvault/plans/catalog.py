"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Every query reads the supplied tables (``orders``/``customer`` through the
``quotes``/``meta`` fixtures) over their whole extent.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickvault.operators import dims, enrich, fact, quality
from tickvault.operators.lookup import lookup_metadata
from tickvault.plans import oracle as O
from tickvault.plans.constants import RUN_TS, RUN_TS_ISO
from tickvault.session import work_path
from tickvault.sources import fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLES[name] = oracle_sql
        return fn
    return deco


def run_ts() -> F.Column:
    return F.lit(dt.datetime.fromisoformat(RUN_TS))


# ---- shared building blocks -------------------------------------------------

def quotes(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.quotes(spark, d)


def clean(spark: SparkSession, d: str) -> DataFrame:
    return quality.clean_rows(quotes(spark, d))


def deduped(spark: SparkSession, d: str) -> DataFrame:
    return quality.dedup_latest(clean(spark, d))


def silver_from(raw: DataFrame, spark: SparkSession, d: str,
                processed_at: str = RUN_TS_ISO) -> DataFrame:
    """Raw rows -> clean -> dedup -> reference lookup -> daily return, range, lineage."""
    enriched = lookup_metadata(quality.dedup_latest(quality.clean_rows(raw)), fixtures.meta(spark, d))
    return enrich.enrich_silver(enriched, processed_at, tiebreak=["src_id"])


def silver(spark: SparkSession, d: str) -> DataFrame:
    return silver_from(quotes(spark, d), spark, d)


def wide_silver(spark: SparkSession, d: str) -> DataFrame:
    """The clean layer over fifty tickers, for tables with a folder per ticker."""
    rows = quality.dedup_latest(quality.clean_rows(fixtures.wide_quotes(spark, d)))
    return enrich.enrich_silver(lookup_metadata(rows, fixtures.wide_meta(spark, d)), RUN_TS_ISO, tiebreak=["src_id"])


def store(df: DataFrame, name: str, counts: dict | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: later
    steps read the stored rows instead of recomputing (and the lineage is cut).
    With ``counts``, the written row count is observed into ``counts[name]``."""
    path = work_path(df.sparkSession, name)
    if counts is None:
        df.write.parquet(path)
    else:
        obs = Observation(name)
        df.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(path)
        counts[name] = obs.get["n"]
    return df.sparkSession.read.parquet(path)


def stored_gold(spark: SparkSession, d: str) -> dict:
    """Clean table and dimensions stored once, as the pipeline keeps them,
    with the dimension sizes (for broadcast decisions without counting)."""
    sizes: dict[str, int] = {"dim_date": dims.dim_date_rows()}
    s = store(silver(spark, d), "silver")
    # The calendar is generated in parallel from its date range: cheaper to
    # regenerate than to store and read.
    return {"silver": s, "dim_date": dims.dim_date(spark),
            "dim_ticker": store(dims.dim_ticker(s, run_ts()), "dim_ticker", sizes),
            "sizes": sizes}


def dim_ticker(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_ticker(silver(spark, d), run_ts())


def fact_rows(spark: SparkSession, d: str) -> DataFrame:
    g = stored_gold(spark, d)
    return fact.fact_prices(g["silver"], g["dim_date"], g["dim_ticker"], run_ts(), g["sizes"])


# ---- quality ------------------------------------------------------------------

@register("dq_flag", O.sql("SELECT * FROM flagged", "flagged"))
def q_dq_flag(spark, d):
    return quality.flag(quotes(spark, d))


@register("dq_clean", O.sql("SELECT * FROM clean", "clean"))
def q_dq_clean(spark, d):
    return clean(spark, d)


@register("dq_rejected", O.sql("SELECT * FROM flagged WHERE failure_reason IS NOT NULL", "flagged"))
def q_dq_rejected(spark, d):
    return quality.rejected_rows(quotes(spark, d))


@register("dq_breakdown", O.sql(
    "SELECT failure_reason, COUNT(*) AS rows FROM flagged WHERE failure_reason IS NOT NULL "
    "GROUP BY failure_reason", "flagged"))
def q_dq_breakdown(spark, d):
    return quality.breakdown(quality.rejected_rows(quotes(spark, d)))


@register("dq_metrics", O.sql(
    """SELECT COUNT(*) AS total_rows, COUNT_IF(failure_reason IS NULL) AS clean_rows,
       COUNT_IF(failure_reason IS NOT NULL) AS rejected_rows,
       COUNT_IF(failure_reason = 'null_in_critical_column') AS null_in_critical_column,
       COUNT_IF(failure_reason = 'non_positive_price') AS non_positive_price,
       COUNT_IF(failure_reason = 'negative_volume') AS negative_volume,
       COUNT_IF(failure_reason = 'ohlc_inconsistency') AS ohlc_inconsistency FROM flagged""",
    "flagged"))
def q_dq_metrics(spark, d):
    return quality.metrics(quality.flag(quotes(spark, d)))


@register("dedup_latest", O.sql("SELECT * FROM dedup", "dedup"))
def q_dedup_latest(spark, d):
    return deduped(spark, d)


@register("dq_duplicates", O.sql(
    "SELECT c.*, 'duplicate_key' AS failure_reason FROM clean c "
    "WHERE c.src_id NOT IN (SELECT src_id FROM dedup)", "clean", "dedup"))
def q_dq_duplicates(spark, d):
    c = clean(spark, d)
    return quality.duplicate_rows(c, quality.dedup_latest(c))


# ---- windowed enrichment -------------------------------------------------------

@register("daily_return", O.sql(
    """SELECT src_id, ticker, date, close,
       ROUND((close - LAG(close) OVER w) / LAG(close) OVER w, 6) AS daily_return
       FROM dedup WINDOW w AS (PARTITION BY ticker ORDER BY date, src_id)""", "dedup"))
def q_daily_return(spark, d):
    out = enrich.with_daily_return(deduped(spark, d), tiebreak=["src_id"])
    return out.select("src_id", "ticker", "date", "close", "daily_return")


@register("price_range", O.sql(
    "SELECT src_id, ticker, date, high, low, ROUND(high - low, 4) AS price_range FROM clean", "clean"))
def q_price_range(spark, d):
    return enrich.with_price_range(clean(spark, d)).select(
        "src_id", "ticker", "date", "high", "low", "price_range")


@register("silver_enriched", O.sql("SELECT * FROM silver", "silver"))
def q_silver(spark, d):
    return silver(spark, d)


# ---- dimensions and fact -------------------------------------------------------

_DIM_DATE_SPAN = O.CTES["dim_date"].replace(
    "generate_series(TIMESTAMP '2015-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)",
    "generate_series((SELECT CAST(MIN(date) AS TIMESTAMP) FROM quotes), "
    "(SELECT CAST(MAX(date) AS TIMESTAMP) FROM quotes), INTERVAL 1 DAY)")


@register("dim_date", O.sql("SELECT * FROM dim_date_span", "quotes",
                            extra={"dim_date_span": _DIM_DATE_SPAN}))
def q_dim_date(spark, d):
    """Calendar attributes for every day of the quotes' date span."""
    return dims.dim_date_spanning(quotes(spark, d))


@register("dim_ticker", O.sql("SELECT * FROM dim_ticker", "dim_ticker"))
def q_dim_ticker(spark, d):
    return dim_ticker(spark, d)


@register("fact_prices", O.sql("SELECT * FROM fact", "fact"))
def q_fact_prices(spark, d):
    return fact_rows(spark, d)


# Register the remaining query groups.
from tickvault.plans import catalog_raw  # noqa: E402,F401
from tickvault.plans import catalog_gold, catalog_io  # noqa: E402,F401
from tickvault.plans import catalog_runs, catalog_stream  # noqa: E402,F401
