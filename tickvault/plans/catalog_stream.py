"""Registered streaming queries: the raw quotes arrive as Parquet files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickvault.operators import dims
from tickvault.operators.lookup import lookup_metadata
from tickvault.plans import oracle as O
from tickvault.plans.catalog import quotes, register, run_ts, silver, store
from tickvault.plans.constants import RUN_TS_ISO
from tickvault.session import work_path
from tickvault.sinks import tables
from tickvault.sources import fixtures
from tickvault.streaming import incremental as S


def arrivals(spark, d):
    """Two deliveries, each a folder of files: the odd rows, then the even ones,
    with dates all over the history and some (ticker, date) in both."""
    q = quotes(spark, d)
    return [q.where(F.col("src_id") % 2 != 0), q.where(F.col("src_id") % 2 == 0)]


@register("stream_clean", O.sql("SELECT * FROM clean", "clean"))
def q_stream_clean(spark, d):
    src, sink, ckpt = (work_path(spark, x) for x in ("landing", "clean", "checkpoint"))
    for k, rows in enumerate(arrivals(spark, d)):
        rows.write.parquet(f"{src}/part={k}")
        S.clean_stream(spark, src, fixtures.quotes_schema(), sink, ckpt).awaitTermination()
    return S.read_batches(spark, sink, fixtures.quotes_schema())


def run_silver(spark, d, after=None, **options) -> str:
    src, root, ckpt = (work_path(spark, x) for x in ("landing", "stream", "checkpoint"))
    meta = store(fixtures.meta(spark, d), "meta")
    for k, rows in enumerate(arrivals(spark, d)):
        rows.write.parquet(f"{src}/part={k}")
        S.silver_stream(spark, src, fixtures.quotes_schema(), root, ckpt, RUN_TS_ISO,
                        lambda clean: lookup_metadata(clean, meta), after, **options).awaitTermination()
    return root


@register("stream_silver", O.sql("SELECT * FROM silver", "silver"))
def q_stream_silver(spark, d):
    return S.read_silver(spark, run_silver(spark, d))


@register("stream_quarantine", O.sql(
    "SELECT src_id, failure_reason FROM flagged WHERE failure_reason IS NOT NULL UNION ALL "
    "SELECT src_id, 'duplicate_key' FROM clean WHERE src_id NOT IN (SELECT src_id FROM dedup)", "dedup"))
def q_stream_quarantine(spark, d):
    """Rejected and duplicate rows of both deliveries, each once."""
    root = run_silver(spark, d)
    rejected, duplicates = (S.read_batches(spark, f"{root}/{x}") for x in ("rejected", "duplicates"))
    return rejected.select("src_id", "failure_reason").unionAll(duplicates.select("src_id", "failure_reason"))


LATENESS_DAYS = 1500
_LATE = f"""src_id % 2 = 0 AND date < (SELECT MAX(date) FROM clean WHERE src_id % 2 <> 0) - INTERVAL {LATENESS_DAYS} DAY"""
_ON_TIME = {"on_time": f"SELECT * FROM quotes WHERE NOT COALESCE({_LATE}, FALSE)", **O.chain("on_time", "l_")}


@register("stream_on_time", O.sql("SELECT * FROM l_silver", "clean", "meta", extra=_ON_TIME))
def q_stream_on_time(spark, d):
    """The clean table of a stream with a lateness bound: rows of the second delivery that are too
    old for it have no part in it."""
    return S.read_silver(spark, run_silver(spark, d, lateness_days=LATENESS_DAYS))


@register("stream_late", O.sql(
    f"SELECT src_id, failure_reason FROM flagged WHERE failure_reason IS NOT NULL "
    f"UNION ALL SELECT src_id, 'late' FROM clean WHERE {_LATE}", "clean"))
def q_stream_late(spark, d):
    """What that stream rejects: faulty rows and late ones, each with its reason."""
    return S.read_batches(spark, f"{run_silver(spark, d, lateness_days=LATENESS_DAYS)}/rejected").select("src_id", "failure_reason")


@register("stream_fact", O.sql("SELECT * FROM fact", "fact"))
def q_stream_fact(spark, d):
    path = work_path(spark, "fact")
    tickers = store(dims.dim_ticker(silver(spark, d), run_ts()), "dim_ticker")
    run_silver(spark, d, S.fact_updates(path, dims.dim_date(spark), tickers, run_ts()))
    return tables.read_table(spark, path)
