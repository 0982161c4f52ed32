"""Registered queries of whole runs: stopped ones, late ones, and ones with stamps out of order."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tickvault.operators import dims, fact, months
from tickvault.operators.lookup import lookup_metadata
from tickvault.plans import oracle as O
from tickvault.plans import warehouse
from tickvault.plans.catalog import clean, deduped, quotes, register, run_ts, silver, store
from tickvault.plans.constants import RUN_TS
from tickvault.schemas import RAW_SCHEMA, enforce_schema
from tickvault.session import work_path
from tickvault.sinks import bucketed, files, tables
from tickvault.sources import fixtures, landing

SPLIT = dt.date(2018, 1, 1)


def raw_rows(rows, spark, d):
    """Fixture rows with the raw table's columns, whole tickers, metadata looked up."""
    return enforce_schema(lookup_metadata(rows, fixtures.meta(spark, d)), RAW_SCHEMA, keep_extra=False)


# ---- commit numbers as the mark ----------------------------------------------------

_STAMPS = [dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 4, 6), dt.datetime(2024, 1, 4, 6)]
_FACT_COLUMNS = ["date_key", "open_price", "high_price", "low_price", "close_price", "adj_close_price", "volume",
                 "daily_return", "price_range"]


@register("fact_out_of_order_runs", O.sql(
    f"SELECT dt.ticker_symbol, {', '.join('f.' + c for c in _FACT_COLUMNS)} FROM fact f JOIN dim_ticker dt USING (ticker_key)", "fact"))
def q_out_of_order(spark, d):
    """Three runs, the second stamped before the first and the third like the second; the first
    brings rows of 2018 on, the others earlier ones.  Every row reaches the fact, and so do the
    returns that earlier rows change."""
    paths = warehouse.Paths(work_path(spark, "warehouse"))
    rows = store(raw_rows(deduped(spark, d), spark, d), "rows")
    early = rows.where(F.col("date") < F.lit(SPLIT))
    parts = [rows.where(F.col("date") >= F.lit(SPLIT)), early.where(F.month("date") % 2 == 0), early]
    for k, (part, stamp) in enumerate(zip(parts, _STAMPS)):
        run = warehouse.Run(f"run{k}", stamp, silver_layout="month", changed_only=True)
        warehouse.ingest_rows(spark, part, paths, run)
        warehouse.build_silver(spark, paths, run)
        warehouse.build_gold(spark, paths, run)
    keys = spark.read.parquet(paths.dim_ticker).select("ticker_key", "ticker_symbol")
    return tables.read_table(spark, paths.fact).join(keys, "ticker_key").select("ticker_symbol", *_FACT_COLUMNS)


# ---- a stopped run -------------------------------------------------------------------

_ORDERED = """SELECT ticker, ROW_NUMBER() OVER (ORDER BY first >= DATE '2018-01-01', ticker) AS k
              FROM (SELECT ticker, MIN(date) AS first FROM silver GROUP BY ticker)"""


@register("dim_ticker_recovered", O.sql(
    "SELECT k AS ticker_key, o.ticker AS ticker_symbol, COALESCE(m.company_name, '') AS company_name, "
    "COALESCE(m.sector, '') AS sector, COALESCE(m.exchange, '') AS exchange "
    "FROM ordered o LEFT JOIN meta m ON m.ticker = o.ticker", "silver", "meta", extra={"ordered": _ORDERED}))
def q_dim_recovered(spark, d):
    """A run that stops between removing the old ticker dimension and moving the new one in; the
    next one finishes it, then adds the tickers that appear from 2018 on.  No key changes."""
    paths = warehouse.Paths(work_path(spark, "warehouse"))
    rows = store(raw_rows(deduped(spark, d), spark, d), "rows")
    one = warehouse.Run("one", _STAMPS[0], silver_layout="month")
    warehouse.ingest_rows(spark, rows.where(F.col("date") < F.lit(SPLIT)), paths, one)
    warehouse.build_silver(spark, paths, one)
    warehouse.build_gold(spark, paths, one)
    stopped = warehouse.journal(spark, paths).begin()
    spark.read.parquet(paths.dim_ticker).write.parquet(stopped.folder("dim_ticker"))
    stopped.replace(stopped.folder("dim_ticker"), paths.dim_ticker)
    stopped.seal()
    files.delete_path(spark, paths.dim_ticker)
    two = warehouse.Run("two", _STAMPS[1], silver_layout="month", changed_only=True)
    warehouse.ingest_rows(spark, rows, paths, two)
    warehouse.build_silver(spark, paths, two)
    warehouse.build_gold(spark, paths, two)
    return spark.read.parquet(paths.dim_ticker).select("ticker_key", "ticker_symbol", "company_name", "sector", "exchange")


# ---- late rows -----------------------------------------------------------------------

LATE_MONTHS = [201603, 201706, 201707, 201809]


@register("silver_late_rows", O.sql("SELECT * EXCLUDE (processed_at) FROM silver", "silver"))
def q_late_rows(spark, d):
    """A third of the rows of four months arrive after everything else: those months are rebuilt and
    the first rows of the tickers' next months mended; the rest isn't touched."""
    silver_root, state_root = work_path(spark, "silver"), work_path(spark, "state")
    q = quotes(spark, d)
    late = months.month_key().isin(LATE_MONTHS) & (F.col("src_id") % 3 == 0)
    meta = store(fixtures.meta(spark, d), "meta")
    options = {"tiebreak": ["src_id"], "prepare": lambda rows: lookup_metadata(rows, meta)}
    months.build_months(q.where(~late | F.col("date").isNull()), silver_root, state_root, "first", **options)
    months.build_months(q, silver_root, state_root, "second", months=LATE_MONTHS, **options)
    return months.read_months(spark, silver_root).drop("processed_at")


# ---- a whole audited run over rows that grow with the tables -------------------------------

@register("landed_run", O.sql(
    f"""SELECT 'landed' AS run_id, 'success' AS status, TIMESTAMP '{RUN_TS}' AS created_at,
        (SELECT COUNT(*) FROM quotes_once) AS raw_rows_written,
        (SELECT COUNT(*) FROM f) AS total_rows, (SELECT COUNT(*) FROM f WHERE failure_reason IS NOT NULL) AS rejected_rows,
        (SELECT COUNT(*) FROM f WHERE failure_reason IS NULL) AS clean_rows,
        (SELECT COUNT(*) FROM (SELECT DISTINCT ticker, date FROM f WHERE failure_reason IS NULL)) AS silver_rows""",
    "flagged", extra={"quotes_once": "SELECT * FROM quotes", "f": "SELECT * FROM flagged"}))
def q_landed_run(spark, d):
    """All rows, repeated keys and faulty rows too, through the whole pipeline; its audit row and counts."""
    paths = warehouse.Paths(work_path(spark, "warehouse"))
    run = warehouse.Run("landed", dt.datetime.fromisoformat(RUN_TS), silver_layout="month")
    m = warehouse.run_landed(spark, raw_rows(quotes(spark, d), spark, d), paths, run)
    counts = [F.lit(m[c]).cast("long").alias(c) for c in ("raw_rows_written", "total_rows", "rejected_rows", "clean_rows", "silver_rows")]
    return spark.read.parquet(paths.audit).select("run_id", "status", "created_at", *counts)


# ---- clean rows bucketed by ticker and month -----------------------------------------------

@register("bucketed_returns", O.sql(
    """SELECT src_id, ticker, date, close,
       ROUND((close - LAG(close) OVER w) / LAG(close) OVER w, 6) AS daily_return
       FROM dedup WINDOW w AS (PARTITION BY ticker ORDER BY date, src_id)""", "dedup"))
def q_bucketed_returns(spark, d):
    """Clean rows stored bucketed and sorted once; dedup and returns shuffle only month summaries."""
    name = f"clean_{uuid.uuid4().hex}"
    bucketed.write_bucketed(clean(spark, d), name, work_path(spark, "bucketed"), 16)
    kept = bucketed.dedup_bucketed(bucketed.read_bucketed(spark, name))
    return bucketed.daily_returns(kept).select("src_id", "ticker", "date", "close", "daily_return")


# ---- named tables, the built-in reference table, single days ---------------------------------

@register("views_sql", O.sql(
    """SELECT t.sector, d.year, COUNT(*) AS n, MAX(f.close_price) AS top FROM fact f JOIN dim_ticker t USING (ticker_key)
       JOIN dim_date d USING (date_key) GROUP BY t.sector, d.year""", "fact"))
def q_views(spark, d):
    """Stored tables by name, joined in SQL."""
    own = spark.newSession()        # views of the same name elsewhere stay as they are
    places = {name: work_path(spark, name) for name in ("v_fact", "v_dim_ticker", "v_dim_date")}
    s, sizes = store(silver(spark, d), "silver"), {}
    tickers = store(dims.dim_ticker(s, run_ts()), "dim_ticker", sizes)
    days = dims.dim_date(spark)
    days.write.parquet(places["v_dim_date"])
    tickers.write.parquet(places["v_dim_ticker"])
    fact.fact_prices(s, days, tickers, run_ts(), {"dim_date": dims.dim_date_rows(), **sizes}).write.parquet(places["v_fact"])
    landing.register_views(own, places)
    return own.sql("""SELECT t.sector, d.year, COUNT(*) AS n, MAX(f.close_price) AS top FROM v_fact f
                      JOIN v_dim_ticker t USING (ticker_key) JOIN v_dim_date d USING (date_key) GROUP BY t.sector, d.year""")


def _default_ticker():
    from tickvault.sources.reference import DEFAULT_TICKERS
    return F.element_at(F.array(*map(F.lit, [*DEFAULT_TICKERS, "OTHER"])), (F.col("src_id") % 11 + 1).cast("int"))


def _metadata_sql() -> str:
    from tickvault.sources.reference import DEFAULT_TICKERS, TICKER_METADATA
    names = ", ".join(f"'{t}'" for t in [*DEFAULT_TICKERS, "OTHER"])
    values = ", ".join("(" + ", ".join("'" + v + "'" for v in row) + ")" for row in TICKER_METADATA)
    return (f"SELECT q.src_id, [{names}][CAST(q.src_id % 11 + 1 AS INTEGER)] AS ticker, COALESCE(v.company_name, '') AS company_name, "
            "COALESCE(v.sector, '') AS sector, COALESCE(v.exchange, '') AS exchange FROM quotes q "
            f"LEFT JOIN (VALUES {values}) v(ticker, company_name, sector, exchange) "
            f"ON v.ticker = [{names}][CAST(q.src_id % 11 + 1 AS INTEGER)]")


@register("builtin_metadata", O.sql(_metadata_sql(), "quotes"))
def q_builtin_metadata(spark, d):
    """All rows, dealt to the default tickers and one unknown, with the built-in reference table."""
    from tickvault.sources.reference import ticker_metadata
    rows = quotes(spark, d).withColumn("ticker", _default_ticker())
    return lookup_metadata(rows, ticker_metadata(spark)).select("src_id", "ticker", "company_name", "sector", "exchange")


@register("scheduled_day", O.sql(
    "SELECT *, DATE '2017-06-01' AS day, (SELECT COUNT(*) = 0 FROM quotes WHERE date = DATE '1990-01-01') AS other_day_empty, "
    "TRUE AS sampled, TRUE AS stamped_now FROM quotes WHERE date >= DATE '2017-06-01' AND date < DATE '2017-06-02'", "quotes"))
def q_scheduled_day(spark, d):
    """One scheduled day: [ds, next day) (F21), the emptiness test (O3), a sample row (O2), the current time."""
    df = quotes(spark, d)
    day, none = (landing.scan_day(df, ds) for ds in ("2017-06-01", "1990-01-01"))
    try:
        landing.require_rows(none)
        empty = False
    except landing.NoInputError:
        empty = True
    row = landing.sample_row(df)
    started = dt.datetime.now() - dt.timedelta(days=1)
    stamped = dims.dim_ticker_type1(df.limit(0).withColumns({c: F.lit("") for c in dims.DIM_TICKER_ATTRS})).schema["created_at"].dataType
    now = F.current_timestamp() > F.lit(started)
    return day.withColumns({"day": F.lit("2017-06-01").cast("date"), "other_day_empty": F.lit(empty),
                            "sampled": F.lit(row is not None and landing.sample_row(none) is None),
                            "stamped_now": now & F.lit(stamped.simpleString() == "timestamp")})


