"""Registered queries of the raw side: reshape, lookup, scans, idempotent append."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickvault.functions import rules
from tickvault.functions.naming import normalize_columns
from tickvault.operators import reshape, tally
from tickvault.operators.lookup import lookup_metadata
from tickvault.plans import oracle as O
from tickvault.plans.catalog import quotes, register, silver, store
from tickvault.operators import quality
from tickvault.plans.constants import RUN_TS_ISO
from tickvault.session import work_path
from tickvault.schemas import SchemaChangeError, enforce_schema
from tickvault.sinks import compaction, files
from tickvault.sources import fixtures, footers, landing

# Fixed value: the raw layer's source label.
SOURCE_LABEL = "yahoo_finance"
WIDE_TICKERS = fixtures.fixture_tickers() + [fixtures.MISSING_TICKER]
FIELDS = fixtures.WIDE_FIELDS


def wide(spark, d):
    """The download frame, stored as a download is."""
    rows = quality.dedup_latest(quality.clean_rows(fixtures.wide_quotes(spark, d)))
    return store(fixtures.wide_frame(rows, WIDE_TICKERS), "wide")


def long_rows(spark, d):
    return reshape.wide_to_long(wide(spark, d), "Date")


def raw_rows(spark, d):
    return reshape.to_raw_rows(wide(spark, d), RUN_TS_ISO, SOURCE_LABEL)


def requested(spark):
    return spark.createDataFrame([(t,) for t in WIDE_TICKERS], "ticker string")


_TICKER_VALUES = ", ".join(f"('{t}')" for t in WIDE_TICKERS)
_LONG = f"""SELECT dd.date AS "Date", tl.ticker, x.open AS "Open", x.high AS "High", x.low AS "Low",
    x.close AS "Close", x.adj_close AS "Adj Close", x.volume AS "Volume"
    FROM (SELECT DISTINCT date FROM w_dedup) dd
    CROSS JOIN (SELECT * FROM (VALUES {_TICKER_VALUES}) v(ticker)) tl
    LEFT JOIN w_dedup x ON x.date = dd.date AND x.ticker = tl.ticker"""
_NORM = """SELECT "Date" AS date, ticker, "Open" AS open, "High" AS high, "Low" AS low,
    "Close" AS close, "Adj Close" AS adj_close, "Volume" AS volume FROM long_rows"""
_KEPT = """SELECT * FROM norm_rows WHERE ticker IN (
    SELECT ticker FROM norm_rows GROUP BY ticker
    HAVING COUNT(open) + COUNT(high) + COUNT(low) + COUNT(close) + COUNT(adj_close) + COUNT(volume) > 0)"""
_RAW_EXTRA = {"long_rows": _LONG, "norm_rows": _NORM, "kept_rows": _KEPT}


@register("reshape_wide_to_long", O.sql("SELECT * FROM long_rows", "w_dedup", extra={"long_rows": _LONG}))
def q_reshape(spark, d):
    return long_rows(spark, d)


@register("normalize_columns", O.sql("SELECT * FROM norm_rows", "w_dedup",
                                     extra={"long_rows": _LONG, "norm_rows": _NORM}))
def q_normalize(spark, d):
    return normalize_columns(long_rows(spark, d))


@register("drop_all_null_groups", O.sql("SELECT * FROM kept_rows", "w_dedup", extra=_RAW_EXTRA))
def q_drop_all_null(spark, d):
    return reshape.drop_all_null_groups(normalize_columns(long_rows(spark, d)), "ticker", ("date",))


@register("lineage_columns", O.sql(
    f"SELECT *, '{RUN_TS_ISO}' AS ingested_at, '{SOURCE_LABEL}' AS source FROM kept_rows",
    "w_dedup", extra=_RAW_EXTRA))
def q_lineage(spark, d):
    return raw_rows(spark, d)


@register("failed_tickers", O.sql(
    f"SELECT ticker FROM (VALUES {_TICKER_VALUES}) v(ticker) "
    "WHERE ticker NOT IN (SELECT ticker FROM kept_rows)", "w_dedup", extra=_RAW_EXTRA))
def q_failed(spark, d):
    return tally.failed_tickers(requested(spark), raw_rows(spark, d))


@register("ingest_tally", O.sql(
    f"""SELECT v.ticker, CAST(COUNT(k.ticker) AS BIGINT) AS rows_ingested,
        CASE WHEN COUNT(k.ticker) > 0 THEN 'success' ELSE 'failed' END AS status
        FROM (VALUES {_TICKER_VALUES}) v(ticker) LEFT JOIN kept_rows k ON k.ticker = v.ticker
        GROUP BY v.ticker""", "w_dedup", extra=_RAW_EXTRA))
def q_tally(spark, d):
    return tally.ingest_tally(requested(spark), raw_rows(spark, d))


@register("rows_per_day", O.sql(
    "SELECT ticker, date, COUNT(*) AS rows FROM quotes GROUP BY ticker, date", "quotes"))
def q_rows_per_day(spark, d):
    return tally.rows_per_day(quotes(spark, d))


@register("metadata_lookup", O.sql(
    """SELECT q.*, COALESCE(m.company_name, '') AS company_name, COALESCE(m.sector, '') AS sector,
       COALESCE(m.exchange, '') AS exchange FROM quotes q LEFT JOIN meta m ON q.ticker = m.ticker""",
    "quotes", "meta"))
def q_lookup(spark, d):
    return lookup_metadata(quotes(spark, d), fixtures.meta(spark, d))


# ---- folders by bucket of tickers: few folders, whole tickers --------------------------

BUCKET_SQL = "CONCAT('B', LPAD(CAST(CAST(SUBSTR(ticker, 2) AS BIGINT) % 50 AS VARCHAR(10)), 2, '0'))"


def with_bucket(df):
    number = F.substring("ticker", 2, 20).cast("bigint") % 50
    return df.withColumn("bucket", F.concat(F.lit("B"), F.lpad(number.cast("string"), 2, "0")))


def bucketed_silver(spark, d):
    return with_bucket(silver(spark, d))


# ---- landed files ------------------------------------------------------------------

def land_quotes(spark, d, layout="monthly"):
    root = work_path(spark, "raw")
    files.append_idempotent(quotes(spark, d), root, layout)
    return root


def read_quotes(spark, root, layout="monthly"):
    return landing.read_raw(spark, root, layout, fixtures.quotes_schema())


@register("date_range_scan", O.sql(
    "SELECT * FROM quotes WHERE date >= DATE '2016-01-01' AND date < DATE '2019-01-01' "
    "AND ticker IN (SELECT ticker FROM meta)", "quotes", "meta"))
def q_date_range(spark, d):
    root = land_quotes(spark, d)
    df = read_quotes(spark, root)
    out = landing.scan_range(df, "2016-01-01", "2019-01-01", fixtures.meta(spark, d))
    return out.select(*fixtures.QUOTE_COLUMNS)


@register("append_idempotent", O.sql(
    """SELECT * FROM quotes WHERE src_id % 2 = 0
       UNION ALL
       SELECT * REPLACE (close + 1 AS close) FROM quotes b
       WHERE NOT EXISTS (SELECT 1 FROM quotes a WHERE a.src_id % 2 = 0
                         AND a.ticker IS NOT DISTINCT FROM b.ticker
                         AND a.date IS NOT DISTINCT FROM b.date)""",
    "quotes"))
def q_append(spark, d):
    """First batch: even rows.  Then all rows with a changed close, twice: only
    unseen (ticker, date) groups are added, and the repeat adds nothing."""
    root = work_path(spark, "raw")
    q = quotes(spark, d)
    files.append_idempotent(q.where(F.col("src_id") % 2 == 0), root)
    changed = q.withColumn("close", F.col("close") + 1)
    files.append_idempotent(changed, root)
    files.append_idempotent(changed, root)
    return read_quotes(spark, root).select(*fixtures.QUOTE_COLUMNS)


@register("union_files", O.sql(
    "SELECT *, CASE WHEN src_id % 2 = 0 THEN 'even' ELSE 'odd' END AS batch FROM quotes", "quotes"))
def q_union_files(spark, d):
    """Two batches in separate folders read back as one table; the batch label
    comes from each file's path."""
    root = work_path(spark, "files")
    q = quotes(spark, d)
    q.where(F.col("src_id") % 2 == 0).write.parquet(f"{root}/batch=even")
    q.where(F.col("src_id") % 2 != 0).write.parquet(f"{root}/batch=odd")
    return landing.read_files_with_path_key(spark, root, "batch")


@register("union_files_drift", O.sql(
    """SELECT * EXCLUDE (adj_close), CASE WHEN src_id % 3 <> 0 THEN adj_close END AS adj_close,
       CASE WHEN src_id % 3 = 1 THEN 'late' END AS remark, CAST(src_id % 3 AS VARCHAR) AS batch FROM quotes""", "quotes"))
def q_union_drift(spark, d):
    """Three batches of unlike files: one lacks a column, one has a column more.  None is lost, and
    a column that a batch lacks is NULL there; a declared schema refuses the column it doesn't know."""
    root = work_path(spark, "files")
    q = quotes(spark, d)
    batches = {0: q.drop("adj_close"), 1: q.withColumn("remark", F.lit("late")), 2: q}
    for k, df in batches.items():
        df.where(F.col("src_id") % 3 == k).write.parquet(f"{root}/batch={k}")
    try:
        landing.read_files_with_path_key(spark, root, "batch", schema=fixtures.quotes_schema())
    except SchemaChangeError:
        return landing.read_files_with_path_key(spark, root, "batch")
    raise AssertionError("an undeclared column was not refused")


@register("path_partition_column", O.sql(
    f"SELECT src_id, {BUCKET_SQL} AS bucket, ticker, date, close FROM silver", "silver"))
def q_path_partition(spark, d):
    """Clean table written in folders by bucket of tickers (files lack the column); the
    bucket is recovered from each file's path."""
    root = work_path(spark, "silver")
    files.overwrite_partitions(bucketed_silver(spark, d), root, ["bucket"])
    df = landing.read_files_with_path_key(spark, root, "bucket")
    return df.select("src_id", "bucket", "ticker", "date", "close")


@register("partition_scan", O.sql(
    f"SELECT *, {BUCKET_SQL} AS bucket FROM silver WHERE exchange = 'NYSE'", "silver"))
def q_partition_scan(spark, d):
    """Clean table in folders by bucket, restricted to a table of buckets, the ones of the NYSE
    tickers: a broadcast semi join, so only those folders are read."""
    root = work_path(spark, "silver")
    s = bucketed_silver(spark, d)
    files.overwrite_partitions(s, root, ["bucket"])
    df = spark.read.schema(s.schema).parquet(root)
    nyse = with_bucket(fixtures.meta(spark, d).where(F.col("exchange") == "NYSE"))
    return landing.scan_range(df, tickers=nyse, ticker_col="bucket").where(F.col("exchange") == "NYSE").select(*s.columns)



@register("read_partition", O.sql(f"SELECT *, {BUCKET_SQL} AS bucket FROM silver WHERE {BUCKET_SQL} = 'B07'", "silver"))
def q_read_partition(spark, d):
    """One folder of the clean table, read alone; its bucket comes from the path."""
    root = work_path(spark, "silver")
    s = bucketed_silver(spark, d)
    files.overwrite_partitions(s, root, ["bucket"])
    return landing.read_partition(spark, root, "bucket=B07", s.schema).select(*s.columns)


@register("daily_layout", O.sql("SELECT * FROM w_quotes", "w_quotes"))
def q_daily_layout(spark, d):
    """All rows, undated ones too, landed twice in the layout with a folder for each ticker
    and day, and read back."""
    root = work_path(spark, "raw")
    rows = fixtures.wide_quotes(spark, d)
    for _ in range(2):
        files.append_idempotent(rows, root, "daily")
    return read_quotes(spark, root, "daily").select(*fixtures.QUOTE_COLUMNS)


@register("compacted_months", O.sql("SELECT * FROM quotes", "quotes"))
def q_compacted(spark, d):
    """Four appends leave four files or more in each month's folder; compaction by bytes packs them.  No
    row changes."""
    root = work_path(spark, "raw")
    q = with_month(quotes(spark, d))
    for k in range(4):
        q.where(F.col("src_id") % 4 == k).write.mode("append").partitionBy("year", "month").parquet(root)
    before = sum(map(len, compaction.list_data_files(spark, root).values()))
    compaction.compact_by_bytes(spark, root, 1 << 20)
    if sum(map(len, compaction.list_data_files(spark, root).values())) * 2 > before:
        raise AssertionError("nothing was packed")
    return read_quotes(spark, root).select(*fixtures.QUOTE_COLUMNS)


@register("footer_stats", O.sql(
    "SELECT COUNT(*) AS n, " + ", ".join(f"{f}({c}) AS {f.lower()}_{c}" for c in ("date", "volume", "close", "src_id") for f in ("MIN", "MAX"))
    + " FROM silver", "silver"))
def q_footer_stats(spark, d):
    """Row count and extremes of the stored clean table, from its footers."""
    path = work_path(spark, "silver")
    silver(spark, d).write.parquet(path)
    return footers.footer_stats(spark, path, ["date", "volume", "close", "src_id"])


@register("schema_enforced", O.sql("SELECT * FROM quotes", "quotes"))
def q_schema_enforced(spark, d):
    """Files of another writer (timestamp dates, DOUBLE volumes, NaN for no
    price) read as stored and then cast to the declared schema."""
    root = work_path(spark, "raw")
    (with_month(quotes(spark, d))
     .withColumns({"date": F.col("date").cast("timestamp"), "volume": F.col("volume").cast("double"),
                   "close": F.coalesce("close", F.lit(float("nan")))})
     .write.partitionBy("year", "month").parquet(root))
    back = landing.read_raw(spark, root, schema=fixtures.quotes_schema(), foreign=True)
    return back.select(*fixtures.QUOTE_COLUMNS)


_WRONG = "(src_id % 211 = 0 OR src_id % 223 = 0)"


@register("type_mismatch", O.sql(
    f"SELECT src_id, CASE WHEN {_WRONG} THEN 'type_mismatch' ELSE failure_reason END AS failure_reason FROM flagged", "flagged"))
def q_type_mismatch(spark, d):
    """Another writer's files with text for numbers, some of it none: rejected for its type, not as missing."""
    root = work_path(spark, "raw")
    k = F.col("src_id")
    (quotes(spark, d).withColumns({"volume": F.when(k % 211 == 0, "n/a").otherwise(F.col("volume").cast("string")),
                                   "open": F.when(k % 223 == 0, "12,5").otherwise(F.col("open").cast("string"))}).write.parquet(root))
    rows = enforce_schema(spark.read.parquet(root), fixtures.quotes_schema(), mark=rules.CAST_FAILED)
    return quality.flag(rows, rules.TYPED_RULES).select("src_id", quality.REASON)


def with_month(df):
    return files.with_partition_columns(df, "monthly")


# ---- month-partitioned clean table, rebuilt incrementally ------------------------

_SPLIT = "2018-01-01"


@register("silver_incremental", O.sql(
    f"""SELECT * REPLACE (CASE WHEN date < DATE '{_SPLIT}' THEN '{RUN_TS_ISO}'
        ELSE '2024-01-03T06:00:00' END AS processed_at) FROM silver""", "silver"))
def q_silver_incremental(spark, d):
    """Raw history before 2018 landed and built; then the rest landed and only
    the months from 2018-01 rebuilt, each ticker's first return seeded from
    the per-month state.  Equals a full build of the whole history."""
    from tickvault.operators import months
    raw_root = work_path(spark, "raw")
    silver_root, state_root = work_path(spark, "silver"), work_path(spark, "state")
    q = quotes(spark, d)
    meta = fixtures.meta(spark, d)

    def prepare(rows):
        return lookup_metadata(rows, meta)

    files.append_idempotent(q.where(F.col("date") < F.lit(_SPLIT).cast("date")), raw_root)
    months.build_months(read_quotes(spark, raw_root), silver_root, state_root, RUN_TS_ISO,
                        tiebreak=["src_id"], prepare=prepare)
    files.append_idempotent(q, raw_root)
    months.build_months(read_quotes(spark, raw_root), silver_root, state_root,
                        "2024-01-03T06:00:00", since=_SPLIT, tiebreak=["src_id"], prepare=prepare)
    return spark.read.parquet(silver_root).drop(months.MONTH_KEY)
