"""Registered queries of the gold side: type-1 dimension, incremental load,
upsert, data tests and the audit row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tickvault.operators import checks, dims, fact, incremental, quality
from tickvault.plans import oracle as O
from tickvault.plans import warehouse
from tickvault.plans.catalog import (quotes, register, run_ts, silver, silver_from, store,
                                     stored_gold)
from tickvault.plans.catalog_raw import WIDE_TICKERS, _RAW_EXTRA, _TICKER_VALUES, wide
from tickvault.plans.constants import RUN_DATE, RUN_ID, RUN_TS
from tickvault.schemas import AUDIT_SCHEMA, SchemaChangeError
from tickvault.session import work_path
from tickvault.sinks import tables
from tickvault.sources import fixtures

# Timestamps of the simulated earlier and later runs.
EARLIER_TS = "2024-01-01 06:00:00"
FIRST_LOAD_TS = "2024-01-02 07:00:00"
NEXT_RUN_ISO = "2024-01-03T06:00:00"
NEXT_RUN_TS = "2024-01-03 06:00:00"


def ts(value: str):
    return F.lit(dt.datetime.fromisoformat(value))


# ---- type-1 dimension with stable keys --------------------------------------------

@register("dim_ticker_type1", O.sql(
    f"""SELECT k.ticker_key, a.ticker AS ticker_symbol, a.company_name, a.sector,
        CAST(NULL AS VARCHAR) AS industry, a.exchange, 'USD' AS currency,
        k.created_at, TIMESTAMP '{RUN_TS}' AS updated_at
        FROM attrs a JOIN keys k ON k.ticker = a.ticker""", "silver", extra={
        "attrs": """SELECT ticker, company_name, exchange, MAX(CASE
                   WHEN ingested_at = '2024-01-03T00:00:00' THEN sector || ' II' ELSE sector END) AS sector
                   FROM silver GROUP BY ticker, company_name, exchange""",
        "old": f"""SELECT CAST(ROW_NUMBER() OVER (ORDER BY ticker) AS BIGINT) AS ticker_key, ticker,
                   TIMESTAMP '{EARLIER_TS}' AS created_at
                   FROM (SELECT DISTINCT ticker FROM silver WHERE exchange <> 'NASDAQ')""",
        "keys": f"""SELECT * FROM old UNION ALL
                   SELECT (SELECT MAX(ticker_key) FROM old) + ROW_NUMBER() OVER (ORDER BY ticker),
                          ticker, TIMESTAMP '{RUN_TS}'
                   FROM (SELECT DISTINCT ticker FROM silver
                         WHERE ticker NOT IN (SELECT ticker FROM old))""",
    }))
def q_dim_ticker_type1(spark, d):
    """Existing dimension from the non-NASDAQ tickers, then a reload with all:
    known tickers keep their keys, new ones are numbered after them, and the
    sector of the newest ingest wins."""
    renamed = F.when(F.col("ingested_at") == fixtures.LATER_INGESTED_AT, F.concat("sector", F.lit(" II"))) \
        .otherwise(F.col("sector"))
    s = store(silver(spark, d).withColumn("sector", renamed), "silver")
    path = work_path(spark, "dim_ticker")
    first = dims.dim_ticker_type1(s.where(F.col("exchange") != "NASDAQ"), None, ts(EARLIER_TS))
    first.write.parquet(path)
    existing = spark.read.parquet(path)
    return dims.dim_ticker_type1(s, existing, run_ts())


# ---- incremental high-water filter -------------------------------------------------

_S2 = f"""SELECT * REPLACE (CASE WHEN src_id % 2 = 0 THEN '2024-01-02T06:00:00'
          ELSE '{NEXT_RUN_ISO}' END AS processed_at) FROM silver"""
_S2_FIRST = "SELECT * FROM s2 WHERE processed_at = '2024-01-02T06:00:00'"


@register("incremental_filter", O.sql(
    "SELECT * FROM s2 WHERE CAST(processed_at AS TIMESTAMP) > "
    "COALESCE((SELECT MAX(created_at) FROM tgt), TIMESTAMP '1970-01-01')",
    "fact", extra={"s2": _S2, "s2_first": _S2_FIRST, "tgt": O.fact_sql("s2_first", FIRST_LOAD_TS)}))
def q_incremental_filter(spark, d):
    """Clean rows stamped by two runs; the fact was loaded after the first, so
    only rows of the second pass the high-water filter."""
    g = stored_gold(spark, d)
    s2 = g["silver"].withColumn("processed_at", F.when(F.col("src_id") % 2 == 0, "2024-01-02T06:00:00")
                                .otherwise(NEXT_RUN_ISO))
    path = work_path(spark, "fact")
    first = fact.fact_prices(s2.where(F.col("processed_at") == "2024-01-02T06:00:00"),
                             g["dim_date"], g["dim_ticker"], ts(FIRST_LOAD_TS), g["sizes"])
    first.write.parquet(path)
    return incremental.incremental_source(s2, spark.read.parquet(path))


# ---- keyed upsert ------------------------------------------------------------------------

_UPD = {"upd_quotes": "SELECT * REPLACE (close + 1 AS close) FROM quotes WHERE src_id % 2 = 0",
        **O.chain("upd_quotes", "u_", f"'{NEXT_RUN_ISO}'"),
        "s_new": O.fact_sql("u_silver", NEXT_RUN_TS)}


@register("fact_upsert", O.sql(
    """SELECT * FROM fact t WHERE NOT EXISTS (
         SELECT 1 FROM s_new s WHERE s.date_key = t.date_key AND s.ticker_key = t.ticker_key)
       UNION ALL SELECT * FROM s_new""", "fact", extra=_UPD))
def q_fact_upsert(spark, d):
    """Full load, then an upsert of a re-run over the even rows with changed
    closes: their keys are replaced whole, all other rows stay."""
    g = stored_gold(spark, d)
    s, dd, dtk, sizes = g["silver"], g["dim_date"], g["dim_ticker"], g["sizes"]
    path = work_path(spark, "fact")
    tables.upsert_table(fact.fact_prices(s, dd, dtk, run_ts(), sizes), path, fact.FACT_KEYS)
    q = quotes(spark, d)
    upd_raw = q.where(F.col("src_id") % 2 == 0).withColumn("close", F.col("close") + 1)
    upd_silver = store(silver_from(upd_raw, spark, d, NEXT_RUN_ISO), "silver")
    upd = fact.fact_prices(upd_silver, dd, dtk, ts(NEXT_RUN_TS), sizes)
    tables.upsert_table(upd, path, fact.FACT_KEYS)
    return tables.read_table(spark, path)


@register("schema_guard", O.sql(
    """SELECT * FROM fact t WHERE NOT EXISTS (
         SELECT 1 FROM s_new s WHERE s.date_key = t.date_key AND s.ticker_key = t.ticker_key)
       UNION ALL SELECT * FROM s_new""", "fact", extra=_UPD))
def q_schema_guard(spark, d):
    """The re-run batch first arrives with ``volume`` as DOUBLE: the upsert is
    refused and the table is left as it was; the conforming batch then goes in."""
    g = stored_gold(spark, d)
    s, dd, dtk, sizes = g["silver"], g["dim_date"], g["dim_ticker"], g["sizes"]
    path = work_path(spark, "fact")
    tables.upsert_table(fact.fact_prices(s, dd, dtk, run_ts(), sizes), path, fact.FACT_KEYS)
    q = quotes(spark, d)
    upd_raw = q.where(F.col("src_id") % 2 == 0).withColumn("close", F.col("close") + 1)
    upd_silver = store(silver_from(upd_raw, spark, d, NEXT_RUN_ISO), "silver")
    upd = fact.fact_prices(upd_silver, dd, dtk, ts(NEXT_RUN_TS), sizes)
    try:
        tables.upsert_table(upd.withColumn("volume", F.col("volume").cast("double")),
                            path, fact.FACT_KEYS)
    except SchemaChangeError:
        pass
    else:
        raise AssertionError("a changed column type was not refused")
    tables.upsert_table(upd, path, fact.FACT_KEYS)
    return tables.read_table(spark, path)


# ---- data tests ----------------------------------------------------------------------------

@register("test_not_null", O.sql(
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT_IF({c} IS NULL) AS failures FROM quotes"
                       for c in ["date", "ticker", "close", "volume"]), "quotes"))
def q_test_not_null(spark, d):
    return checks.not_null_counts(quotes(spark, d), ["date", "ticker", "close", "volume"])


@register("test_unique", O.sql(
    "SELECT ticker, date, COUNT(*) AS n_records FROM clean WHERE ticker IS NOT NULL "
    "AND date IS NOT NULL GROUP BY ticker, date HAVING COUNT(*) > 1", "clean"))
def q_test_unique(spark, d):
    return checks.unique_failures(quality.clean_rows(quotes(spark, d)), ["ticker", "date"])


@register("test_relationships", O.sql(
    "SELECT * FROM quotes WHERE ticker IS NOT NULL AND ticker NOT IN (SELECT ticker FROM meta)",
    "quotes", "meta"))
def q_test_relationships(spark, d):
    return checks.relationship_failures(quotes(spark, d), "ticker", fixtures.meta(spark, d), "ticker")


_SUITE_CTE = {"dim_date": "dim_date", "dim_ticker": "dim_ticker",
              "fact_stock_prices": "fact", "silver_stock_prices": "silver"}


def _suite_sql() -> str:
    rows = []
    for t in checks.GOLD_TESTS:
        tab = _SUITE_CTE[t.table]
        if t.kind == "not_null":
            cnt = f"(SELECT COUNT(*) FROM {tab} WHERE {t.column} IS NULL)"
        elif t.kind == "unique":
            cnt = (f"(SELECT COUNT(*) FROM (SELECT {t.column} FROM {tab} WHERE {t.column} IS NOT NULL "
                   f"GROUP BY {t.column} HAVING COUNT(*) > 1))")
        else:
            parent = _SUITE_CTE[t.to_table]
            cnt = (f"(SELECT COUNT(*) FROM {tab} WHERE {t.column} IS NOT NULL AND {t.column} "
                   f"NOT IN (SELECT {t.to_column} FROM {parent} WHERE {t.to_column} IS NOT NULL))")
        rows.append(f"SELECT '{t.name}' AS test_name, '{t.kind}' AS kind, '{t.table}' AS table_name, "
                    f"'{t.column}' AS column_name, CAST({cnt} AS BIGINT) AS failures")
    return ("SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
            + " UNION ALL ".join(rows) + ")")


def gold_tables(spark, d):
    """The clean table and the star schema as stored tables: the tests read
    files instead of re-deriving them in every branch."""
    g = stored_gold(spark, d)
    f = store(fact.fact_prices(g["silver"], g["dim_date"], g["dim_ticker"], run_ts(), g["sizes"]),
              "fact")
    return {"dim_date": g["dim_date"], "dim_ticker": g["dim_ticker"],
            "silver_stock_prices": g["silver"], "fact_stock_prices": f}, g["sizes"]


@register("test_suite", O.sql(_suite_sql(), "fact"))
def q_test_suite(spark, d):
    gold, sizes = gold_tables(spark, d)
    return checks.run_suite(gold, checks.GOLD_TESTS, sizes)


# ---- audit -------------------------------------------------------------------------------

@register("audit_log", O.sql(
    f"""SELECT '{RUN_ID}' AS run_id, 'all_layers' AS layer, DATE '{RUN_DATE}' AS run_date,
        CASE WHEN (SELECT COUNT(*) FROM w_silver WHERE ticker IS NULL OR date IS NULL) > 0 THEN 'failed'
             WHEN (SELECT COUNT(*) FROM (VALUES {_TICKER_VALUES}) v(ticker)
                   WHERE ticker NOT IN (SELECT ticker FROM kept_rows)) > 0 THEN 'partial' ELSE 'success' END AS status,
        TIMESTAMP '{RUN_TS}' AS created_at""", "w_silver", extra=_RAW_EXTRA))
def q_audit_log(spark, d):
    """The whole pipeline over the download frame; the audit row that it wrote."""
    paths = warehouse.Paths(work_path(spark, "warehouse"))
    run = warehouse.Run(RUN_ID, dt.datetime.fromisoformat(RUN_TS))
    warehouse.run_pipeline(spark, wide(spark, d), paths, run, WIDE_TICKERS, fixtures.wide_meta(spark, d))
    return spark.read.schema(AUDIT_SCHEMA).parquet(paths.audit)
