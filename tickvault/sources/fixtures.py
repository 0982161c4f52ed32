"""Price-shaped inputs derived from the supplied TPC-H-style tables.

``quotes`` (shape of the raw price table plus a unique ``src_id``) and
``meta`` (ticker reference table) are defined in FIXTURES.md; ``QUOTES_SQL``
and ``META_SQL`` are the same definitions as portable SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixture parameters from FIXTURES.md.
DATE_SHIFT_DAYS = 7000
CUSTOMERS_PER_TICKER = 4        # so the number of tickers grows with the tables
WIDE_TICKERS = 50               # of the download frame, which has a column for each
META_BUCKETS = 40
NASDAQ_BUCKETS = 35
FIRST_INGESTED_AT = "2024-01-02T00:00:00"
LATER_INGESTED_AT = "2024-01-03T00:00:00"
FIXTURE_SOURCE = "synthetic"
MISSING_TICKER = "T99"
WIDE_FIELDS = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]

QUOTES_SQL = """
SELECT CASE WHEN o_orderkey % 127 = 0 THEN NULL
            ELSE CAST(o_orderdate + INTERVAL '7000' DAY AS DATE) END AS date,
       o_totalprice * (CASE WHEN o_orderkey % 107 = 0 THEN -1 ELSE 1 END) AS open,
       CASE WHEN o_orderkey % 113 = 0 THEN o_totalprice - 50 ELSE o_totalprice + 5 END AS high,
       o_totalprice - 5 AS low,
       CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_totalprice + (o_orderkey % 7 - 3) END AS close,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice + (o_orderkey % 7 - 3) - 0.5 END AS adj_close,
       CAST(CASE WHEN o_orderkey % 109 = 0 THEN -1 ELSE 1000 + o_orderkey % 9000 END AS BIGINT) AS volume,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL
            ELSE CONCAT('T', LPAD(CAST(CAST(FLOOR(o_custkey / 4.0) AS BIGINT) AS VARCHAR(20)), 9, '0')) END AS ticker,
       CASE WHEN o_orderkey % 3 = 0 THEN '2024-01-03T00:00:00' ELSE '2024-01-02T00:00:00' END AS ingested_at,
       'synthetic' AS source, o_orderkey AS src_id
FROM orders
"""

META_SQL = """
SELECT CONCAT('T', LPAD(CAST(b AS VARCHAR(20)), 9, '0')) AS ticker,
       MIN(c_name) AS company_name, MIN(c_mktsegment) AS sector,
       CASE WHEN b % 50 < 35 THEN 'NASDAQ' ELSE 'NYSE' END AS exchange
FROM (SELECT *, CAST(FLOOR(c_custkey / 4.0) AS BIGINT) AS b FROM customer)
WHERE b % 50 < 40 GROUP BY b
"""

#: ``quotes`` and ``meta`` folded into fifty tickers, for wide frames and ticker folders.
WIDE_QUOTES_SQL = """
SELECT * REPLACE (CASE WHEN ticker IS NOT NULL THEN CONCAT('T', LPAD(CAST(
       CAST(SUBSTR(ticker, 2) AS BIGINT) % 50 AS VARCHAR(10)), 2, '0')) END AS ticker) FROM quotes
"""

WIDE_META_SQL = """
SELECT CONCAT('T', LPAD(CAST(b AS VARCHAR(20)), 2, '0')) AS ticker, MIN(company_name) AS company_name,
       MIN(sector) AS sector, MIN(exchange) AS exchange
FROM (SELECT *, CAST(SUBSTR(ticker, 2) AS BIGINT) % 50 AS b FROM meta) GROUP BY b
"""


def _label(number, width: int):
    return F.concat(F.lit("T"), F.lpad(number.cast("string"), width, "0"))


def _number(custkey: str):
    return F.floor(F.col(custkey) / CUSTOMERS_PER_TICKER).cast("bigint")


def _fold(df: DataFrame) -> DataFrame:
    return df.withColumn("ticker", _label(F.substring("ticker", 2, 20).cast("bigint") % WIDE_TICKERS, 2))


def fixture_tickers() -> list[str]:
    """All ticker labels of the folded fixture (T00..T49)."""
    return [f"T{i:02d}" for i in range(WIDE_TICKERS)]


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    drift = k % 7 - 3
    return o.select(
        F.when(k % 127 != 0, F.date_add(F.to_date("o_orderdate"), DATE_SHIFT_DAYS)).alias("date"),
        (p * F.when(k % 107 == 0, -1).otherwise(1)).alias("open"),
        F.when(k % 113 == 0, p - 50).otherwise(p + 5).alias("high"),
        (p - 5).alias("low"),
        F.when(k % 103 == 0, F.lit(None)).otherwise(p + drift).cast("double").alias("close"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(p + drift - 0.5).cast("double").alias("adj_close"),
        F.when(k % 109 == 0, -1).otherwise(1000 + k % 9000).cast("bigint").alias("volume"),
        F.when(k % 101 != 0, _label(_number("o_custkey"), 9)).alias("ticker"),
        F.when(k % 3 == 0, LATER_INGESTED_AT).otherwise(FIRST_INGESTED_AT).alias("ingested_at"),
        F.lit(FIXTURE_SOURCE).alias("source"),
        k.alias("src_id"),
    )


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").withColumn("b", _number("c_custkey"))
    return (c.where(F.col("b") % 50 < META_BUCKETS)
             .groupBy("b")
             .agg(F.min("c_name").alias("company_name"),
                  F.min("c_mktsegment").alias("sector"))
             .select(_label(F.col("b"), 9).alias("ticker"),
                     "company_name", "sector",
                     F.when(F.col("b") % 50 < NASDAQ_BUCKETS, "NASDAQ")
                      .otherwise("NYSE").alias("exchange")))


def wide_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fold(quotes(spark, sf_dir))


def wide_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fold(meta(spark, sf_dir)).groupBy("ticker").agg(
        *[F.min(c).alias(c) for c in ("company_name", "sector", "exchange")])


def wide_frame(rows: DataFrame, tickers: list[str], index: str = "Date") -> DataFrame:
    """Download-shaped wide frame: one row per date, one struct per ticker
    holding the six source fields (the (ticker, field) column MultiIndex).

    ``rows`` must be unique per (ticker, date).  Each date's rows become one
    ticker -> fields map, so a date's group holds at most one entry per ticker
    (bounded by the ticker universe, not by the row count); tickers without
    rows get NULL.
    """
    src = {"Open": "open", "High": "high", "Low": "low", "Close": "close",
           "Adj Close": "adj_close", "Volume": "volume"}
    fields = F.struct(*[F.col(c).alias(f) for f, c in src.items()])
    per_date = (rows.groupBy(F.col("date").alias(index))
                    .agg(F.map_from_entries(F.collect_list(F.struct("ticker", fields))).alias("_m")))
    return per_date.select(index, *[F.col("_m")[t].alias(t) for t in tickers])


def quotes_schema():
    """Schema of ``quotes`` as landed files (raw columns plus ``src_id``)."""
    from pyspark.sql import types as T
    return T.StructType([
        T.StructField("date", T.DateType()), T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()), T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()), T.StructField("adj_close", T.DoubleType()),
        T.StructField("volume", T.LongType()), T.StructField("ticker", T.StringType()),
        T.StructField("ingested_at", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("src_id", T.LongType()),
    ])


QUOTE_COLUMNS = ["date", "open", "high", "low", "close", "adj_close", "volume", "ticker",
                 "ingested_at", "source", "src_id"]
