"""The built-in ticker reference table (S7) and default ticker list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Default ticker universe, in the reference's order.
DEFAULT_TICKERS = ["AAPL", "MSFT", "GOOGL", "AMZN", "META", "NVDA", "TSLA", "JPM", "JNJ", "V"]

# Ticker -> (company_name, sector, exchange).
TICKER_METADATA = [
    ("AAPL", "Apple Inc.", "Technology", "NASDAQ"),
    ("MSFT", "Microsoft Corporation", "Technology", "NASDAQ"),
    ("GOOGL", "Alphabet Inc.", "Technology", "NASDAQ"),
    ("AMZN", "Amazon.com Inc.", "Consumer Cyclical", "NASDAQ"),
    ("META", "Meta Platforms Inc.", "Technology", "NASDAQ"),
    ("NVDA", "NVIDIA Corporation", "Technology", "NASDAQ"),
    ("TSLA", "Tesla Inc.", "Consumer Cyclical", "NASDAQ"),
    ("JPM", "JPMorgan Chase & Co.", "Financial Services", "NYSE"),
    ("JNJ", "Johnson & Johnson", "Healthcare", "NYSE"),
    ("V", "Visa Inc.", "Financial Services", "NYSE"),
]

META_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("company_name", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("exchange", T.StringType()),
])


def ticker_metadata(spark: SparkSession) -> DataFrame:
    """The reference table as a (tiny, literal) DataFrame."""
    return spark.createDataFrame(TICKER_METADATA, META_SCHEMA)
