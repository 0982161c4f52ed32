import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from tickvault.operators import quality

SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()), T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()), T.StructField("adj_close", T.DoubleType()),
    T.StructField("volume", T.LongType()), T.StructField("ticker", T.StringType()),
])
D = dt.date(2021, 7, 14)


def reason(spark, row, schema=SCHEMA):
    df = spark.createDataFrame([row], schema)
    return quality.flag(df).first()["failure_reason"]


def split_counts(spark, row):
    clean, rejected = quality.split(spark.createDataFrame([row], SCHEMA))
    return clean.count(), rejected.count()


def row_with(**changed):
    """A row that passes every rule, with some columns changed."""
    good = {"date": dt.date(2021, 7, 14), "open": 20.5, "high": 22.0, "low": 19.25, "close": 21.0,
            "adj_close": 20.75, "volume": 8200, "ticker": "QRS"}
    return tuple({**good, **changed}[f.name] for f in SCHEMA.fields)


CRITICAL = ["date", "ticker", "open", "high", "low", "close", "volume"]
PRICES = ["open", "high", "low", "close", "adj_close"]


# One case for each clause of each rule.
@pytest.mark.parametrize("row,expected", [
    (row_with(), None),
    *[(row_with(**{c: None}), "null_in_critical_column") for c in CRITICAL],
    *[(row_with(**{c: v}), "non_positive_price") for c in PRICES for v in (0.0, -3.5)],
    (row_with(volume=-7), "negative_volume"),
    *[(row_with(high=v), "ohlc_inconsistency") for v in (19.0, 20.25, 20.75)],
])
def test_rule_clauses(spark, row, expected):
    assert reason(spark, row) == expected
    clean, rejected = split_counts(spark, row)
    assert (clean, rejected) == ((1, 0) if expected is None else (0, 1))


# Several faults in one row, and values at the limits.
@pytest.mark.parametrize("row,expected", [
    (row_with(volume=0), None),
    (row_with(adj_close=None), None),
    (row_with(ticker=None, open=-2.5, high=18.0, volume=-4), "null_in_critical_column"),
    (row_with(open=-2.5, high=18.0, volume=-4), "non_positive_price"),
    (row_with(high=18.0, volume=-4), "negative_volume"),
    (row_with(open=23.5), "ohlc_inconsistency"),
    (row_with(low=21.5), None),
])
def test_added_cases(spark, row, expected):
    assert reason(spark, row) == expected


def test_absent_columns_skip_null_and_price_checks(spark):
    schema = T.StructType([f for f in SCHEMA.fields if f.name not in ("date", "ticker", "adj_close")])
    assert reason(spark, (20.5, 22.0, 19.25, 21.0, 8200), schema) is None


def test_absent_volume_is_an_error(spark):
    schema = T.StructType([f for f in SCHEMA.fields if f.name != "volume"])
    with pytest.raises(AnalysisException):
        reason(spark, tuple(v for f, v in zip(SCHEMA.fields, row_with()) if f.name != "volume"), schema)


def test_nan_is_normalised_before_rules(spark):
    from tickvault.schemas import RAW_SCHEMA, enforce_schema
    df = spark.createDataFrame([row_with(open=float("nan"))], SCHEMA)
    out = quality.flag(enforce_schema(df, RAW_SCHEMA)).first()
    assert out["open"] is None and out["failure_reason"] == "null_in_critical_column"


def test_clean_plus_rejected_is_total_and_metrics(spark):
    from tickvault.sources import fixtures
    q = fixtures.quotes(spark, "/root/testdata/sf0.001")
    clean, rejected = quality.split(q)
    m = quality.metrics(quality.flag(q)).first()
    assert clean.count() + rejected.count() == q.count() == m["total_rows"] == 1500
    assert (m["null_in_critical_column"], m["non_positive_price"], m["negative_volume"],
            m["ohlc_inconsistency"], m["clean_rows"]) == (40, 14, 13, 13, 1420)
    assert quality.dedup_latest(clean).count() == 1411


def test_observed_metrics_match(spark):
    from tickvault.sources import fixtures
    q = fixtures.quotes(spark, "/root/testdata/sf0.001")
    flagged, obs = quality.observe_metrics(quality.flag(q))
    flagged.write.format("noop").mode("overwrite").save()
    assert obs.get["rejected_rows"] == 80


def test_dedup_keeps_newest_then_lowest_id(spark):
    rows = [("A", D, "2024-01-01", 5, 1.0), ("A", D, "2024-01-02", 7, 2.0),
            ("A", D, "2024-01-02", 6, 3.0), ("B", D, "2024-01-01", 1, 4.0)]
    df = spark.createDataFrame(rows, "ticker string, date date, ingested_at string, src_id long, close double")
    kept = {r["ticker"]: r["src_id"] for r in quality.dedup_latest(df).collect()}
    assert kept == {"A": 6, "B": 1}
    dropped = sorted(r["src_id"] for r in quality.duplicate_rows(df, quality.dedup_latest(df)).collect())
    assert dropped == [5, 7]
