import datetime as dt

from pyspark.sql import types as T

from tickvault.functions.naming import normalize_columns
from tickvault.operators import reshape, tally

FIELDS = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]
STRUCT = T.StructType([T.StructField(f, T.LongType() if f == "Volume" else T.DoubleType())
                       for f in FIELDS])


def wide(spark, rows, tickers):
    schema = T.StructType([T.StructField("Date", T.TimestampNTZType())] +
                          [T.StructField(t, STRUCT) for t in tickers])
    return spark.createDataFrame(rows, schema)


D = dt.datetime(2021, 7, 14)
VALS = (31.25, 34.0, 30.5, 33.75, 33.5, 640000)


def test_wide_to_long_normalised(spark):
    w = wide(spark, [(D, VALS, VALS)], ["QRS", "TUV"])
    out = normalize_columns(reshape.wide_to_long(w))
    assert sorted(out.columns) == sorted(["date", "open", "high", "low", "close", "adj_close",
                                          "volume", "ticker"])
    rows = {r["ticker"]: r for r in out.collect()}
    assert set(rows) == {"QRS", "TUV"} and rows["QRS"]["adj_close"] == 33.5
    assert rows["TUV"]["volume"] == 640000


def test_all_null_ticker_yields_nothing(spark):
    w = wide(spark, [(D, VALS, (None,) * 6)], ["QRS", "GONE"])
    out = reshape.to_raw_rows(w, "2024-01-02T00:00:00", "yahoo_finance")
    assert {r["ticker"] for r in out.collect()} == {"QRS"}
    row = out.first()
    assert row["source"] == "yahoo_finance" and row["ingested_at"] == "2024-01-02T00:00:00"


def test_ticker_with_some_data_keeps_null_rows(spark):
    d2 = dt.datetime(2024, 1, 3)
    w = wide(spark, [(D, VALS), (d2, (None,) * 6)], ["QRS"])
    out = reshape.to_raw_rows(w, "x", "y")
    assert out.count() == 2


def test_flat_single_ticker_frame(spark):
    df = spark.createDataFrame([(D, *VALS)], ["Date", *FIELDS])
    out = normalize_columns(reshape.wide_to_long(df, ticker="QRS"))
    assert out.first()["ticker"] == "QRS" and "adj_close" in out.columns


def test_missing_requested_ticker_is_failed(spark):
    w = wide(spark, [(D, VALS)], ["QRS"])
    rows = reshape.to_raw_rows(w, "x", "y", tickers=["QRS", "TUV"])
    req = spark.createDataFrame([("QRS",), ("TUV",)], "ticker string")
    assert [r[0] for r in tally.failed_tickers(req, rows).collect()] == ["TUV"]
    t = {r["ticker"]: (r["rows_ingested"], r["status"]) for r in tally.ingest_tally(req, rows).collect()}
    assert t == {"QRS": (1, "success"), "TUV": (0, "failed")}


def test_requested_tickers_the_frame_lacks_give_no_rows(spark):
    w = wide(spark, [(D, VALS)], ["QRS"])
    assert reshape.wide_to_long(w, tickers=["TUV"]).count() == 0


def test_plan_grows_by_a_column_reference_per_ticker(spark):
    sizes = {}
    for n in (50, 2000):
        tickers = [f"T{k}" for k in range(n)]
        w = wide(spark, [(D, *[(float(k), None, 1.0, 2.0, 3.0, k) for k in range(n)])], tickers)
        out = reshape.wide_to_long(w)
        before = spark.conf.get("spark.sql.debug.maxToStringFields")
        spark.conf.set("spark.sql.debug.maxToStringFields", "1000000")
        text = out._jdf.queryExecution().analyzed().toString()
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
        sizes[n] = text.count("_row#")          # the rest of the plan names the columns once
        assert len(out.columns) == 8
        rows = {r["ticker"]: r for r in out.collect()}
        assert len(rows) == n and rows[f"T{n - 1}"]["Volume"] == n - 1 and rows["T3"]["High"] is None
    assert sizes[50] == sizes[2000]


def test_tolerant_select(spark):
    df = spark.createDataFrame([(1, 2)], "b int, z int")
    assert reshape.tolerant_select(df, ["a", "b", "c"]).columns == ["b"]
