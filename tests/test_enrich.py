import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickvault.operators import enrich


def _frame(spark, n=3000, tickers=4, seed=7):
    rnd = random.Random(seed)
    base = dt.date(2019, 12, 1)
    rows = []
    for i in range(n):
        rows.append((f"T{rnd.randrange(tickers)}", base + dt.timedelta(days=rnd.randrange(900)),
                     i, round(rnd.uniform(1, 100), 2), round(rnd.uniform(100, 110), 2),
                     round(rnd.uniform(90, 100), 2)))
    return spark.createDataFrame(rows, "ticker string, date date, src_id long, close double, "
                                       "high double, low double")


def test_bucketed_lag_equals_plain_window(spark):
    df = _frame(spark)
    ours = enrich.with_prev_close(df, tiebreak=["src_id"]).select("src_id", "prev_close")
    w = Window.partitionBy("ticker").orderBy("date", "src_id")
    plain = df.select("src_id", F.lag("close").over(w).alias("prev_close"))
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_lag_independent_of_input_partitioning(spark):
    df = _frame(spark, seed=11)
    a = enrich.with_prev_close(df.repartition(7), tiebreak=["src_id"])
    b = enrich.with_prev_close(df.coalesce(1), tiebreak=["src_id"])
    assert a.exceptAll(b).count() == 0


def test_daily_return_and_range(spark):
    rows = [("A", dt.date(2024, 1, 31), 1, 100.0, 110.0, 99.0),
            ("A", dt.date(2024, 2, 1), 2, 110.0, 111.12345, 100.0),
            ("A", dt.date(2024, 3, 5), 3, 99.0, 100.0, 98.0),
            ("B", dt.date(2024, 2, 1), 4, 50.0, 51.0, 49.0)]
    df = spark.createDataFrame(rows, "ticker string, date date, src_id long, close double, "
                                     "high double, low double")
    out = {r["src_id"]: r for r in enrich.enrich_silver(df, "2024-01-02T06:00:00").collect()}
    assert out[1]["daily_return"] is None and out[4]["daily_return"] is None
    assert out[2]["daily_return"] == 0.1
    assert out[3]["daily_return"] == round((99.0 - 110.0) / 110.0, 6)
    assert out[2]["price_range"] == 11.1235
    assert out[1]["layer"] == "silver" and out[1]["processed_at"] == "2024-01-02T06:00:00"


def test_zero_previous_close_gives_null(spark):
    rows = [("A", dt.date(2024, 1, 1), 1, 0.0), ("A", dt.date(2024, 1, 2), 2, 5.0)]
    df = spark.createDataFrame(rows, "ticker string, date date, src_id long, close double")
    out = enrich.with_daily_return(df).where("src_id = 2").first()
    assert out["daily_return"] is None


def test_bucketed_lag_carries_null_previous_values(spark):
    rows = [("A", dt.date(2024, 1, 30), 1, 10.0), ("A", dt.date(2024, 1, 31), 2, None),
            ("A", dt.date(2024, 2, 1), 3, 12.0), ("A", dt.date(2024, 4, 1), 4, 13.0),
            ("B", dt.date(2024, 1, 31), 5, None), ("B", dt.date(2024, 3, 1), 6, 7.0)]
    df = spark.createDataFrame(rows, "ticker string, date date, src_id long, close double")
    ours = enrich.with_prev_close(df, tiebreak=["src_id"]).select("src_id", "prev_close")
    w = Window.partitionBy("ticker").orderBy("date", "src_id")
    plain = df.select("src_id", F.lag("close").over(w).alias("prev_close"))
    got = {r["src_id"]: r["prev_close"] for r in ours.collect()}
    assert got == {r["src_id"]: r["prev_close"] for r in plain.collect()}
    assert got[3] is None and got[4] == 12.0 and got[6] is None
