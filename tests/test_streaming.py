import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickvault.operators import enrich, quality
from tickvault.sources import fixtures
from tickvault.streaming import incremental as S

SF = "/root/testdata/sf0.001"
SCHEMA = fixtures.quotes_schema()
ISO = "2024-01-02T06:00:00"


def whole(rows):
    """The clean table of a single batch over all rows."""
    rows = quality.dedup_latest(quality.clean_rows(rows))
    w = Window.partitionBy("ticker").orderBy("date", "src_id")
    out = rows.withColumn("prev_close", F.lag("close").over(w))
    return enrich.with_price_range(out.withColumn("daily_return", enrich.daily_return("close", "prev_close")))


COLUMNS = ["src_id", "daily_return", "price_range"]


def test_stream_in_any_order_equals_one_batch(spark, tmp_dir):
    q = fixtures.quotes(spark, SF)
    src, root, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def run():
        S.silver_stream(spark, src, SCHEMA, root, ckpt, ISO).awaitTermination()
        return S.read_silver(spark, root).select(COLUMNS)

    late, early = q.where(F.year("date") > 2017), q.where((F.year("date") <= 2017) | F.col("date").isNull())
    late.write.parquet(f"{src}/batch=1")
    first = run().collect()
    assert sorted(run().collect(), key=repr) == sorted(first, key=repr)     # restart: nothing new
    early.write.parquet(f"{src}/batch=2")
    out, expect = run(), whole(q).select(COLUMNS)
    assert out.count() == expect.count() > len(first)
    assert out.exceptAll(expect).count() == 0
    rejected, duplicates = (S.read_batches(spark, f"{root}/{x}") for x in ("rejected", "duplicates"))
    assert rejected.count() == quality.rejected_rows(q).count()
    assert out.count() + duplicates.count() + rejected.count() == q.count()


def test_same_key_in_two_files_and_a_replayed_epoch(spark, tmp_dir):
    def row(day, close, ingested, n):
        return (day, 10.0, 30.0, 5.0, close, close, 1, "A", ingested, "s", n)

    d1, d2, d3 = (dt.date(2024, m, 2) for m in (1, 2, 3))
    root = f"{tmp_dir}/out"
    run = S.silver_batch(root, SCHEMA, ISO)
    one = spark.createDataFrame([row(d1, 10.0, "1", 1), row(d3, 20.0, "1", 2)], SCHEMA)
    two = spark.createDataFrame([row(d1, 16.0, "2", 3), row(d2, 8.0, "1", 4), row(d3, 9.0, "0", 5)], SCHEMA)
    for epoch, batch in ((0, one), (1, two), (1, two)):
        run(batch, epoch)
    got = [(r["date"], r["src_id"], r["daily_return"]) for r in S.read_silver(spark, root).orderBy("date").collect()]
    assert got == [(d1, 3, None), (d2, 4, -0.5), (d3, 2, 1.5)]
    lost = [(r["src_id"], r["failure_reason"]) for r in S.read_batches(spark, f"{root}/duplicates").orderBy("src_id").collect()]
    assert lost == [(1, "duplicate_key"), (5, "duplicate_key")]
    empty = spark.createDataFrame([], SCHEMA)
    run(empty, 2)
    assert S.read_silver(spark, root).count() == 3


def test_clean_stream_exactly_once_with_rejects(spark, tmp_dir):
    q = fixtures.quotes(spark, SF)
    src, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/clean", f"{tmp_dir}/ckpt"
    q.write.parquet(f"{src}/batch=1")
    for _ in range(2):
        S.clean_stream(spark, src, SCHEMA, sink, ckpt).awaitTermination()
    assert S.read_batches(spark, sink).count() == quality.clean_rows(q).count() == 1420
    assert S.read_batches(spark, f"{sink}_rejected").count() == 80


def test_late_rows_go_to_quarantine(spark, tmp_dir):
    def row(day, close, n):
        return (day, 10.0, 30.0, 5.0, close, close, 1, "A", "1", "s", n)

    old, near, new = dt.date(2023, 1, 2), dt.date(2024, 2, 20), dt.date(2024, 3, 10)
    root = f"{tmp_dir}/out"
    run = S.silver_batch(root, SCHEMA, ISO, lateness_days=30)
    first = spark.createDataFrame([row(old, 10.0, 1), row(new, 20.0, 2)], SCHEMA)       # nothing is late in the first epoch
    second = spark.createDataFrame([row(old, 11.0, 3), row(dt.date(2024, 2, 8), 12.0, 4), row(near, 16.0, 5), row(near, -1.0, 6)], SCHEMA)
    for epoch, batch in ((0, first), (1, second), (1, second)):
        run(batch, epoch)
    got = [(r["src_id"], r["daily_return"]) for r in S.read_silver(spark, root).orderBy("date").collect()]
    assert got == [(1, None), (5, 0.6), (2, 0.25)]
    lost = [(r["src_id"], r["failure_reason"]) for r in S.read_batches(spark, f"{root}/rejected").orderBy("src_id").collect()]
    assert lost == [(3, "late"), (4, "late"), (6, "non_positive_price")]
    assert S.newest_before(spark, root, 1) == new and S.newest_before(spark, root, 0) is None


def test_contested_rows_are_those_of_crowded_keys_of_the_epoch(spark):
    day = dt.date(2024, 1, 2)
    rows = spark.createDataFrame([("A", day, 1, 0), ("A", day, 2, 1), ("B", day, 3, 0), ("B", day, 4, 0), ("C", day, 5, 1), ("D", day, 6, 1),
                                  ("D", day, 6, 1)], "ticker string, date date, src_id long, batch_id long")
    assert sorted(r["src_id"] for r in S.contested(rows, 1).collect()) == [1, 2, 6, 6]
    assert sorted(r["src_id"] for r in S.contested(rows.where("batch_id = 0"), 0).collect()) == [3, 4]
