import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tickvault.operators import quality
from tickvault.schemas import SILVER_SCHEMA, SchemaChangeError
from tickvault.sinks import files, tables
from tickvault.sources import landing

RAW = ("date date, open double, high double, low double, close double, adj_close double, "
       "volume long, ticker string, ingested_at string, source string, company_name string, "
       "sector string, exchange string")


def raw_row(day, close=33.75, ticker="QRS"):
    return (day, 31.25, 34.0, 30.5, close, 33.5, 640000, ticker, "2024-01-02T00:00:00",
            "yahoo_finance", "Quarry Stone", "Materials", "NASDAQ")


def parquet_dirs(root):
    out = set()
    for d, _, fs in os.walk(root):
        if any(f.endswith(".parquet") for f in fs):
            out.add(os.path.relpath(d, root))
    return out


def test_daily_layout_path(spark, tmp_dir):
    root = f"{tmp_dir}/stock_prices"
    df = spark.createDataFrame([raw_row(dt.date(2024, 1, 2))], RAW)
    assert files.append_idempotent(df, root, "daily").get["rows_written"] == 1
    assert parquet_dirs(root) == {"ticker=QRS/year=2024/month=01/day=02"}


def test_daily_layout_query_lands_every_row(spark, monkeypatch):
    from tickvault.plans import catalog, catalog_raw  # noqa: F401 (the registry imports its parts in order)
    from tickvault.sources import fixtures

    sf_dir, append, calls = "/root/testdata/sf0.001", files.append_idempotent, []

    def noted(df, root, layout):
        obs = append(df, root, layout)
        calls.append((root, obs.get["rows_written"]))
        return obs

    monkeypatch.setattr(catalog_raw.files, "append_idempotent", noted)
    catalog_raw.q_daily_layout(spark, sf_dir)
    rows = fixtures.wide_quotes(spark, sf_dir)
    (root, first), (again, second) = calls
    assert root == again and (first, second) == (rows.count(), 0)
    back = catalog_raw.read_quotes(spark, root, "daily").select(*rows.columns)
    assert back.exceptAll(rows).isEmpty() and back.count() == first
    assert not back.where("date IS NULL").isEmpty() and not back.where("ticker IS NULL").isEmpty()


def test_daily_layout_is_written_by_several_tasks(spark, tmp_dir):
    root = f"{tmp_dir}/stock_prices"
    rows = [raw_row(dt.date(2024, 1, 1 + k % 28), ticker=f"Q{k // 28}") for k in range(56)]
    files.append_idempotent(spark.createDataFrame(rows, RAW), root, "daily")
    names = [f for _, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]
    assert len(names) == 56 and len({n.split("-")[1] for n in names}) > 1


def spoil(root, folder=""):
    """Makes the data files below a folder unreadable."""
    for d, _, fs in os.walk(f"{root}/{folder}"):
        for f in fs:
            if f.endswith(".parquet"):
                with open(f"{d}/{f}", "wb") as out:
                    out.write(b"no Parquet file")


def test_daily_layout_keys_come_from_folder_names(spark, tmp_dir):
    """The second landing lists tens of thousands of one-row files, and opens none; none has a checksum file."""
    root = f"{tmp_dir}/stock_prices"
    tickers = ["QRS", "A/B", "A+B", "A B", "A%B", "A=B", "001", "é", None]
    rows = [raw_row(day, ticker=t) for t in tickers for day in (dt.date(2024, 1, 2), dt.date(2023, 12, 31), None)]
    df = spark.createDataFrame(rows, RAW)
    assert files.append_idempotent(df, root, "daily").get["rows_written"] == len(rows)
    assert not [f for _, _, fs in os.walk(root) for f in fs if "parquet" in f and f.endswith(".crc")]
    back = landing.read_raw(spark, root, "daily", df.schema)
    assert back.columns == [c for c in df.columns if c != "ticker"][:7] + ["ticker"] + df.columns[8:] + ["year", "month", "day"]
    assert back.select(*df.columns).exceptAll(df).isEmpty() and back.count() == len(rows)
    assert {(r["date"], r["year"], r["month"], r["day"]) for r in back.collect()} == {
        (dt.date(2024, 1, 2), 2024, 1, 2), (dt.date(2023, 12, 31), 2023, 12, 31), (None, None, None, None)}
    spoil(root)
    more = spark.createDataFrame([*rows, raw_row(dt.date(2024, 1, 3))], RAW)
    assert files.append_idempotent(more, root, "daily").get["rows_written"] == 1


def test_daily_layout_scan_opens_only_the_window(spark, tmp_dir):
    root = f"{tmp_dir}/stock_prices"
    rows = [raw_row(dt.date(2023, 12, 31)), raw_row(dt.date(2024, 1, 2)), raw_row(dt.date(2024, 1, 2), ticker="XYZ")]
    files.append_idempotent(spark.createDataFrame(rows, RAW), root, "daily")
    spoil(root, "ticker=QRS/year=2023")
    spoil(root, "ticker=XYZ")
    df = landing.read_raw(spark, root, "daily")
    assert landing.scan_range(df, "2024-01-01", None, ["QRS"]).count() == 1


def test_existing_partition_is_skipped_first_write_wins(spark, tmp_dir):
    root = f"{tmp_dir}/stock_prices"
    files.append_idempotent(spark.createDataFrame([raw_row(dt.date(2024, 1, 2))], RAW), root, "daily")
    again = spark.createDataFrame([raw_row(dt.date(2024, 1, 2), close=999.0)], RAW)
    assert files.append_idempotent(again, root, "daily").get["rows_written"] == 0
    back = landing.read_raw(spark, root, "daily")
    assert [r["close"] for r in back.collect()] == [33.75]


def test_empty_batch_writes_nothing(spark, tmp_dir):
    root = f"{tmp_dir}/stock_prices"
    empty = spark.createDataFrame([], RAW)
    assert files.append_idempotent(empty, root, "daily").get["rows_written"] == 0
    assert parquet_dirs(root) == set()


def test_two_dates_two_partitions(spark, tmp_dir):
    root = f"{tmp_dir}/stock_prices"
    df = spark.createDataFrame([raw_row(dt.date(2024, 1, 2)), raw_row(dt.date(2024, 1, 3))], RAW)
    files.append_idempotent(df, root, "daily")
    assert parquet_dirs(root) == {"ticker=QRS/year=2024/month=01/day=02",
                                  "ticker=QRS/year=2024/month=01/day=03"}


def test_monthly_layout_same_result(spark, tmp_dir):
    root = f"{tmp_dir}/m"
    df = spark.createDataFrame([raw_row(dt.date(2024, 1, 2)), raw_row(dt.date(2024, 2, 3))], RAW)
    files.append_idempotent(df, root)
    files.append_idempotent(df.withColumn("close", F.lit(1.0)), root)
    assert parquet_dirs(root) == {"year=2024/month=01", "year=2024/month=02"}
    assert sorted(r["close"] for r in landing.read_raw(spark, root).collect()) == [33.75, 33.75]


def test_dynamic_overwrite_keeps_other_tickers(spark, tmp_dir):
    root = f"{tmp_dir}/silver"
    df = spark.createDataFrame([raw_row(dt.date(2024, 1, 2), 1.0, "A"),
                                raw_row(dt.date(2024, 1, 2), 2.0, "B")], RAW)
    files.overwrite_partitions(df, root)
    files.overwrite_partitions(df.where("ticker = 'A'").withColumn("close", F.lit(9.0)), root)
    got = {r["ticker"]: r["close"] for r in spark.read.parquet(root).collect()}
    assert got == {"A": 9.0, "B": 2.0}
    files.overwrite_partitions(df.where("ticker = 'A'"), root, dynamic=False)
    assert {r["ticker"] for r in spark.read.parquet(root).collect()} == {"A"}


def test_quarantine_writes_only_when_rejects(spark, tmp_dir):
    root = f"{tmp_dir}/rejected"
    good = spark.createDataFrame([raw_row(dt.date(2024, 1, 2))], RAW)
    assert files.write_quarantine(quality.rejected_rows(good), root, "20240102_060000") == 0
    assert not os.path.exists(f"{root}/run_ts=20240102_060000")
    bad = spark.createDataFrame([raw_row(dt.date(2024, 1, 2), close=-1.0)], RAW)
    assert files.write_quarantine(quality.rejected_rows(bad), root, "20240102_060000") == 1
    back = spark.read.parquet(root).first()
    assert back["failure_reason"] == "non_positive_price" and back["run_ts"] == "20240102_060000"


def test_truncate_load_replaces_and_projects(spark, tmp_dir):
    path = f"{tmp_dir}/export"
    df = spark.createDataFrame([raw_row(dt.date(2024, 1, 2))], RAW).withColumn("extra", F.lit(1))
    files.truncate_load(df, path, SILVER_SCHEMA)
    files.truncate_load(df.union(df), path, SILVER_SCHEMA)
    back = spark.read.parquet(path)
    assert back.count() == 2 and "extra" not in back.columns
    assert back.columns == SILVER_SCHEMA.fieldNames()
    assert back.where("daily_return IS NOT NULL OR layer IS NOT NULL").count() == 0
    with pytest.raises(files.EmptyLoadError):
        files.truncate_load(df.limit(0), path, SILVER_SCHEMA)
    assert spark.read.parquet(path).count() == 2


def test_path_key_from_folder(spark, tmp_dir):
    root = f"{tmp_dir}/silver"
    df = spark.createDataFrame([raw_row(dt.date(2024, 1, 2), ticker="TUV")], RAW)
    df.drop("ticker").write.parquet(f"{root}/ticker=TUV")
    with open(f"{root}/notes.txt", "w") as fh:
        fh.write("not data")
    out = landing.read_files_with_path_key(spark, root, "ticker")
    assert [r["ticker"] for r in out.collect()] == ["TUV"]


def test_no_input_raises(spark, tmp_dir):
    with pytest.raises(landing.NoInputError):
        landing.read_raw(spark, f"{tmp_dir}/missing")
    with pytest.raises(landing.NoInputError):
        landing.require_rows(spark.createDataFrame([], RAW))


def test_partition_restricted_read(spark, tmp_dir):
    root = f"{tmp_dir}/silver"
    df = spark.createDataFrame([raw_row(dt.date(2024, 1, 2), 1.0, "A"),
                                raw_row(dt.date(2024, 1, 2), 2.0, "B")], RAW)
    files.overwrite_partitions(df, root)
    part = landing.read_partition(spark, root, "ticker=B")
    assert [(r["ticker"], r["close"]) for r in part.collect()] == [("B", 2.0)]
    plan = landing.scan_range(spark.read.parquet(root), tickers=["A"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ticker" in plan


def test_half_open_range(spark):
    df = spark.createDataFrame([raw_row(dt.date(2024, 1, d)) for d in (1, 2, 3)], RAW)
    out = landing.scan_range(df, "2024-01-02", "2024-01-03")
    assert [r["date"] for r in out.collect()] == [dt.date(2024, 1, 2)]


FACT = ("date_key int, ticker_key long, open_price double, high_price double, low_price double, "
        "close_price double, adj_close_price double, volume long, daily_return double, "
        "price_range double, created_at timestamp")


def fact_row(dk, tk, close, ts):
    return (dk, tk, 1.0, 2.0, 0.5, close, close, 10, None, 1.5, ts)


def test_upsert_replaces_by_key_and_is_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    t1, t2 = dt.datetime(2024, 1, 2, 6), dt.datetime(2024, 1, 3, 6)
    first = spark.createDataFrame([fact_row(20240102, 1, 1.0, t1), fact_row(20240102, 2, 2.0, t1),
                                   fact_row(20240301, 1, 3.0, t1)], FACT)
    tables.upsert_table(first, path, ["date_key", "ticker_key"])
    upd = spark.createDataFrame([fact_row(20240102, 2, 20.0, t2), fact_row(20240103, 2, 5.0, t2)], FACT)
    tables.upsert_table(upd, path, ["date_key", "ticker_key"])
    tables.upsert_table(upd, path, ["date_key", "ticker_key"])
    got = {(r["date_key"], r["ticker_key"]): r["close_price"]
           for r in tables.read_table(spark, path).collect()}
    assert got == {(20240102, 1): 1.0, (20240102, 2): 20.0, (20240301, 1): 3.0, (20240103, 2): 5.0}


def month_fact(spark, months, close, ts):
    return spark.createDataFrame([fact_row(20240002 + m * 100, 1, close, ts) for m in months], FACT)


@pytest.mark.parametrize("after", [0, 1, 2, 3])
def test_upsert_survives_a_crash_between_folder_swaps(spark, tmp_dir, monkeypatch, after):
    """The driver dies after some folders were swapped; the retry ends with all rows."""
    path, keys = f"{tmp_dir}/fact", ["date_key", "ticker_key"]
    t1, t2 = dt.datetime(2024, 1, 2, 6), dt.datetime(2024, 1, 3, 6)
    tables.upsert_table(month_fact(spark, (1, 2, 3), 1.0, t1), path, keys)
    real, done = files.swap_in, []

    def dying(spark_, staging, target, trash=None):
        if "/month_key=" in target:
            if len(done) == after:
                raise KeyboardInterrupt
            done.append(target)
        real(spark_, staging, target, trash)

    monkeypatch.setattr(tables, "swap_in", dying)
    if after < 3:
        with pytest.raises(KeyboardInterrupt):
            tables.upsert_table(month_fact(spark, (1, 2, 3), 9.0, t2), path, keys)
    else:       # dies before the cleanup
        monkeypatch.setattr(tables, "delete_path", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            tables.upsert_table(month_fact(spark, (1, 2, 3), 9.0, t2), path, keys)
    monkeypatch.undo()
    back = tables.read_table(spark, path)
    # Either the whole upsert is in, or none of it is.
    stamps = {r["created_at"] for r in back.collect()}
    assert len(stamps) == 1 and back.count() == 3
    tables.upsert_table(month_fact(spark, (1, 2, 3), 9.0, t2), path, keys)
    assert sorted((r["date_key"], r["close_price"]) for r in tables.read_table(spark, path).collect()) == [
        (20240102, 9.0), (20240202, 9.0), (20240302, 9.0)]


def test_crash_while_a_month_is_out_loses_nothing(spark, tmp_dir):
    path, keys = f"{tmp_dir}/fact", ["date_key", "ticker_key"]
    t1 = dt.datetime(2024, 1, 2, 6)
    tables.upsert_table(month_fact(spark, (1, 2), 1.0, t1), path, keys)
    os.makedirs(f"{path}.staging/_trash")
    os.makedirs(f"{path}.staging/ready-x")
    month_fact(spark, (1,), 5.0, t1).write.parquet(f"{path}.staging/ready-x/month_key=202401")
    open(f"{path}.staging/ready-x/_READY", "w").close()
    os.rename(f"{path}/month_key=202401", f"{path}.staging/_trash/old")     # first of the two renames
    assert sorted(r["close_price"] for r in tables.read_table(spark, path).collect()) == [1.0, 5.0]


def test_unreadable_table_is_not_replaced(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    os.makedirs(f"{path}/month_key=202401")
    with open(f"{path}/month_key=202401/part-0.parquet", "w") as fh:
        fh.write("not parquet")
    with pytest.raises(Exception):
        tables.upsert_table(month_fact(spark, (1,), 1.0, dt.datetime(2024, 1, 2)), path, ["date_key", "ticker_key"])
    assert os.path.exists(f"{path}/month_key=202401/part-0.parquet")


def test_key_held_twice_is_refused(spark, tmp_dir):
    rows = month_fact(spark, (1, 1), 1.0, dt.datetime(2024, 1, 2))
    with pytest.raises(tables.DuplicateKeyError):
        tables.upsert_table(rows, f"{tmp_dir}/fact", ["date_key", "ticker_key"])


@pytest.mark.parametrize("layout", ["monthly", "daily"])
def test_rows_without_a_date_are_appended_once(spark, tmp_dir, layout):
    root = f"{tmp_dir}/raw"
    undated = spark.createDataFrame([raw_row(None)], RAW)
    both = spark.createDataFrame([raw_row(None), raw_row(dt.date(2024, 1, 2))], RAW)
    assert files.append_idempotent(undated, root, layout).get["rows_written"] == 1
    assert files.append_idempotent(undated, root, layout).get["rows_written"] == 0
    assert files.append_idempotent(both, root, layout).get["rows_written"] == 1
    assert files.append_idempotent(both, root, layout).get["rows_written"] == 0
    assert landing.read_raw(spark, root, layout).count() == 2
    other = spark.createDataFrame([raw_row(dt.date(2024, 5, 2))], RAW)
    files.append_idempotent(other, f"{root}2", layout)
    assert files.append_idempotent(undated, f"{root}2", layout).get["rows_written"] == 1


def test_schema_change_fails(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    t1 = dt.datetime(2024, 1, 2, 6)
    first = spark.createDataFrame([fact_row(20240102, 1, 1.0, t1)], FACT)
    tables.upsert_table(first, path, ["date_key", "ticker_key"])
    with pytest.raises(SchemaChangeError):
        tables.upsert_table(first.withColumn("extra", F.lit(1)), path,
                            ["date_key", "ticker_key"])


def test_scan_day_and_views(spark, tmp_dir):
    df = spark.createDataFrame([raw_row(dt.date(2024, 1, d)) for d in (1, 2, 3)], RAW)
    assert [r["date"] for r in landing.scan_day(df, "2024-01-02").collect()] == [dt.date(2024, 1, 2)]
    assert landing.next_day("2024-02-28") == "2024-02-29"
    df.write.parquet(f"{tmp_dir}/t")
    landing.register_views(spark, {"prices_view": f"{tmp_dir}/t"})
    assert spark.sql("SELECT COUNT(*) FROM prices_view").first()[0] == 3
    assert landing.sample_row(df) is not None
    assert landing.sample_row(df.limit(0)) is None


def test_raw_batch_defaults(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    today = dt.date.today()
    rows = [raw_row(dt.date(2019, 12, 31), ticker="NVDA"), raw_row(dt.date(2020, 1, 2), ticker="NVDA"),
            raw_row(dt.date(2020, 1, 2), ticker="ZZZZ"), raw_row(today, ticker="JPM")]
    files.append_idempotent(spark.createDataFrame(rows, RAW), root)
    got = [(r["ticker"], r["date"]) for r in landing.raw_batch(spark, root).collect()]
    assert got == [("NVDA", dt.date(2020, 1, 2))]


def test_compaction_keeps_rows_and_merges_files(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    for d in (2, 3, 4):
        files.append_idempotent(spark.createDataFrame([raw_row(dt.date(2024, 1, d)),
                                                       raw_row(dt.date(2024, 2, d))], RAW), root)

    def n_files(folder):
        return len([f for f in os.listdir(folder) if f.endswith(".parquet")])

    assert n_files(f"{root}/year=2024/month=01") == 3
    before = sorted(tuple(r) for r in landing.read_raw(spark, root).collect())
    schema = files.raw_read_schema(landing.read_raw(spark, root).drop("year", "month").schema, "monthly")
    n = files.compact_partitions(spark, root, ["year", "month"], f"{tmp_dir}/staging",
                                 where="year = 2024 AND month = 1", schema=schema)
    assert n == 1
    assert n_files(f"{root}/year=2024/month=01") == 1 and n_files(f"{root}/year=2024/month=02") == 3
    after = sorted(tuple(r) for r in landing.read_raw(spark, root).collect())
    assert after == before


def test_path_values_keep_special_characters(spark, tmp_dir):
    root = f"{tmp_dir}/silver"
    df = spark.createDataFrame([raw_row(dt.date(2024, 1, 2), ticker=t) for t in ("BRK+B", "A:B", "X%Y")], RAW)
    files.overwrite_partitions(df, root, ["ticker"])
    got = sorted(r["ticker"] for r in landing.read_files_with_path_key(spark, root, "ticker").collect())
    assert got == ["A:B", "BRK+B", "X%Y"]


def test_upsert_after_empty_first_load(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    t1 = dt.datetime(2024, 1, 2, 6)
    tables.upsert_table(spark.createDataFrame([], FACT), path, ["date_key", "ticker_key"])
    assert tables.read_table(spark, path) is None or tables.read_table(spark, path).count() == 0
    tables.upsert_table(spark.createDataFrame([fact_row(20240102, 1, 1.0, t1)], FACT), path,
                        ["date_key", "ticker_key"])
    assert tables.read_table(spark, path).count() == 1


def test_raw_file_from_another_writer_is_normalised(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from tickvault.operators import quality
    folder = f"{tmp_dir}/raw/year=2024/month=1"
    os.makedirs(folder)
    table = pa.table({
        "date": pa.array([dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)], pa.timestamp("us")),
        "open": [31.25, float("nan")], "high": [34.0, 34.0], "low": [30.5, 30.5],
        "close": [33.75, 33.75], "adj_close": [float("nan"), 33.5],
        "volume": [640000.0, 7.0],  # padded download: inferred as DOUBLE
        "ticker": ["QRS", "QRS"],
    })
    pq.write_table(table, f"{folder}/data.parquet", coerce_timestamps="us")
    df = landing.read_raw(spark, f"{tmp_dir}/raw", foreign=True)
    types = dict(df.dtypes)
    assert types["date"] == "date" and types["volume"] == "bigint" and types["company_name"] == "string"
    rows = {r["date"]: r for r in quality.flag(df).collect()}
    first, second = rows[dt.date(2024, 1, 2)], rows[dt.date(2024, 1, 3)]
    assert first["adj_close"] is None and first["failure_reason"] is None
    assert second["open"] is None and second["failure_reason"] == "null_in_critical_column"
    assert first["volume"] == 640000
