import datetime as dt

from pyspark.sql import functions as F

from tickvault.operators import checks, quality
from tickvault.plans import warehouse as P
from tickvault.schemas import SILVER_SCHEMA
from tickvault.sinks import tables
from tickvault.sources import fixtures

SF = "/root/testdata/sf0.001"


def download(spark):
    raw = quality.dedup_latest(fixtures.wide_quotes(spark, SF).where(F.col("ticker").isNotNull()))
    tickers = fixtures.fixture_tickers() + [fixtures.MISSING_TICKER]
    return fixtures.wide_frame(raw, tickers), tickers


def test_pipeline_twice_is_stable(spark, tmp_dir):
    wide, tickers = download(spark)
    paths = P.Paths(tmp_dir)
    meta = fixtures.wide_meta(spark, SF)
    run1 = P.Run("r1", dt.datetime(2024, 1, 2, 6))
    m1 = P.run_pipeline(spark, wide, paths, run1, tickers, meta)
    assert m1["failed_tickers"][-1] == "T99" and m1["status"] == "partial"
    assert m1["failing_tests"] == []
    assert m1["raw_rows_written"] > 0
    assert m1["total_rows"] == m1["clean_rows"] + m1["rejected_rows"]
    assert m1["quarantined"] == m1["rejected_rows"] + m1["duplicate_rows"] and m1["balanced"]
    export = spark.read.parquet(paths.export)
    assert export.columns == SILVER_SCHEMA.fieldNames() and export.count() == m1["silver_rows"] == m1["clean_rows"] - m1["duplicate_rows"]
    fact1 = tables.read_table(spark, paths.fact)
    silver = spark.read.parquet(paths.silver)
    in_range = silver.where(F.col("date").between(dt.date(2015, 1, 1), dt.date(2030, 12, 31)))
    assert fact1.count() == in_range.count() > 0
    n1 = fact1.count()

    run2 = P.Run("r2", dt.datetime(2024, 1, 3, 6))
    m2 = P.run_pipeline(spark, wide, paths, run2, tickers, meta)
    assert m2["raw_rows_written"] == 0 and m2["status"] == "partial"
    fact2 = tables.read_table(spark, paths.fact)
    assert fact2.count() == n1
    assert fact2.agg(F.min("created_at")).first()[0] == dt.datetime(2024, 1, 3, 6)
    keys = fact2.groupBy("date_key", "ticker_key").count().where("count > 1").count()
    assert keys == 0
    audit = spark.read.parquet(paths.audit).orderBy("run_id").collect()
    assert [(r["run_id"], r["status"]) for r in audit] == [("r1", "partial"), ("r2", "partial")]
    dim = {r["ticker_symbol"]: r["ticker_key"] for r in spark.read.parquet(paths.dim_ticker).collect()}
    assert dim["T00"] == 1 and len(dim) == spark.read.parquet(paths.silver).select("ticker").distinct().count()


def test_suite_reports_failures(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    tests = [checks.DataTest("unique", "p", "k"), checks.DataTest("not_null", "c", "k"),
             checks.DataTest("relationships", "c", "k", "p", "k")]
    out = {r["test_name"]: (r["failures"], r["status"])
           for r in checks.run_suite({"p": parent, "c": child}, tests).collect()}
    assert out == {"unique_p_k": (1, "fail"), "not_null_c_k": (1, "fail"),
                   "relationships_c_k__k__p": (1, "fail")}


def test_strict_run_raises_after_audit(spark, tmp_dir):
    import pytest
    wide, tickers = download(spark)
    paths = P.Paths(tmp_dir)
    with pytest.raises(P.PipelineFailed):
        P.run_pipeline(spark, wide, paths, P.Run("s1", dt.datetime(2024, 1, 2, 6)), tickers,
                       fixtures.wide_meta(spark, SF), strict=True)
    audit = spark.read.parquet(paths.audit).collect()
    assert [(r["run_id"], r["status"]) for r in audit] == [("s1", "partial")]


def test_month_layout_incremental_equals_full(spark, tmp_dir):
    wide, tickers = download(spark)
    meta = fixtures.wide_meta(spark, SF)
    split = dt.date(2018, 1, 1)
    full = P.Paths(f"{tmp_dir}/full")
    P.run_pipeline(spark, wide, full, P.Run("f", dt.datetime(2024, 1, 2, 6), silver_layout="month"),
                   tickers, meta)
    inc = P.Paths(f"{tmp_dir}/inc")
    P.run_pipeline(spark, wide.where(F.col("Date") < F.lit(split)), inc,
                   P.Run("i1", dt.datetime(2024, 1, 2, 6), silver_layout="month"), tickers, meta)
    m2 = P.run_pipeline(spark, wide, inc, P.Run("i2", dt.datetime(2024, 1, 3, 6), silver_layout="month",
                                                since=split.isoformat()), tickers, meta)
    assert m2["failing_tests"] == [] and m2["balanced"]
    cols = ["date_key", "ticker_key", "close_price", "volume", "daily_return", "price_range"]
    a = tables.read_table(spark, full.fact).select(cols)
    b = tables.read_table(spark, inc.fact).select(cols)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # Only the rebuilt months carry the second run's stamp.
    s = spark.read.parquet(inc.silver)
    stamps = {r[0] for r in s.where(F.col("date") >= F.lit(split)).select("processed_at").distinct().collect()}
    assert stamps == {"2024-01-03T06:00:00"}
    old = {r[0] for r in s.where(F.col("date") < F.lit(split)).select("processed_at").distinct().collect()}
    assert old == {"2024-01-02T06:00:00"}


def test_dedup_run_quarantines_duplicates(spark, tmp_dir):
    from tickvault.schemas import RAW_SCHEMA
    from tickvault.sinks import files as F_
    paths = P.Paths(tmp_dir)
    d = dt.date(2024, 1, 2)
    base = (31.25, 34.0, 30.5, 33.75, 33.5, 10, "QRS", "2024-01-02T00:00:00", "s", "", "", "")
    rows = [(d, *base), (d, *base), (dt.date(2024, 1, 3), *base), (d, -1.0, *base[1:])]
    F_.append_idempotent(spark.createDataFrame(rows, RAW_SCHEMA), paths.raw)
    run = P.Run("d", dt.datetime(2024, 1, 4, 6), dedup=True)
    P.build_silver(spark, paths, run)
    silver = spark.read.parquet(paths.silver)
    assert silver.count() == 2 and silver.groupBy("ticker", "date").count().where("count > 1").count() == 0
    q = {r["failure_reason"] for r in spark.read.parquet(paths.rejected).collect()}
    assert q == {"duplicate_key", "non_positive_price"}
    assert run.metrics["duplicate_rows"] == 1 and run.metrics["quarantined"] == 2
    assert run.metrics["balanced"]


def landed(spark, paths, rows):
    from tickvault.schemas import RAW_SCHEMA
    from tickvault.sinks import files as F_
    base = (31.25, 34.0, 30.5, 33.75, 33.5, 10)
    F_.append_idempotent(spark.createDataFrame(
        [(d, *base, t, i, "s", "", "", "") for d, t, i in rows], RAW_SCHEMA), paths.raw)


def test_month_runs_quarantine_undated_and_duplicate_rows(spark, tmp_dir):
    paths = P.Paths(tmp_dir)
    jan, feb = dt.date(2024, 1, 2), dt.date(2024, 2, 5)
    landed(spark, paths, [(jan, "A", "1"), (jan, "A", "2"), (feb, "A", "1"), (feb, "A", "1"), (None, "A", "1")])
    for since, total in ((None, 5), ("2024-02-10", 3)):
        run = P.Run("m", dt.datetime(2024, 3, 1, 6), silver_layout="month", since=since)
        P.build_silver(spark, paths, run)
        m = run.metrics
        assert (m["total_rows"], m["null_in_critical_column"], m["balanced"]) == (total, 1, True)
        assert m["duplicate_rows"] == (2 if since is None else 1)
    kept = spark.read.parquet(paths.silver)
    assert kept.count() == 2 and kept.where("date = DATE '2024-01-02'").first()["ingested_at"] == "2"


def test_whole_rebuild_drops_what_has_gone(spark, tmp_dir):
    import shutil
    jan, feb = dt.date(2024, 1, 2), dt.date(2024, 2, 5)
    for layout in ("ticker", "month"):
        paths = P.Paths(f"{tmp_dir}/{layout}")
        landed(spark, paths, [(jan, "A", "1"), (feb, "B", "1")])
        P.build_silver(spark, paths, P.Run("a", dt.datetime(2024, 3, 1, 6), silver_layout=layout))
        shutil.rmtree(f"{paths.raw}")
        landed(spark, paths, [(jan, "A", "1")])
        P.build_silver(spark, paths, P.Run("b", dt.datetime(2024, 3, 2, 6), silver_layout=layout))
        assert [r["ticker"] for r in spark.read.parquet(paths.silver).collect()] == ["A"]


def test_ticker_restricted_run_and_versions(spark, tmp_dir):
    paths = P.Paths(tmp_dir)
    landed(spark, paths, [(dt.date(2024, 1, 2), "A", "1"), (dt.date(2024, 1, 2), "B", "1")])
    P.build_silver(spark, paths, P.Run("a", dt.datetime(2024, 3, 1, 6)))
    run = P.Run("b", dt.datetime(2024, 3, 2, 6), tickers=["B"], ticker_versions=True)
    P.build_silver(spark, paths, run)
    stamps = {r["ticker"]: r["processed_at"] for r in spark.read.parquet(paths.silver).collect()}
    assert stamps == {"A": "2024-03-01T06:00:00", "B": "2024-03-02T06:00:00"}
    P.build_gold(spark, paths, run)
    assert spark.read.parquet(paths.dim_ticker).count() == 2 and tables.read_table(spark, paths.fact).count() == 2


def test_cluster_session_needs_a_shared_folder():
    import pytest
    from tickvault import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self):
            return None
        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
