"""Plan-shape checks that guard the scale design (not just results)."""

from pyspark.sql import functions as F

from tickvault.operators import dims, enrich, fact, quality
from tickvault.sinks import files
from tickvault.sources import fixtures, landing

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_star_join_broadcasts_both_dimensions(spark, tmp_dir):
    q = quality.dedup_latest(quality.clean_rows(fixtures.quotes(spark, SF)))
    s = stored(spark, enrich.enrich_silver(q.withColumns({"company_name": F.lit(""), "sector": F.lit(""),
                                                          "exchange": F.lit("")}), "x"), f"{tmp_dir}/s")
    dt_ = stored(spark, dims.dim_ticker(s), f"{tmp_dir}/t")
    p = plan(fact.fact_prices(s, dims.dim_date(spark), dt_))
    assert p.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in p


def test_bucketed_lag_shuffles_big_input_once(spark, tmp_dir):
    rows = fixtures.quotes(spark, SF).select("ticker", "date", "src_id", "close") \
        .where("ticker IS NOT NULL AND date IS NOT NULL")
    src = stored(spark, rows, f"{tmp_dir}/q")
    p = plan(enrich.with_prev_close(src, tiebreak=["src_id"]))
    # (ticker, month) for the window, plus two on the per-month summary.
    assert p.count("Exchange hashpartitioning") <= 3
    assert "SinglePartition" not in p
    assert p.count("Exchange hashpartitioning(ticker#") >= 1


def test_dedup_combines_map_side(spark):
    p = plan(quality.dedup_latest(fixtures.quotes(spark, SF)))
    assert "partial_max(" in p


def test_day_scan_prunes_month_folders_and_pushes_dates(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    files.append_idempotent(fixtures.quotes(spark, SF), root)
    p = plan(landing.scan_day(landing.read_raw(spark, root), "2016-03-01", ["T01", "T02"]))
    assert "PartitionFilters: [isnotnull(year" in p and "month" in p.split("PartitionFilters")[1][:300]
    assert "GreaterThanOrEqual(date,2016-03-01)" in p and "In(ticker" in p


def test_rule_reason_only_for_rejected_rows(spark):
    p = plan(quality.rejected_rows(fixtures.quotes(spark, SF)))
    # One filter, then the CASE for the reason: no shuffle, no join.
    assert "Filter" in p and "CASE WHEN" in p and "Exchange" not in p and "Join" not in p


def test_ticker_table_restriction_prunes_partitions_at_runtime(spark, tmp_dir):
    root = f"{tmp_dir}/silver"
    q = quality.clean_rows(fixtures.quotes(spark, SF))
    files.overwrite_partitions(q, root, ["ticker"])
    wanted = fixtures.meta(spark, SF).where(F.col("exchange") == "NYSE")
    p = plan(landing.scan_range(spark.read.parquet(root), tickers=wanted))
    assert "dynamicpruningexpression(ticker" in p


def test_bucketed_rows_are_not_shuffled_again(spark, tmp_dir):
    from tickvault.sinks import bucketed

    assert bucketed.bucket_count(0) == 1 and bucketed.bucket_count((256 << 20) + 1) == 2
    bucketed.write_bucketed(quality.clean_rows(fixtures.quotes(spark, SF)), "bucketed_test", f"{tmp_dir}/b", 4)
    rows = bucketed.read_bucketed(spark, "bucketed_test")
    kept = bucketed.dedup_bucketed(rows)
    p = plan(kept)
    assert "Exchange" not in p and "Bucketed: true" in p
    returns = bucketed.daily_returns(kept)
    p = plan(returns)
    # The window over the rows needs none either; the summary of months does, by ticker and back.
    window = [x for x in p.splitlines() if "Exchange" in x]
    assert len(window) <= 2 and all("BroadcastExchange" in x or "hashpartitioning(ticker#" in x for x in window)
    assert sum("hashpartitioning" in x for x in window) == 1
    expect = enrich.with_daily_return(quality.dedup_latest(quality.clean_rows(fixtures.quotes(spark, SF))), tiebreak=["src_id"])
    cols = ["src_id", "daily_return"]
    assert returns.select(cols).exceptAll(expect.select(cols)).count() == 0 and returns.count() == expect.count()
    spark.sql("DROP TABLE bucketed_test")
