"""Unlike files, footer statistics, compaction by bytes, data tests by month."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickvault.operators import checks, months
from tickvault.plans import warehouse as P
from tickvault.schemas import SchemaChangeError
from tickvault.sinks import compaction, files
from tickvault.sources import footers, landing
from test_commits import raw_rows


# ---- unlike files ---------------------------------------------------------------

@pytest.fixture
def unlike(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    spark.createDataFrame([(1, 2.0)], "a int, b double").write.parquet(f"{root}/k=x")
    spark.createDataFrame([(3, 4.0, "c")], "a int, b double, c string").write.parquet(f"{root}/k=y")
    return root


def test_a_column_of_some_files_is_kept(spark, unlike):
    df = landing.read_files_with_path_key(spark, unlike, "k")
    assert set(df.columns) == {"a", "b", "c", "k"}
    assert sorted(map(tuple, df.select("a", "b", "c", "k").collect())) == [(1, 2.0, None, "x"), (3, 4.0, "c", "y")]


def test_declared_schema_refuses_fills_and_widens(spark, unlike, tmp_dir):
    schema = lambda text: T._parse_datatype_string(text)
    with pytest.raises(SchemaChangeError, match="new column c"):
        landing.read_files_with_path_key(spark, unlike, "k", schema=schema("a int, b double"))
    with pytest.raises(SchemaChangeError, match="type change b"):
        landing.read_files_with_path_key(spark, unlike, "k", schema=schema("a int, b string, c string"))
    wide = landing.read_files_with_path_key(spark, unlike, "k", schema=schema("a bigint, b double, c string, d date"))
    assert sorted(map(tuple, wide.select("a", "c", "d").collect()), key=repr) == [(1, None, None), (3, "c", None)]
    assert dict(wide.dtypes)["a"] == "bigint"
    # Files of unequal types: an error by themselves, widened under a declared schema.
    root = f"{tmp_dir}/mixed"
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{root}/k=x")
    spark.createDataFrame([(2 ** 40,)], "a bigint").write.parquet(f"{root}/k=y")
    with pytest.raises(Exception, match="CANNOT_MERGE"):
        landing.read_files_with_path_key(spark, root, "k")
    both = landing.read_files_with_path_key(spark, root, "k", schema=schema("a bigint"))
    assert sorted(r["a"] for r in both.collect()) == [1, 2 ** 40]


# ---- footers ----------------------------------------------------------------------

def test_statistics_come_from_the_footers(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    rows = [(k, dt.date(2020, 1, 1) + dt.timedelta(k), k / 7, "x" * k, dt.datetime(2024, 1, 1)) for k in range(40)] + [(None,) * 5]
    spark.createDataFrame(rows, "i long, d date, x double, s string, t timestamp").repartition(3).write.parquet(path)
    stats = footers.footer_stats(spark, path, ["i", "d", "x"])
    assert tuple(stats.first()) == (41, 0, 39, dt.date(2020, 1, 1), dt.date(2020, 2, 9), 0.0, 39 / 7)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(i), MAX(i)" in plan and "PushedGroupBy: []" in plan
    for c in ("s", "t"):
        with pytest.raises(ValueError):
            footers.footer_stats(spark, path, [c])
    assert not footers.is_empty(spark, path)
    spark.createDataFrame([], "i long").write.parquet(f"{tmp_dir}/none")
    assert footers.is_empty(spark, f"{tmp_dir}/none")
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"     # the caller's session is as it was


# ---- compaction ------------------------------------------------------------------

def test_packs():
    small, fit, big = [("a", 10), ("b", 30), ("c", 20)], [("f", 90), ("g", 190)], [("h", 950)]
    pack = lambda *files_: compaction.plan({"x": list(files_)}, 100)
    assert pack(*small) == [compaction.Pack("x", ("a", "b", "c"), 1)]
    assert pack(*fit) == pack(small[0], *fit) == pack() == []
    assert pack(*big, *small, *fit) == [compaction.Pack("x", ("a", "b", "c", "h"), 10)]
    assert pack(*[(str(k), 40) for k in range(10)])[0].slots == 4


def test_files_come_near_the_target_and_others_stay(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    rows = spark.range(60_000).select("id", F.rand(1).alias("x"), (F.col("id") % 3).cast("string").alias("part"))
    for k in range(8):
        rows.where(F.col("id") % 8 == k).where("part <> '2'").write.mode("append").partitionBy("part").parquet(root)
    rows.where("part = '2'").coalesce(1).write.mode("append").partitionBy("part").parquet(root)
    spark.createDataFrame([(-1, 0.5, "a b/c+d%e")], "id long, x double, part string").write.mode("append").partitionBy("part").parquet(root)
    spark.createDataFrame([(-2, 0.5, "a b/c+d%e")], "id long, x double, part string").write.mode("append").partitionBy("part").parquet(root)
    before = compaction.list_data_files(spark, root)
    target = before["part=2"][0][1]
    assert all(b < target / 2 for own in (before["part=0"], before["part=1"]) for _, b in own)
    done = compaction.compact_by_bytes(spark, root, target)
    assert {p.folder: p.slots for p in done}["part=0"] == 1 and "part=2" not in {p.folder for p in done} and len(done) == 3
    after = compaction.list_data_files(spark, root)
    assert after["part=2"] == before["part=2"]                              # untouched
    assert all(len(after[f]) == 1 and target / 2 <= after[f][0][1] <= 2 * target for f in ("part=0", "part=1"))
    back = spark.read.parquet(root)
    assert back.count() == 60_002 and back.agg(F.sum("id")).first()[0] == 60_000 * 59_999 // 2 - 3
    assert {r["part"] for r in back.where("id < 0").collect()} == {"a b/c+d%e"}
    assert compaction.compact_by_bytes(spark, root, target) == []
    # Too large files are split.
    assert {p.folder: p.slots for p in compaction.compact_by_bytes(spark, root, target // 4)}["part=2"] == 4
    sizes = [b for f, own in compaction.list_data_files(spark, root).items() if f != "part=a b%2Fc+d%25e" for _, b in own]
    assert all(target / 8 <= b <= target / 2 for b in sizes[:-1])
    assert spark.read.parquet(root).count() == 60_002


def test_compaction_reads_whole_folders_as_one_path():
    listing = {"y=1/m=1": [("a", 1), ("b", 1)], "y=1/m=2": [("c", 1), ("d", 1), ("e", 10)], "y=2": [("f", 1), ("g", 1)],
               "y=2/m=1": [("h", 1), ("i", 1)]}
    paths = compaction.sources(listing, compaction.plan(listing, 10))
    assert paths == ["y=1/m=1", "y=1/m=2/c", "y=1/m=2/d", "y=2/f", "y=2/g", "y=2/m=1"]


def test_listing_leaves_out_hidden_folders(spark, tmp_dir):
    for name in ("part=1/x.parquet", "part=1/x.txt", "_old/y.parquet", "part=2/.tmp/z.parquet", "w.parquet"):
        os.makedirs(os.path.dirname(f"{tmp_dir}/t/{name}"), exist_ok=True)
        open(f"{tmp_dir}/t/{name}", "w").close()
    assert compaction.list_data_files(spark, f"{tmp_dir}/t") == {"part=1": [("x.parquet", 0)], "": [("w.parquet", 0)]}


def test_compaction_stopped_before_its_moves(spark, tmp_dir, monkeypatch):
    from tickvault.sinks.journal import Journal
    root = f"{tmp_dir}/t"
    for k in range(4):
        spark.range(k * 10, k * 10 + 10).write.mode("append").parquet(root)
    monkeypatch.setattr(Journal, "_apply", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        compaction.compact_by_bytes(spark, root, 1 << 20)
    monkeypatch.undo()
    assert spark.read.parquet(root).count() == 40
    assert compaction.compact_by_bytes(spark, root, 1 << 20) == []          # finished by the next one
    assert spark.read.parquet(root).count() == 40 and len(compaction.list_data_files(spark, root)[""]) == 1


# ---- data tests by month -------------------------------------------------------------

def verdicts(df):
    return sorted((r["test_name"], r["failures"], r["status"], r["table_name"], r["kind"], r["column_name"]) for r in df.collect())


def test_changed_months_give_the_verdicts_of_the_whole_suite(spark, tmp_dir):
    paths = P.Paths(f"{tmp_dir}/w")
    rows = [(dt.date(2023, m, 3), t, 10.0 + m, "1") for m in (1, 2, 5) for t in "AB"]
    run = lambda k: P.Run(f"r{k}", dt.datetime(2024, 1, k + 1), silver_layout="month", changed_only=True)

    def build(k, more):
        r = run(k)
        P.ingest_rows(spark, raw_rows(spark, more), paths, r)
        P.build_silver(spark, paths, r)
        P.build_gold(spark, paths, r)
        return r

    r = build(0, rows)
    found = verdicts(P.run_changed_tests(spark, paths, r))
    assert r.metrics["months_tested"] is None and found == verdicts(P.run_data_tests(spark, paths)) and len(found) == 18
    r = build(1, rows + [(dt.date(2023, 2, 20), "A", 7.0, "2")])
    assert verdicts(P.run_changed_tests(spark, paths, r)) == found
    assert r.metrics["months_tested"] == [202302, 202305]                   # the changed month and the mended one
    # Faults in one month's files are found when that month is tested, and stay in the sum.
    fault = f"{paths.fact}/month_key=202305"
    broken = spark.read.parquet(fault).withColumns({"close_price": F.lit(None).cast("double"), "ticker_key": F.lit(99).cast("long")}).collect()
    schema = spark.read.parquet(fault).schema
    files.delete_path(spark, fault)
    spark.createDataFrame(broken, schema).write.parquet(fault)
    P.journal(spark, paths).note(untested_months=[202305])
    bad = verdicts(P.run_changed_tests(spark, paths, run(2)))
    assert bad == verdicts(P.run_data_tests(spark, paths)) and sum(f for _, f, *_ in bad) == 2 * len(broken)
    P.journal(spark, paths).note(untested_months=[202301])
    r = run(3)
    assert verdicts(P.run_changed_tests(spark, paths, r)) == bad and r.metrics["months_tested"] == [202301]


def test_folder_results_read_only_their_folders(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.createDataFrame([(1, 1), (None, 1), (7, 2)], "k int, month_key int").write.partitionBy("month_key").parquet(path)
    parent = spark.createDataFrame([(1,)], "k int")
    tests = [checks.DataTest("not_null", "t", "k"), checks.DataTest("relationships", "t", "k", "p", "k")]
    part = checks.folder_results(spark.read.parquet(path).where("month_key = 2"), tests, {"p": parent}, months.MONTH_KEY)
    assert sorted(map(tuple, part.collect())) == [(2, "not_null_t_k", 0), (2, "relationships_t_k__k__p", 1)]
    scan = [x for x in part._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert any("PartitionFilters: [isnotnull(month_key" in x and "= 2" in x for x in scan)
