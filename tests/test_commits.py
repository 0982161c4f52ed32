"""Commits of several tables, runs stopped anywhere, commit numbers as the mark, mended months."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tickvault.operators import enrich, months, quality
from tickvault.plans import warehouse as P
from tickvault.schemas import RAW_SCHEMA
from tickvault.sinks import files, tables
from tickvault.sinks.journal import Journal

DAY = dt.date(2023, 5, 3)


def raw_rows(spark, rows):
    """(date, ticker, close, ingested_at) as raw rows that pass the rules."""
    return spark.createDataFrame([(d, c, c + 2.0, c - 1.0, c, c, 7, t, i, "feed", f"{t} Ltd", "Tools", "X") for d, t, c, i in rows],
                                 RAW_SCHEMA)


# ---- the journal ---------------------------------------------------------------

def folder(spark, path, value):
    spark.createDataFrame([(value,)], "v string").write.parquet(path)


def content(spark, path):
    return spark.read.parquet(path).first()[0]


def test_commit_replaces_removes_and_keeps_marks(spark, tmp_dir):
    log = Journal(spark, f"{tmp_dir}/w")
    one = log.begin()
    folder(spark, one.folder("a"), "first")
    folder(spark, one.folder("b"), "gone soon")
    one.replace(one.folder("a"), f"{tmp_dir}/w/a")
    one.replace(one.folder("b"), f"{tmp_dir}/w/deep/b")
    one.marks["x"] = [1, None]
    assert one.done() == 1 and log.marks() == {"x": [1, None]}
    two = log.begin()
    folder(spark, two.folder("a"), "second")
    two.replace(two.folder("a"), f"{tmp_dir}/w/a")
    two.remove(f"{tmp_dir}/w/deep/b")
    assert two.done() == 2 and log.last() == 2
    assert content(spark, f"{tmp_dir}/w/a") == "second" and not files.path_exists(spark, f"{tmp_dir}/w/deep/b")
    log.note(y=5)
    assert log.marks() == {"x": [1, None], "y": 5}
    assert not files.path_exists(spark, two.stage)


def test_unfinished_work(spark, tmp_dir, monkeypatch):
    log = Journal(spark, f"{tmp_dir}/w")
    lost = log.begin()
    folder(spark, lost.folder("a"), "never committed")
    lost.replace(lost.folder("a"), f"{tmp_dir}/w/a")
    again = log.begin()
    assert not files.path_exists(spark, lost.stage) and not files.path_exists(spark, f"{tmp_dir}/w/a")
    folder(spark, again.folder("a"), "committed")
    again.replace(again.folder("a"), f"{tmp_dir}/w/a")
    monkeypatch.setattr(Journal, "_apply", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        again.done()
    monkeypatch.undo()
    assert not files.path_exists(spark, f"{tmp_dir}/w/a")
    for _ in range(2):
        Journal(spark, f"{tmp_dir}/w").recover()
        assert content(spark, f"{tmp_dir}/w/a") == "committed"


def test_a_move_into_a_removed_folder_is_refused(spark, tmp_dir):
    commit = Journal(spark, f"{tmp_dir}/w").begin()
    commit.replace(commit.folder("a"), f"{tmp_dir}/w/t/a")
    commit.remove(f"{tmp_dir}/w/t")
    with pytest.raises(ValueError):
        commit.done()


def test_old_journals_go(spark, tmp_dir, monkeypatch):
    from tickvault.sinks import journal
    monkeypatch.setattr(journal, "KEEP", 3)
    log = Journal(spark, f"{tmp_dir}/w")
    for k in range(6):
        log.note(k=k)
    assert log._numbers() == [4, 5, 6] and log.marks() == {"k": 5}


# ---- a run stopped after each of its file-system calls -----------------------------

class Stop(BaseException):
    pass


class Stopper:
    """Lets ``left`` file-system calls through, then stops the run before or after the next one."""

    CALLS = ("move", "delete_path", "write_text", "touch")

    def __init__(self, monkeypatch, left, after):
        self.left, self.after, self.seen, self.names = left, after, 0, []
        for name in self.CALLS:
            monkeypatch.setattr(files, name, self.watch(getattr(files, name)))
        monkeypatch.setattr(DataFrameWriter, "parquet", self.watch(DataFrameWriter.parquet))

    def watch(self, real):
        def call(*args, **kwargs):
            self.seen += 1
            self.names.append(real.__name__)
            if self.seen == self.left + 1 and not self.after:
                raise Stop
            out = real(*args, **kwargs)
            if self.seen == self.left + 1 and self.after:
                raise Stop
            return out

        return call


FIRST = [(DAY, "MMM", 10.0, "1"), (DAY, "ZZZ", 20.0, "1"), (dt.date(2023, 6, 1), "MMM", 11.0, "1")]
SECOND = FIRST + [(dt.date(2023, 5, 9), "AAA", 5.0, "2"), (dt.date(2023, 5, 30), "MMM", 16.0, "2"), (None, "MMM", 1.0, "2")]


def steps(spark, paths, rows, run):
    """A run's steps on raw rows (the download's reshaping writes nothing)."""
    log = P.journal(spark, paths)
    log.recover()
    known = log.marks().get("pending_months", [])
    note = lambda found: log.note(pending_months=known + [m for m in found if m not in known])
    obs = files.append_idempotent(raw_rows(spark, rows), paths.raw, announce=note)
    note(sorted(obs.get["months"]) + [None] * bool(obs.get["undated"]))
    P.build_silver(spark, paths, run)
    P.load_export(spark, paths)
    P.build_gold(spark, paths, run)


def second_run():
    return P.Run("two", dt.datetime(2023, 7, 1), silver_layout="month", changed_only=True)


def tables_of(spark, paths):
    gold = tables.read_table(spark, paths.fact).join(spark.read.parquet(paths.dim_ticker), "ticker_key")
    return (sorted(map(tuple, P.read_silver(spark, paths).select("ticker", "date", "close", "daily_return").collect())),
            sorted(map(tuple, spark.read.parquet(paths.silver_state).select("ticker", "date", "close").collect())),
            sorted(map(tuple, spark.read.parquet(paths.export).select("ticker", "date", "daily_return").collect())),
            sorted(map(tuple, spark.read.parquet(paths.rejected).select("ticker", "failure_reason").collect())),
            sorted(map(tuple, spark.read.parquet(paths.dim_ticker).select("ticker_symbol", "ticker_key").collect())),
            sorted(map(tuple, gold.select("ticker_symbol", "date_key", "ticker_key", "close_price", "daily_return").collect())))


@pytest.fixture(scope="module")
def begun(spark, tmp_path_factory):
    """A warehouse after its first run."""
    root = str(tmp_path_factory.mktemp("begun") / "w")
    steps(spark, P.Paths(root), FIRST, P.Run("one", dt.datetime(2023, 7, 2), silver_layout="month"))
    return root


def copy_of(begun, tmp_dir, name):
    import shutil
    return P.Paths(shutil.copytree(begun, f"{tmp_dir}/{name}/w"))


def test_stopped_anywhere_then_run_again(spark, tmp_dir, monkeypatch, begun):
    paths = copy_of(begun, tmp_dir, "whole")
    with monkeypatch.context() as m:
        counter = Stopper(m, 10 ** 9, True)
        steps(spark, paths, SECOND, second_run())
    want = tables_of(spark, paths)
    assert want[4] == [("AAA", 3), ("MMM", 1), ("ZZZ", 2)]
    assert ("MMM", dt.date(2023, 6, 1), 11.0, -0.3125) in want[0]          # follows the changed month
    assert counter.seen > 25
    # A stop in front of and behind every call takes ten minutes: ALL_STOPS=1.  Otherwise every
    # seventh move or mark is tried, and a write.
    stops = [k for k, name in enumerate(counter.names) if name in ("move", "touch")][::7] + [counter.names.index("parquet") + 1]
    for k in range(counter.seen) if os.environ.get("ALL_STOPS") else stops:
        paths = copy_of(begun, tmp_dir, f"stop{k}")
        with monkeypatch.context() as m:
            Stopper(m, k, k % 2 == 0)
            with pytest.raises(Stop):
                steps(spark, paths, SECOND, second_run())
        steps(spark, paths, SECOND, second_run())
        assert tables_of(spark, paths) == want, k


def test_keys_are_not_numbered_anew_under_a_fact(spark, tmp_dir, begun):
    paths = copy_of(begun, tmp_dir, "lost")
    files.delete_path(spark, paths.dim_ticker)
    with pytest.raises(P.LostDimension):
        P.build_gold(spark, paths, second_run())


def test_load_stopped_between_its_moves(spark, tmp_dir, monkeypatch):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    path = f"{tmp_dir}/t"
    files.truncate_load(df, path, df.schema)
    real = files.move

    def stop(spark_, source, target):
        if target == path:
            raise Stop
        real(spark_, source, target)

    monkeypatch.setattr(files, "move", stop)
    with pytest.raises(Stop):
        files.truncate_load(df.where("k = 2"), path, df.schema)
    monkeypatch.undo()
    files.recover_load(spark, path)
    assert [r.k for r in spark.read.parquet(path).collect()] == [2]


# ---- commit numbers --------------------------------------------------------------

@pytest.mark.parametrize("layout", ["month", "ticker"])
def test_runs_in_any_order_of_stamps_reach_the_fact(spark, tmp_dir, layout):
    paths = P.Paths(f"{tmp_dir}/w")
    stamps = [dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 4), dt.datetime(2024, 1, 4), dt.datetime(2023, 1, 1)]
    rows = [(dt.date(2023, 1 + k, 3), f"T{k}", 10.0 + k, "1") for k in range(4)]
    for k, stamp in enumerate(stamps):
        run = P.Run(f"r{k}", stamp, silver_layout=layout, changed_only=layout == "month")
        if layout == "month":
            steps(spark, paths, rows[:k + 1], run)
        else:
            files.append_idempotent(raw_rows(spark, rows[:k + 1]), paths.raw)
            P.build_silver(spark, paths, run)
            P.build_gold(spark, paths, run)
        assert tables.read_table(spark, paths.fact).count() == k + 1
    if layout == "month":       # each run wrote its own month's rows only
        assert [r["created_at"] for r in tables.read_table(spark, paths.fact).orderBy("date_key").collect()] == stamps


def test_a_clean_build_whose_gold_step_failed_is_read_later(spark, tmp_dir):
    paths = P.Paths(f"{tmp_dir}/w")
    one, two = ([(dt.date(2023, m, 3), "A", 10.0 + m, "1")] for m in (1, 5))
    files.append_idempotent(raw_rows(spark, one), paths.raw)
    P.build_silver(spark, paths, P.Run("a", dt.datetime(2024, 1, 1), silver_layout="month"))
    P.build_gold(spark, paths, P.Run("a", dt.datetime(2024, 1, 1), silver_layout="month"))
    for m in (2, 3):
        files.append_idempotent(raw_rows(spark, [(dt.date(2023, m, 3), "A", 20.0 + m, "1")]), paths.raw)
        P.build_silver(spark, paths, P.Run("b", dt.datetime(2024, 1, 2), silver_layout="month", since=f"2023-0{m}-01"))
    files.append_idempotent(raw_rows(spark, two), paths.raw)
    run = P.Run("c", dt.datetime(2024, 1, 3), silver_layout="month", since="2023-05-01")
    P.build_silver(spark, paths, run)
    P.build_gold(spark, paths, run)
    assert [r["date_key"] for r in tables.read_table(spark, paths.fact).orderBy("date_key").collect()] == \
        [20230103, 20230203, 20230303, 20230503]


# ---- mended months ------------------------------------------------------------------

def whole(rows):
    rows = quality.dedup_latest(quality.clean_rows(rows), tiebreak=None)
    w = Window.partitionBy("ticker").orderBy("date")
    out = rows.withColumn("prev", F.lag("close").over(w))
    return sorted(map(tuple, out.select("ticker", "date", "close", enrich.daily_return("close", "prev").alias("r")).collect()))


def test_changed_months_equal_a_full_build(spark, tmp_dir):
    rng = random.Random(5)
    every, known = [], {}
    silver, state = f"{tmp_dir}/silver", f"{tmp_dir}/state"
    months_of = lambda rows: sorted({d.year * 100 + d.month for d, *_ in rows})
    for k in range(5):
        batch = [(dt.date(2023, rng.randint(1, 8), rng.randint(1, 28)), rng.choice("ABC"), float(rng.randint(5, 40)), str(k))
                 for _ in range(6 if k else 25)]
        if k == 3:          # all of a ticker's rows of a month go: the stored rows are cut, not added to
            gone = next((t, d.month) for d, t, *_ in every)
            every = [r for r in every if (r[1], r[0].month) != gone]
            batch = [(dt.date(2023, gone[1], 2), "D", 9.0, str(k))]
            batch_months = [2023 * 100 + gone[1]]
        else:
            batch_months = months_of(batch)
        every += batch
        built = months.build_months(raw_rows(spark, every), silver, state, f"run {k}", months=batch_months)
        got = months.read_months(spark, silver)
        assert sorted(map(tuple, got.select("ticker", "date", "close", "daily_return").collect())) == whole(raw_rows(spark, every))
        assert set(built["months"]) <= set(batch_months) and not set(built["repaired"]) & set(batch_months)
        stamps = {(r["ticker"], r["date"]): r["processed_at"] for r in got.collect()}
        changed = {d.year * 100 + d.month for (_, d), s in stamps.items() if s == f"run {k}"}
        assert changed <= set(built["months"]) | set(built["repaired"])
        # Outside the touched months at most one row a ticker and touched month carries the run's stamp.
        follow = [t for (t, d), s in stamps.items() if s == f"run {k}" and d.year * 100 + d.month not in batch_months]
        assert len(follow) <= len(batch_months) * 4 and all(follow.count(t) <= len(batch_months) for t in follow)
        known = stamps
    assert known


def test_a_late_row_rewrites_its_month_and_the_next_one(spark, tmp_dir):
    silver, state = f"{tmp_dir}/silver", f"{tmp_dir}/state"
    rows = [(dt.date(2023, m, d), t, 10.0 + m, "1") for m in (1, 2, 4, 6, 9) for d in (3, 20) for t in "AB"]
    months.build_months(raw_rows(spark, rows), silver, state, "one")
    late = rows + [(dt.date(2023, 2, 25), "A", 50.0, "2")]
    built = months.build_months(raw_rows(spark, late), silver, state, "two", months=[202302])
    assert (built["months"], built["repaired"]) == ([202302], [202304])
    got = months.read_months(spark, silver)
    assert {(r["ticker"], r["date"]) for r in got.where("processed_at = 'two' AND month(date) <> 2").collect()} == {("A", dt.date(2023, 4, 3))}
    same = months.build_months(raw_rows(spark, late), silver, state, "three", months=[202302])
    assert same["repaired"] == []       # the closes are as they were


def test_window_and_month_summary_share_the_dedup_shuffle(spark):
    rows = spark.createDataFrame([(dt.date(2023, 1 + k % 3, 1 + k), 10.0 + k, 12.0 + k, 9.0, 11.0 + k, 11.0, 5, "AB", "t", k) for k in range(9)],
                                 "date date, open double, high double, low double, close double, adj_close double, volume long, "
                                 "ticker string, ingested_at string, src_id long").repartition(3)
    df = enrich.with_prev_close(months.accepted(rows, tiebreak=["src_id"]), tiebreak=["src_id"])
    days = sorted((r["date"], r["close"], r["prev_close"]) for r in df.collect())
    assert [p for _, _, p in days] == [None, *[c for _, c, _ in days[:-1]]]
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_previous_close_from_months_outside_the_frame(spark):
    columns = "ticker string, date date, close double"
    rows = spark.createDataFrame([("AB", dt.date(2023, 2, 3), 3.0), ("AB", dt.date(2023, 2, 9), 4.0), ("AB", dt.date(2023, 5, 1), 7.0),
                                  ("CD", dt.date(2023, 2, 1), 8.0)], columns)
    before = spark.createDataFrame([("AB", dt.date(2023, 1, 30), 2.0), ("AB", dt.date(2023, 4, 30), 6.0), ("EF", dt.date(2023, 1, 1), 1.0)], columns)
    got = enrich.with_prev_close(rows, earlier=before).collect()
    assert sorted((r["ticker"], r["close"], r["prev_close"]) for r in got if r["ticker"] == "AB") == [("AB", 3.0, 2.0), ("AB", 4.0, 3.0), ("AB", 7.0, 6.0)]
    assert [r["prev_close"] for r in got if r["ticker"] == "CD"] == [None] and len(got) == 4
