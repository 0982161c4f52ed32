"""The layered pipeline as plain functions: raw -> clean -> gold -> tests -> audit.

Each step is a few Spark jobs over lazy plans; metrics come from
``Observation``s attached to the writes instead of extra ``count()`` actions.
Run timestamps are parameters, so a re-run with the same inputs repeats.

A step's tables take effect together, in one commit of the warehouse's redo
journal: clean table, month state and quarantine; the export; dimensions and
fact.  A run stopped anywhere is finished or undone by the next one, which
finds either all of a step or nothing.  The journal also holds what the steps
know of each other: which months have raw rows that no clean build has read,
the number of the clean table's last commit, and that up to which the fact has
read it.  Rows carry the number of the commit that wrote them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickvault.functions.naming import run_stamp
from tickvault.operators import checks, dims, enrich, fact, incremental, months, quality, reshape
from tickvault.operators.lookup import lookup_metadata
from tickvault.schemas import AUDIT_SCHEMA, FACT_SCHEMA, RAW_SCHEMA, SILVER_SCHEMA, enforce_schema
from tickvault.sinks import files, tables
from tickvault.sinks.journal import Commit, Journal
from tickvault.sources import landing
from tickvault.sources.reference import DEFAULT_TICKERS, ticker_metadata


@dataclass
class Paths:
    """Table locations under one warehouse root (a shared file system)."""
    root: str

    def __getattr__(self, name: str) -> str:
        layout = {"raw": "raw/stock_prices", "silver": "silver/stock_prices",
                  "rejected": "rejected/stock_prices", "dim_date": "gold/dim_date",
                  "dim_ticker": "gold/dim_ticker", "fact": "gold/fact_stock_prices",
                  "silver_state": "state/silver_last_close", "test_results": "state/test_results",
                  "audit": "gold/pipeline_audit_log", "export": "export/silver_stock_prices"}
        if name in layout:
            return f"{self.root.rstrip('/')}/{layout[name]}"
        raise AttributeError(name)


@dataclass
class Run:
    """One run.  ``silver_layout="ticker"`` rebuilds the clean table from the
    whole history (folders per ticker), or only the
    folders of ``tickers``; ``"month"`` keeps it in month folders and rebuilds
    only the months from ``since`` on, or with ``changed_only`` just the months
    that have raw rows no clean build has read (and the rows whose return they
    change), seeding returns from the per-month state.  ``dedup`` leaves one row per ticker and day (the fact is keyed by
    them); without it, rows are ordered by their place in the raw files.
    ``ticker_versions`` rebuilds the ticker dimension with a row for every
    version of a ticker's attributes instead of the latest one."""
    run_id: str
    run_ts: dt.datetime
    raw_layout: str = "monthly"
    dedup: bool = True
    silver_layout: str = "ticker"
    since: str | None = None
    changed_only: bool = False
    tickers: Sequence[str] | None = None
    ticker_versions: bool = False
    metrics: dict = field(default_factory=dict)

    @property
    def iso(self) -> str:
        return self.run_ts.isoformat()

    @property
    def label(self) -> str:
        return self.run_ts.strftime("%Y%m%d_%H%M%S")


def ingest_raw(spark: SparkSession, download: DataFrame, paths: Paths, run: Run,
               tickers: Sequence[str] | None = None, meta: DataFrame | None = None,
               source: str = "yahoo_finance") -> list[str]:
    """Download frame -> long rows with lineage and metadata -> idempotent append.

    Returns the requested tickers that produced no rows (J7)."""
    tickers = list(tickers or DEFAULT_TICKERS)
    rows = reshape.to_raw_rows(download, run.iso, source, tickers=tickers)
    rows = lookup_metadata(rows, meta if meta is not None else ticker_metadata(spark))
    # Tickers that produced rows, observed during the write (a set bounded by
    # the requested list), instead of recomputing the batch afterwards.
    seen = Observation("ingested_tickers")
    rows = enforce_schema(rows, RAW_SCHEMA, keep_extra=False)
    ingest_rows(spark, rows.observe(seen, F.collect_set("ticker").alias("tickers")), paths, run)
    ingested = set(seen.get["tickers"] or [])
    failed = [t for t in tickers if t not in ingested]
    run.metrics["failed_tickers"] = failed
    return failed


def ingest_rows(spark: SparkSession, rows: DataFrame, paths: Paths, run: Run) -> None:
    """Idempotent append of rows that have the raw table's columns."""
    log = journal(spark, paths)
    log.recover()
    known = log.marks().get("pending_months", [])

    def announce(found: list) -> None:
        log.note(pending_months=known + [m for m in found if m not in known])

    # The batch's months are noted before the append, so that a run that stops after it leaves
    # them to the next build; then narrowed down to those that got rows.
    by_month = run.silver_layout == "month"
    obs = files.append_idempotent(rows, paths.raw, run.raw_layout, announce=announce if by_month else None)
    if by_month:
        announce(sorted(obs.get["months"]) + [None] * bool(obs.get["undated"]))
    run.metrics["raw_rows_written"] = obs.get["rows_written"]


_ROW_ID = "_row_id"


def journal(spark: SparkSession, paths: Paths) -> Journal:
    return Journal(spark, paths.root)


def build_silver(spark: SparkSession, paths: Paths, run: Run,
                 tickers: Sequence[str] | None = None) -> None:
    """Raw -> rules -> clean -> dedup -> daily return -> clean table; rejected
    and duplicate rows to quarantine.  Two write jobs, one commit.

    Without a ticker restriction the table is replaced whole, so a ticker
    whose rows no longer pass goes.  The quality counts (total, clean,
    rejected, per rule) are observed in the quarantine write, whose single
    stage scans, flags and writes: observations in a writing stage count each
    row once even when tasks are retried.  A run whose counts don't add up
    fails, and nothing of it takes effect."""
    tickers = tickers or run.tickers
    commit = journal(spark, paths).begin()
    raw = landing.read_raw(spark, paths.raw, run.raw_layout, RAW_SCHEMA, row_id=_ROW_ID)
    if run.silver_layout == "month":
        if not run.dedup:
            raise ValueError("the month layout keeps one row per ticker and day: it needs dedup")
        if run.changed_only and run.since is not None:
            raise ValueError("give since or changed_only, not both")
        pending = commit.marks.get("pending_months", [])
        chosen = sorted(m for m in pending if m is not None) if run.changed_only else None
        built = months.build_months(raw, paths.silver, paths.silver_state, run.iso, since=run.since,
                                    row_id=_ROW_ID, months=chosen, commit=commit)
        run.metrics.update(built)
        # The same range as the rebuild, and the rows without a date, which no month holds.
        if run.since is not None:
            start = months.month_start(run.since)
            raw = landing.since_with_undated(raw, start)
            commit.marks["pending_months"] = [m for m in pending if m is not None and m < start.year * 100 + start.month]
        elif chosen is not None:
            raw = landing.months_with_undated(raw, chosen)
            commit.marks["pending_months"] = []
        else:
            commit.marks["pending_months"] = []
        unread = set(commit.marks.get("unread_months", [])) | set(built["months"]) | set(built["repaired"])
        commit.marks["unread_months"] = sorted(unread)
        commit.marks["untested_months"] = sorted(unread | set(commit.marks.get("untested_months", [])) | set(chosen or []))
        raw = raw.select(*RAW_SCHEMA.fieldNames(), _ROW_ID)
    else:
        raw = raw.select(*RAW_SCHEMA.fieldNames(), _ROW_ID)
        if tickers:
            raw = landing.scan_range(raw, tickers=tickers)
        clean = quality.clean_rows(raw)
        rows = quality.dedup_latest(clean, tiebreak=None) if run.dedup else clean
        silver = enrich.enrich_silver(rows, run.iso, tiebreak=[] if run.dedup else [_ROW_ID]).drop(_ROW_ID) \
            .withColumn(months.COMMIT_COL, F.lit(commit.number).cast("long"))
        written = files.overwrite_partitions(silver, commit.folder("silver"), ["ticker"], dynamic=False)
        run.metrics["silver_rows"] = written.get["written"]
        if tickers:
            commit.replace_parts(commit.folder("silver"), paths.silver)
        else:
            commit.replace(commit.folder("silver"), paths.silver)
    _quarantine(raw, paths, run, commit)
    commit.marks["silver"] = commit.number
    commit.done()


class UnbalancedRun(RuntimeError):
    pass


def _quarantine(raw: DataFrame, paths: Paths, run: Run, commit: Commit) -> None:
    """Rows that a rule rejects and rows that dedup removed, with the reason.

    A row is named by its place in the raw files, so the clean build and this
    scan mean the same rows."""
    flagged, obs = quality.observe_metrics(quality.flag(raw), "silver_quality")
    rejected = flagged.where(F.col(quality.REASON).isNotNull()).drop(_ROW_ID)
    if run.dedup:
        clean = quality.clean_rows(raw)
        duplicates = quality.duplicate_rows(clean, quality.dedup_latest(clean, tiebreak=None), _ROW_ID).drop(_ROW_ID)
        dup_obs = Observation("duplicates")
        rejected = rejected.unionByName(
            duplicates.observe(dup_obs, F.count(F.lit(1)).alias("duplicate_rows")))
    run.metrics["quarantined"] = files.write_quarantine(rejected, commit.folder("rejected"), run.label)
    if run.metrics["quarantined"]:
        commit.replace_parts(commit.folder("rejected"), paths.rejected)
    else:
        commit.remove(f"{paths.rejected}/run_ts={run.label}")
    run.metrics.update(obs.get)
    run.metrics["duplicate_rows"] = dup_obs.get["duplicate_rows"] if run.dedup else 0
    _balance(run)


def _balance(run: Run) -> None:
    # Every input row lands in exactly one set (A1): clean table or quarantine.
    m = run.metrics
    m["balanced"] = (m["clean_rows"] + m["rejected_rows"] == m["total_rows"]
                     and m["silver_rows"] + m["duplicate_rows"] == m["clean_rows"]
                     and m["quarantined"] == m["rejected_rows"] + m["duplicate_rows"])
    if not m["balanced"]:
        raise UnbalancedRun(f"run {run.run_id}: {m}")


def load_export(spark: SparkSession, paths: Paths) -> None:
    """Replace the export table by the clean table; an empty one is refused."""
    commit = journal(spark, paths).begin()
    files.truncate_load(read_silver(spark, paths), paths.export, SILVER_SCHEMA, commit=commit)
    commit.done()


def read_silver(spark: SparkSession, paths: Paths) -> DataFrame:
    journal(spark, paths).recover()
    return spark.read.parquet(paths.silver)


class LostDimension(RuntimeError):
    pass


def build_gold(spark: SparkSession, paths: Paths, run: Run) -> None:
    """dim_date (full refresh), dim_ticker (type 1 with stable keys, or versions), fact
    (incremental upsert).

    Dimension sizes are known without extra jobs (the calendar's day count,
    the ticker dimension's count observed while it is written), so the star
    join decides its broadcasts without counting."""
    ts = F.lit(run.run_ts)
    commit = journal(spark, paths).begin()
    staged = {name: commit.folder(name) for name in ("dim_date", "dim_ticker")}
    dims.dim_date(spark).write.parquet(staged["dim_date"])
    run.metrics["dim_date_rows"] = dims.dim_date_rows()
    target = tables.read_table(spark, paths.fact)
    silver = read_silver(spark, paths)
    changed = incremental.committed_after(silver, commit.marks.get("fact") if target is not None else None)
    if run.silver_layout == "month":
        if target is not None and "fact" in commit.marks:
            # Months rebuilt since the fact last read: the other folders hold no newer commit.
            changed = changed.where(F.col(months.MONTH_KEY).isin(commit.marks.get("unread_months", [])))
        changed, silver = changed.drop(months.MONTH_KEY), silver.drop(months.MONTH_KEY)
    if run.ticker_versions:
        new_dim = dims.dim_ticker(silver, ts)
    else:
        existing = (spark.read.parquet(paths.dim_ticker)
                    if files.has_data_files(spark, paths.dim_ticker) else None)
        if existing is None and target is not None:
            # Numbering from scratch would give the fact's keys to other tickers.
            raise LostDimension(f"{paths.fact} has rows, but {paths.dim_ticker} is missing")
        new_dim = dims.dim_ticker_type1(changed if existing is not None else silver, existing, ts)
    dim_obs = Observation("dim_ticker")
    new_dim.observe(dim_obs, F.count(F.lit(1)).alias("n")).write.parquet(staged["dim_ticker"])
    run.metrics["dim_ticker_rows"] = dim_obs.get["n"]
    rows = fact.fact_prices(changed, *[spark.read.parquet(p) for p in staged.values()], ts, _dim_rows(run))
    tables.upsert_table(rows, paths.fact, fact.FACT_KEYS, commit=commit)
    for name, folder in staged.items():
        commit.replace(folder, getattr(paths, name))
    commit.marks.update(fact=commit.marks.get("silver"), unread_months=[])
    commit.done()


def _dim_rows(run: Run) -> dict[str, int]:
    m = run.metrics
    return {k: m[f"{k}_rows"] for k in ("dim_date", "dim_ticker") if f"{k}_rows" in m}


def register_views(spark: SparkSession, paths: Paths) -> None:
    """Temporary views over the stored layers, for SQL queries."""
    journal(spark, paths).recover()
    views = {"silver_stock_prices": paths.silver, "dim_date": paths.dim_date,
             "dim_ticker": paths.dim_ticker, "fact_stock_prices": paths.fact,
             "pipeline_audit_log": paths.audit}
    landing.register_views(spark, {k: v for k, v in views.items() if files.path_exists(spark, v)})


def run_data_tests(spark: SparkSession, paths: Paths, run: Run | None = None) -> DataFrame:
    journal(spark, paths).recover()
    gold = {"dim_date": spark.read.parquet(paths.dim_date),
            "dim_ticker": spark.read.parquet(paths.dim_ticker),
            "fact_stock_prices": (tables.read_table(spark, paths.fact)
                                  or spark.createDataFrame([], FACT_SCHEMA)),
            "silver_stock_prices": read_silver(spark, paths)}
    return checks.run_suite(gold, checks.GOLD_TESTS, _dim_rows(run) if run else None)


def run_changed_tests(spark: SparkSession, paths: Paths, run: Run) -> DataFrame:
    """The same verdicts as ``run_data_tests`` in the month layout, from the months that changed.

    Failures per (table, month) are stored.  Only months of commits after the last test run are
    read; the fact's and the clean table's verdicts are sums over all months.  The dimensions are
    small and tested whole.  If one has lost keys, every month is tested anew."""
    log = journal(spark, paths)
    commit = log.begin()
    target = tables.read_table(spark, paths.fact, partition_col=None)
    stored = {"dim_date": spark.read.parquet(paths.dim_date), "dim_ticker": spark.read.parquet(paths.dim_ticker),
              "silver_stock_prices": spark.read.parquet(paths.silver)}
    if target is not None:
        stored["fact_stock_prices"] = target
    sizes = {k: stored[k].count() for k in ("dim_date", "dim_ticker")}
    before = commit.marks.get("tested", {})
    whole = not before or any(sizes[k] < before["sizes"][k] for k in sizes)
    changed = None if whole else commit.marks.get("untested_months", [])
    run.metrics["months_tested"] = changed
    for name in ("fact_stock_prices", "silver_stock_prices"):
        df = stored.get(name)
        tests = [t for t in checks.GOLD_TESTS if t.table == name and checks.is_additive(t)]
        if df is None:
            continue
        if changed is not None:
            df = df.where(F.col(months.MONTH_KEY).isin(changed))
        part = checks.folder_results(df, tests, stored, months.MONTH_KEY, sizes)
        part.write.partitionBy(months.MONTH_KEY).parquet(commit.folder(f"tests/{name}"))
        written = commit.replace_parts(commit.folder(f"tests/{name}"), f"{paths.test_results}/table_name={name}")
        present = {f"{months.MONTH_KEY}={m}" for m in changed} if changed is not None else set(files.list_folders(
            spark, f"{paths.test_results}/table_name={name}"))
        for folder in present - set(written):       # a month that has gone
            commit.remove(f"{paths.test_results}/table_name={name}/{folder}")
    commit.marks.update(tested={"sizes": sizes}, untested_months=[])
    commit.done()
    folded = [t for t in checks.GOLD_TESTS if t.table in ("fact_stock_prices", "silver_stock_prices") and checks.is_additive(t)]
    rest = [t for t in checks.GOLD_TESTS if t not in folded]
    results = spark.read.schema(f"test_name string, failures long, table_name string, {months.MONTH_KEY} int").parquet(paths.test_results)
    return checks.merge_results(results, folded).unionByName(checks.run_suite(stored, rest, sizes))


def write_audit(spark: SparkSession, paths: Paths, run: Run, status: str) -> None:
    row = (run.run_id, "all_layers", run.run_ts.date(), status, run.run_ts)
    files.append_rows(spark.createDataFrame([row], AUDIT_SCHEMA), paths.audit)


class PipelineFailed(RuntimeError):
    pass


def run_pipeline(spark: SparkSession, download: DataFrame, paths: Paths, run: Run,
                 tickers: Sequence[str] | None = None, meta: DataFrame | None = None,
                 strict: bool = False) -> dict:
    """The whole chain; the audit row records the true outcome even on failure.

    ``strict=True`` raises ``PipelineFailed`` (after the audit row is written)
    when the run is not a full success: a requested ticker produced no rows or
    a data test failed."""
    return _run(spark, lambda: ingest_raw(spark, download, paths, run, tickers, meta), paths, run, strict)


def run_landed(spark: SparkSession, rows: DataFrame, paths: Paths, run: Run, strict: bool = False) -> dict:
    """The whole chain for rows that come in the raw table's columns already."""
    return _run(spark, lambda: ingest_rows(spark, rows, paths, run), paths, run, strict)


def _run(spark: SparkSession, ingest: Callable[[], list[str] | None], paths: Paths, run: Run, strict: bool) -> dict:
    status = "failed"
    try:
        failed = ingest()
        build_silver(spark, paths, run)
        load_export(spark, paths)
        build_gold(spark, paths, run)
        tests = run_changed_tests if run.changed_only else run_data_tests
        results = tests(spark, paths, run).collect()  # one row per declared test
        failing = [r["test_name"] for r in results if r["status"] == "fail"]
        run.metrics["failing_tests"] = failing
        status = "failed" if failing else ("partial" if failed else "success")
    finally:
        write_audit(spark, paths, run, status)
    run.metrics["status"] = status
    if strict and status != "success":
        raise PipelineFailed(f"run {run.run_id} ended {status}: failed tickers "
                             f"{run.metrics.get('failed_tickers')}, failing tests "
                             f"{run.metrics.get('failing_tests')}")
    return run.metrics


__all__ = ["Paths", "Run", "PipelineFailed", "ingest_raw", "build_silver", "build_gold", "run_data_tests",
           "write_audit", "run_landed", "run_pipeline", "run_stamp"]
