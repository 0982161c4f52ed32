"""Month-partitioned clean table, rebuilt incrementally (W1 under incremental input).

The clean table is partitioned by ``month_key`` (yyyyMM); beside it a small state table holds
the last accepted row per (ticker, month).  A run rebuilds either all months from a start date
on, or only named months whose raw rows have changed.  The raw rows of just those months are
read (partition-pruned), and the state seeds each ticker's first previous close.

A changed month also changes one row that lies outside it: the first row of the ticker's next
non-empty month, whose return starts from the changed close.  For named months these rows are
found in the state table alone (a ticker's months in order, before and after the change) and
mended in their own month folders; all other months stay unread.

Rebuilt and mended folders of both tables are staged and take effect in one commit of a redo
journal, so clean table and state can't disagree whatever a run is stopped at.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tickvault.operators import enrich, quality
from tickvault.sinks.files import has_data_files, list_folders, path_exists
from tickvault.sinks.journal import Commit, Journal

COMMIT_COL = "commit_no"
MONTH_KEY = "month_key"


def month_key(date_col: str = "date"):
    return (F.year(date_col) * 100 + F.month(date_col)).cast("int")


def month_start(ds: str) -> dt.date:
    d = dt.date.fromisoformat(ds)
    return d.replace(day=1)


def seeds_before(state: DataFrame, start_key: int, key: str, order: Sequence[str],
                 value: str) -> DataFrame:
    """Last accepted row per ticker in months before ``start_key`` (one row per
    ticker, read from the per-month state table)."""
    cols = [*order, value]
    return (state.where(F.col(MONTH_KEY) < start_key)
                 .groupBy(key)
                 .agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_s"))
                 .select(key, *[F.col(f"_s.{c}").alias(c) for c in cols]))


def journal(spark: SparkSession, silver_root: str) -> Journal:
    """The journal of a clean table that belongs to no warehouse."""
    return Journal(spark, f"{silver_root.rstrip('/')}.journal")


def read_months(spark: SparkSession, silver_root: str) -> DataFrame:
    """The clean table, after any commit that was stopped half-way is finished."""
    journal(spark, silver_root).recover()
    return spark.read.parquet(silver_root).drop(MONTH_KEY)


def successors(before: DataFrame, after: DataFrame, touched: Sequence[int], key: str = "ticker",
               value: str = "close") -> DataFrame:
    """(key, month, previous close) of the months whose first row follows a changed month.

    ``before`` and ``after``: the state rows of all months, and of the touched ones anew.  Both
    have one row per key and month, so a key's window holds its months, not its rows.
    """
    in_touched = F.col(MONTH_KEY).isin(list(touched))
    old = before.select(key, MONTH_KEY, F.col(value).alias("_old"))
    new = after.select(key, MONTH_KEY, F.col(value).alias("_new"))
    whole = old.where(in_touched).join(new, [key, MONTH_KEY], "full") \
        .select(key, MONTH_KEY, "_new", (~F.col("_old").eqNullSafe(F.col("_new"))).alias("_changed"), F.lit(True).alias("_touched")) \
        .unionAll(old.where(~in_touched).select(key, MONTH_KEY, F.col("_old").alias("_new"), F.lit(False), F.lit(False)))
    order = Window.partitionBy(key).orderBy(MONTH_KEY)
    return whole.withColumns({
        "_after_change": F.lag("_changed").over(order),
        "_prev": F.last("_new", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))}) \
        .where(~F.col("_touched") & F.col("_after_change")).select(key, MONTH_KEY, "_prev")


def mended(stored: DataFrame, follow: DataFrame, processed_at: str, order: Sequence[str], key: str = "ticker",
           commit_no: int | None = None) -> DataFrame:
    """``stored`` months with the return of each followed month's first row computed anew."""
    first = stored.join(follow, [key, MONTH_KEY]).groupBy(key, MONTH_KEY) \
        .agg(F.min(F.struct(*order)).alias("_first"), F.first("_prev").alias("_prev"))
    rows = stored.join(first, [key, MONTH_KEY], "left")
    here = F.coalesce(F.struct(*order) == F.col("_first"), F.lit(False))
    new = {"daily_return": enrich.daily_return("close", "_prev"), "processed_at": F.lit(processed_at)}
    if commit_no is not None:
        new[COMMIT_COL] = F.lit(commit_no).cast("long")
    return rows.withColumns({c: F.when(here, v).otherwise(F.col(c)) for c, v in new.items()}).select(*stored.columns)


def accepted(raw: DataFrame, key: str = "ticker", date_col: str = "date", tiebreak: Sequence[str] = (),
             dedup: bool = True) -> DataFrame:
    """Rows that no rule fires on, one for each key and date with ``dedup``."""
    clean = quality.clean_rows(raw)
    if (key, date_col) == ("ticker", "date"):
        # The rules leave no NULL there.  Said as a filter, which the join with the month summary
        # would add to the summary's side only, both sides are one plan and share a shuffle.
        clean = clean.where(F.col(key).isNotNull() & enrich.month_bucket(date_col).isNotNull())
    return quality.dedup_latest(clean, tiebreak=tiebreak[0] if tiebreak else None) if dedup else clean


def build_months(raw: DataFrame, silver_root: str, state_root: str, processed_at: str,
                 since: str | None = None, key: str = "ticker", date_col: str = "date",
                 tiebreak: Sequence[str] = (), dedup: bool = True, row_id: str | None = None,
                 prepare: Callable[[DataFrame], DataFrame] | None = None,
                 months: Sequence[int] | None = None, commit: Commit | None = None) -> dict:
    """Rebuild the clean table for the months from ``since`` on, for the named ``months`` (and
    mend the rows that follow them), or for all months.

    ``raw`` should be a scan of the raw layer; the date bound reaches it as a pushed / partition
    filter.  Rows without a date fail the rules, so they are the quarantine's.  A month of the
    rebuilt range that has no rows any more is removed.  With ``commit`` the folders join that
    unit of work, which its owner ends, and rows carry its number; otherwise they are committed
    here.  Returns the number of clean-table rows written, the months, and the months mended."""
    if since is not None and months is not None:
        raise ValueError("give since or months, not both")
    spark = raw.sparkSession
    own = commit or journal(spark, silver_root).begin()
    number = commit.number if commit else None
    order = [date_col, *tiebreak]
    start = month_start(since) if since else None
    chosen = None if months is None else sorted({int(m) for m in months})
    first = start.year * 100 + start.month if start is not None else 0

    def in_range(month):
        return month.isin(chosen) if chosen is not None else month >= first

    if start is not None:
        raw = raw.where(F.col(date_col) >= F.lit(start))
    if chosen is not None:
        raw = raw.where(in_range(month_key(date_col)))
    if (start is not None or chosen is not None) and "year" in raw.columns and "month" in raw.columns:
        raw = raw.where(in_range(F.col("year") * 100 + F.col("month")))
    # The raw layout's folder columns are derivable from the date.
    raw = raw.drop("year", "month", "day")
    clean = accepted(raw, key, date_col, tiebreak, dedup)
    if row_id:
        clean = clean.drop(row_id)
    rows = prepare(clean) if prepare else clean
    seeds = None
    state = spark.read.parquet(state_root) if has_data_files(spark, state_root) else None
    if state is not None and (start is not None or chosen):
        seeds = (seeds_before(state, first, key, order, "close") if chosen is None else
                 state.where(~in_range(F.col(MONTH_KEY)) & (F.col(MONTH_KEY) < chosen[-1])).select(key, *order, "close"))
    with_prev = enrich.with_prev_close(rows, key, date_col, tiebreak, earlier=seeds)
    out = with_prev.withColumn("daily_return", enrich.daily_return("close", "prev_close")).drop("prev_close")
    out = enrich.with_price_range(out).withColumns(
        {"processed_at": F.lit(processed_at), "layer": F.lit("silver"), MONTH_KEY: month_key(date_col)})
    if number is not None:
        out = out.withColumn(COMMIT_COL, F.lit(number).cast("long"))
    # Observed in the writing stage (result tasks), so the count is exact even
    # when lost executors make Spark re-run earlier stages.
    written = Observation("months_written")
    out.observe(written, F.count(F.lit(1)).alias("silver_rows"),
                F.collect_set(MONTH_KEY).alias("months")) \
        .write.partitionBy(MONTH_KEY).parquet(own.folder("silver"))     # months: one value each
    built = sorted(written.get.get("months") or [])
    # Per (ticker, month): the last accepted row, for seeding later runs.
    if built:
        cols = [*order, "close"]
        (spark.read.parquet(own.folder("silver")).groupBy(key, MONTH_KEY)
              .agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_s"))
              .select(key, MONTH_KEY, *[F.col(f"_s.{c}").alias(c) for c in cols])
              .write.partitionBy(MONTH_KEY).parquet(own.folder("state")))
    repaired = []
    # Months of the state that could follow a changed one.
    known = [int(v) for v in (f.partition(f"{MONTH_KEY}=")[2] for f in list_folders(spark, state_root)) if v.isdigit()]
    if chosen and any(m > chosen[0] and m not in chosen for m in known):
        new_state = spark.read.parquet(own.folder("state")) if built else state.limit(0)
        seen = Observation("months_to_mend")
        successors(state, new_state, chosen, key).observe(seen, F.collect_set(MONTH_KEY).alias("months")) \
            .write.parquet(own.folder("follow"))
        repaired = sorted(seen.get.get("months") or [])
        if repaired:
            stored = spark.read.parquet(silver_root).where(F.col(MONTH_KEY).isin(repaired))
            mended(stored, spark.read.parquet(own.folder("follow")), processed_at, order, key, number) \
                .write.partitionBy(MONTH_KEY).parquet(own.folder("mended"))
            own.replace_parts(own.folder("mended"), silver_root)
    for name, root in (("silver", silver_root), ("state", state_root)):
        if path_exists(spark, own.folder(name)):
            own.replace_parts(own.folder(name), root)
        for folder in list_folders(spark, root):
            value = folder.partition(f"{MONTH_KEY}=")[2]
            gone = value.isdigit() and int(value) not in built and (
                int(value) in chosen if chosen is not None else int(value) >= first)
            if gone:
                own.remove(f"{root.rstrip('/')}/{folder}")
    if commit is None:
        own.done()
    return {"silver_rows": written.get.get("silver_rows") or 0, "months": built, "repaired": repaired}


__all__ = ["COMMIT_COL", "MONTH_KEY", "accepted", "build_months", "journal", "mended", "month_key", "month_start", "read_months",
           "seeds_before", "successors"]
