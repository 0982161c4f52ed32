"""Incremental raw -> clean -> silver -> fact with Structured Streaming (C4).

``clean_stream`` splits every micro-batch by the rules into clean and rejected rows.

``silver_stream`` keeps the month-partitioned clean table up to date: a
micro-batch's accepted rows are stored, and the months it touches are rebuilt
from all rows stored so far, together with the returns of the rows that follow
them in later months.  So the same (ticker, date) in two files leaves one row, a
late date changes the return of the day after it, and files may arrive in any
order and number.  A late row costs its own month and the ones that follow it for
the batch's tickers, not all months after it.

With a lateness bound, a row older than the newest date of all earlier micro-batches less
the bound is late: it goes to quarantine with that reason.  So what a micro-batch has to
look at, the stored rows of the months it touches, lies within the bound, however long the
stream has run.

``fact_updates`` carries the rebuilt months on into the fact by keyed upsert.

Every output of epoch N goes to ``batch_id=N`` folders in overwrite mode, and
rebuilding a month replaces it: re-running an epoch after a failure gives the
same tables again.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickvault.operators import fact, months, quality
from tickvault.operators.lookup import broadcast_if_bounded
from tickvault.session import work_path
from tickvault.sinks import files, tables
from tickvault.sinks.files import has_data_files


def file_stream(spark: SparkSession, source_dir: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # Only the declared columns: landing folders named key=value would
    # otherwise be added as partition columns.
    return reader.parquet(source_dir).select(*schema.fieldNames())


def clean_stream(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str,
                 checkpoint_dir: str, available_now: bool = True,
                 rejected_dir: str | None = None) -> StreamingQuery:
    """Clean rows of every new raw file to ``sink_dir``, rejected ones with their
    reason to ``rejected_dir`` (default: beside it)."""
    rejected_dir = rejected_dir or f"{sink_dir.rstrip('/')}_rejected"

    def run(batch: DataFrame, batch_id: int) -> None:
        clean, rejected = quality.split(batch)
        clean.write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{rejected_dir}/batch_id={batch_id}")

    writer = (file_stream(spark, source_dir, schema).writeStream.foreachBatch(run)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


LATE = "late"


def newest_before(spark: SparkSession, root: str, batch_id: int) -> dt.date | None:
    """The newest accepted date of all epochs before ``batch_id``."""
    earlier = [n for n in files.list_files(spark, f"{root}/newest") if n.isdigit() and int(n) < batch_id]
    return dt.date.fromisoformat(files.read_text(spark, f"{root}/newest/{max(earlier)}")) if earlier else None


def contested(stored: DataFrame, batch_id: int) -> DataFrame:
    """Rows of the keys that hold several rows, one of them of this epoch.

    Keys are counted first, map-side, and stored: they are few beside the rows, which then needn't
    be shuffled unless the keys outgrow a broadcast."""
    spark = stored.sparkSession
    path = work_path(spark, "contested")
    stored.groupBy("ticker", "date").agg(F.count(F.lit(1)).alias("n"), F.max("batch_id").alias("newest")) \
        .where((F.col("n") > 1) & (F.col("newest") == batch_id)).select("ticker", "date").write.parquet(path)
    keys = spark.read.schema(stored.select("ticker", "date").schema).parquet(path)
    return stored.join(broadcast_if_bounded(keys), ["ticker", "date"], "left_semi")


def silver_batch(root: str, schema: T.StructType, processed_at: str,
                 prepare: Callable[[DataFrame], DataFrame] | None = None,
                 after: Callable[[SparkSession, str, list[int]], None] | None = None,
                 row_id: str = "src_id", lateness_days: int | None = None):
    """The foreachBatch function.  ``row_id`` is a unique number of every raw row;
    ``after(spark, silver_root, rebuilt_months)`` runs once the months are in."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clean, rejected = quality.split(batch)
        mark = newest_before(spark, root, batch_id)
        if lateness_days is not None and mark is not None:
            late = F.col("date") < F.lit(mark - dt.timedelta(days=lateness_days))
            rejected = rejected.unionByName(clean.where(late).withColumn(quality.REASON, F.lit(LATE)))
            clean = clean.where(~late)
        rejected.write.mode("overwrite").parquet(f"{root}/rejected/batch_id={batch_id}")
        accepted = f"{root}/accepted/batch_id={batch_id}"
        seen = Observation("newest")
        (clean.observe(seen, F.max("date").alias("newest")).withColumn(months.MONTH_KEY, months.month_key())
              .write.mode("overwrite").partitionBy(months.MONTH_KEY).parquet(accepted))
        dates = [d for d in (mark, seen.get.get("newest")) if d is not None]
        if dates:       # what later epochs compare with; a repeated epoch writes the same
            files.write_text(spark, f"{root}/newest/{batch_id:012d}", max(dates).isoformat())
        if not has_data_files(spark, accepted):
            return
        new = spark.read.schema(_with(schema, months.MONTH_KEY)).parquet(accepted)
        touched = sorted(r[0] for r in new.select(months.MONTH_KEY).distinct().collect())      # a calendar's months
        stored = (spark.read.schema(_with(schema, "batch_id", months.MONTH_KEY)).parquet(f"{root}/accepted")
                  .where(F.col(months.MONTH_KEY).isin(touched) & (F.col("batch_id") <= batch_id)))
        # Rows that lost against another row of their key, now or to this batch.
        rivals = contested(stored, batch_id)
        stored, rivals = (x.select(*schema.fieldNames()) for x in (stored, rivals))
        losers = quality.duplicate_rows(rivals, quality.dedup_latest(rivals, tiebreak=row_id), row_id)
        if has_data_files(spark, f"{root}/duplicates"):
            earlier = spark.read.schema(_with(schema, "batch_id")).parquet(f"{root}/duplicates") \
                .where(F.col("batch_id") < batch_id).select(row_id)
            losers = losers.join(earlier, row_id, "left_anti")
        losers.write.mode("overwrite").parquet(f"{root}/duplicates/batch_id={batch_id}")
        built = months.build_months(stored, f"{root}/silver", f"{root}/state", processed_at, months=touched,
                                    tiebreak=[row_id], prepare=prepare)
        if after:
            after(spark, f"{root}/silver", sorted({*built["months"], *built["repaired"]}))

    return run


def _with(schema: T.StructType, *partitions: str) -> T.StructType:
    kinds = {months.MONTH_KEY: T.IntegerType(), "batch_id": T.LongType()}
    return T.StructType([*schema.fields, *[T.StructField(p, kinds[p]) for p in partitions]])


def fact_updates(fact_path: str, dim_date: DataFrame, dim_ticker: DataFrame, created_at: Column):
    """``after`` for ``silver_batch``: upsert the rebuilt months into the fact."""

    def run(spark: SparkSession, silver_root: str, rebuilt: list[int]) -> None:
        rows = spark.read.parquet(silver_root).where(F.col(months.MONTH_KEY).isin(rebuilt))
        tables.upsert_table(fact.fact_prices(rows, dim_date, dim_ticker, created_at), fact_path, fact.FACT_KEYS)

    return run


def silver_stream(spark: SparkSession, source_dir: str, schema: T.StructType, root: str,
                  checkpoint_dir: str, processed_at: str,
                  prepare: Callable[[DataFrame], DataFrame] | None = None,
                  after: Callable[[SparkSession, str, list[int]], None] | None = None,
                  max_files_per_trigger: int | None = None, lateness_days: int | None = None) -> StreamingQuery:
    """Clean-table updates over a raw file stream; ``read_silver`` reads the table."""
    stream = file_stream(spark, source_dir, schema, max_files_per_trigger)
    return (stream.writeStream.foreachBatch(silver_batch(root, schema, processed_at, prepare, after, lateness_days=lateness_days))
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return months.read_months(spark, f"{root}/silver")


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All ``batch_id=N`` folders of an output as one table, without the folder column."""
    reader = spark.read if schema is None else spark.read.schema(
        T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())]))
    return reader.parquet(path).drop("batch_id")
