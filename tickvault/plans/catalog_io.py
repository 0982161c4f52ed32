"""Registered queries of clean-layer writes read back: partition overwrite,
quarantine, truncate-and-load."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickvault.functions.naming import run_stamp
from tickvault.operators import quality
from tickvault.plans import oracle as O
from tickvault.plans.catalog import quotes, register, silver, store
from tickvault.plans.catalog_raw import BUCKET_SQL, bucketed_silver
from tickvault.plans.constants import RUN_TS
from tickvault.schemas import SILVER_EXPORT_COLUMNS, SILVER_SCHEMA
from tickvault.session import work_path
from tickvault.sinks import files

STALE_ISO = "2024-01-01T06:00:00"
RUN_LABEL = "20240102_060000"


@register("overwrite_partitions", O.sql(
    f"""SELECT *, {BUCKET_SQL} AS bucket FROM (
        SELECT * REPLACE ('{STALE_ISO}' AS processed_at) FROM silver WHERE {BUCKET_SQL} >= 'B10'
        UNION ALL SELECT * FROM silver WHERE {BUCKET_SQL} < 'B10')""", "silver"))
def q_overwrite_partitions(spark, d):
    """Full write of an older version, then a re-run for some buckets of tickers only:
    their partitions are replaced, every other one is kept."""
    root = work_path(spark, "silver")
    s = store(bucketed_silver(spark, d), "silver")
    files.overwrite_partitions(s.withColumn("processed_at", F.lit(STALE_ISO)), root, ["bucket"])
    files.overwrite_partitions(s.where(F.col("bucket") < "B10"), root, ["bucket"])
    return spark.read.schema(s.schema).parquet(root).select(*s.columns)


@register("overwrite_full", O.sql(f"SELECT *, {BUCKET_SQL} AS bucket FROM silver WHERE {BUCKET_SQL} >= 'B10'", "silver"))
def q_overwrite_full(spark, d):
    """A rebuild of the whole table from which some buckets have gone: their partitions go too."""
    root = work_path(spark, "silver")
    s = store(bucketed_silver(spark, d), "silver")
    files.overwrite_partitions(s, root, ["bucket"])
    files.overwrite_partitions(s.where(F.col("bucket") >= "B10"), root, ["bucket"], dynamic=False)
    return spark.read.schema(s.schema).parquet(root).select(*s.columns)


@register("quarantine_write", O.sql(
    f"SELECT *, '{RUN_LABEL}' AS run_ts FROM flagged WHERE failure_reason IS NOT NULL", "flagged"))
def q_quarantine(spark, d):
    root = work_path(spark, "rejected")
    rejected = quality.rejected_rows(quotes(spark, d))
    label = spark.range(1).select(run_stamp(F.lit(RUN_TS).cast("timestamp"))).first()[0]
    files.write_quarantine(rejected, root, label)
    schema = T.StructType(rejected.schema.fields + [T.StructField("run_ts", T.StringType())])
    return spark.read.schema(schema).parquet(root)


@register("truncate_load", O.sql(
    f"SELECT {', '.join(SILVER_EXPORT_COLUMNS)} FROM "
    "(SELECT * REPLACE (CAST(NULL AS DOUBLE) AS adj_close) FROM silver)", "silver"))
def q_truncate_load(spark, d):
    """Load the clean table into a fixed 17-column table twice (the second
    load replaces the first); extra columns are dropped, a missing one is
    NULL, and a load without rows is refused."""
    path = work_path(spark, "export")
    s = store(silver(spark, d), "silver")
    files.truncate_load(s.where(F.col("src_id") % 2 == 0), path, SILVER_SCHEMA)
    files.truncate_load(s.drop("adj_close"), path, SILVER_SCHEMA)
    try:
        files.truncate_load(s.limit(0), path, SILVER_SCHEMA)
    except files.EmptyLoadError:
        pass
    else:
        raise AssertionError("an empty load was not refused")
    return spark.read.schema(SILVER_SCHEMA).parquet(path)
