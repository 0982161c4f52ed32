"""Scans of landed files."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickvault.functions.naming import partition_value_from_path
from tickvault.schemas import RAW_SCHEMA, SchemaChangeError, enforce_schema
from tickvault.sinks.files import LAYOUTS, folder_columns, folder_tasks, has_data_files, raw_read_schema


class NoInputError(RuntimeError):
    pass


def read_raw(spark: SparkSession, root: str, layout: str = "monthly",
             schema: T.StructType = RAW_SCHEMA, nan_to_null: bool = True,
             foreign: bool = False, row_id: str | None = None) -> DataFrame:
    """Partitioned raw dataset with a declared schema: partition columns get
    fixed types and file columns are cast / NaN-cleaned (S2, C2).

    Files written by ``ingest_raw`` already hold the declared types and are
    read with them directly.  ``foreign=True`` is for files from other writers
    (a timestamp ``date``, a DOUBLE ``volume``): their columns are read as
    stored - only the partition columns take declared types, so no value is
    re-inferred - and then cast.  ``nan_to_null=False`` is for data
    normalised on write, to keep pushdown.  ``row_id`` names a column that
    tells stored rows apart: the file's path and the row's place in it, which
    any later scan of the same files gives again."""
    if not has_data_files(spark, root):
        raise NoInputError(f"no input under {root}")
    if foreign:
        stored = spark.read.parquet(root).schema
        parts = set(LAYOUTS[layout])
        schema_read = T.StructType([f for f in stored.fields if f.name not in parts])
    else:
        schema_read = schema
    if layout == "daily":
        in_files = T.StructType([f for f in schema_read.fields if f.name not in LAYOUTS[layout]])
        df = spark.read.option("recursiveFileLookup", "true").schema(in_files).parquet(root).withColumns(folder_columns(layout))
    else:
        df = spark.read.schema(raw_read_schema(schema_read, layout)).parquet(root)
    if row_id:
        df = df.withColumn(row_id, F.concat_ws("#", "_metadata.file_path", F.format_string("%012d", "_metadata.row_index")))
    out = enforce_schema(df, schema, nan_to_null=nan_to_null)
    return out.coalesce(folder_tasks(spark)) if layout == "daily" else out



def read_partition(spark: SparkSession, root: str, partition_filter: str,
                   schema: T.StructType | None = None) -> DataFrame:
    """Only the folder ``root/partition_filter`` (e.g. ``ticker=T07``), keeping the
    partition columns of the path (S3)."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/{partition_filter}")


def scan_range(df: DataFrame, start: str | None = None, end: str | None = None,
               tickers: Sequence[str] | DataFrame | None = None, date_col: str = "date",
               ticker_col: str = "ticker") -> DataFrame:
    """Half-open date window [start, end) and a ticker restriction.

    The date bounds are literals (pushed to the Parquet scan); when a ``year``
    partition column exists its bounds are added too, so whole years are
    pruned.  A ticker list becomes ``IN``; a DataFrame of tickers a semi join,
    broadcast after a size check (so a partitioned ticker column gets dynamic
    partition pruning)."""
    out = df
    has_year, has_month = "year" in df.columns, "month" in df.columns

    def folder(d: dt.date):
        # Partition-column bound: (year, month) when both exist, else year.
        if has_month:
            return F.col("year") * 100 + F.col("month"), d.year * 100 + d.month
        return F.col("year"), d.year

    if start is not None:
        lo = dt.date.fromisoformat(start)
        out = out.where(F.col(date_col) >= F.lit(lo))
        if has_year:
            c, v = folder(lo)
            out = out.where(c >= v)
    if end is not None:
        hi = dt.date.fromisoformat(end)
        out = out.where(F.col(date_col) < F.lit(hi))
        if has_year:
            c, v = folder(hi - dt.timedelta(days=1))
            out = out.where(c <= v)
    if isinstance(tickers, DataFrame):
        from tickvault.operators.lookup import broadcast_if_bounded
        out = out.join(broadcast_if_bounded(tickers.select(ticker_col).distinct()), ticker_col, "left_semi")
    elif tickers is not None:
        out = out.where(F.col(ticker_col).isin(list(tickers)))
    return out


# Fixed value: default start of the history window.
DEFAULT_START = "2020-01-01"


def raw_batch(spark: SparkSession, root: str, tickers: Sequence[str] | None = None,
              start: str = DEFAULT_START, end: str | None = None,
              layout: str = "monthly") -> DataFrame:
    """Raw OHLCV rows for a ticker list and a half-open window [start, end).

    Defaults: the ten default tickers, from 2020-01-01 up to, but excluding,
    today."""
    from tickvault.sources.reference import DEFAULT_TICKERS
    end = end or dt.date.today().isoformat()
    return scan_range(read_raw(spark, root, layout), start, end,
                      list(tickers) if tickers is not None else DEFAULT_TICKERS)


def since_with_undated(df: DataFrame, start: dt.date, date_col: str = "date") -> DataFrame:
    """Rows from ``start`` on and rows without a date, which belong to no month
    but must not escape a run; other months' folders are pruned."""
    out = df.where((F.col(date_col) >= F.lit(start)) | F.col(date_col).isNull())
    if "year" in df.columns and "month" in df.columns:
        out = out.where((F.col("year") * 100 + F.col("month") >= start.year * 100 + start.month) | F.col("year").isNull())
    return out


def months_with_undated(df: DataFrame, months: Sequence[int], date_col: str = "date") -> DataFrame:
    """Rows of the given months (yyyyMM) and rows without a date; other months' folders are pruned."""
    chosen = list(months)
    out = df.where((F.year(date_col) * 100 + F.month(date_col)).isin(chosen) | F.col(date_col).isNull())
    if "year" in df.columns and "month" in df.columns:
        out = out.where((F.col("year") * 100 + F.col("month")).isin(chosen) | F.col("year").isNull())
    return out


def next_day(ds: str) -> str:
    """The day after an ISO date string."""
    return (dt.date.fromisoformat(ds) + dt.timedelta(days=1)).isoformat()


def scan_day(df: DataFrame, ds: str, tickers: Sequence[str] | DataFrame | None = None,
             date_col: str = "date") -> DataFrame:
    """One scheduled day: the half-open window [ds, ds + 1 day)."""
    return scan_range(df, ds, next_day(ds), tickers, date_col)


def read_files_with_path_key(spark: SparkSession, root: str, key: str = "ticker",
                             glob: str = "*.parquet", schema: T.StructType | None = None) -> DataFrame:
    """Every matching file under ``root`` as one table (S4, U1), with ``key``
    taken from the ``key=value`` folder of each file's path, replacing a column
    of that name or adding it (S5).

    Files need not agree.  Their footers are read in Spark tasks and united
    first: a column that only some files hold is NULL in the others, and one
    whose types can't be united is an error.  With a declared ``schema`` files may
    also hold narrower types (they are widened on read) or lack columns, but a
    column that isn't declared, or a type that would have to be cut, is refused."""
    found = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if schema is None:
        df = found.option("mergeSchema", "true").parquet(root)
    else:
        df = found.schema(_checked(found, root, schema, key)).parquet(root)
    from_path = partition_value_from_path(F.col("_metadata.file_path"), key)
    if key in df.columns:
        return df.withColumn(key, F.coalesce(from_path, F.col(key)))
    return df.withColumn(key, from_path)


#: Types that a file may hold for a declared one.
NARROWER = {"bigint": {"int", "smallint", "tinyint"}, "int": {"smallint", "tinyint"}, "double": {"float", "int", "smallint", "tinyint"}}


def _checked(found, root: str, schema: T.StructType, key: str) -> T.StructType:
    """``schema`` after a check against the files' schemas.  Files of unequal types are looked at
    one distinct type at a time: Spark names no more than the first conflict."""
    declared = {f.name: f.dataType.simpleString() for f in schema.fields}
    try:
        kinds = {f.name: {f.dataType.simpleString()} for f in found.option("mergeSchema", "true").parquet(root).schema.fields}
    except Exception as err:        # noqa: BLE001 - only a conflict of types is ours to settle
        if "CANNOT_MERGE" not in str(err):
            raise
        kinds = {f.name: {f.dataType.simpleString()} for f in found.option("mergeSchema", "false").parquet(root).schema.fields}
    bad = [f"new column {n} {min(k)}" for n, k in kinds.items() if n not in declared and n != key]
    bad += [f"type change {n}: {declared[n]} -> {t}" for n, k in kinds.items() if n in declared
            for t in k if t != declared[n] and t not in NARROWER.get(declared[n], ())]
    if bad:
        raise SchemaChangeError(f"files below {root}: " + "; ".join(sorted(bad)))
    return schema


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise when there is nothing to load."""
    if df.isEmpty():
        raise NoInputError(f"no {what} rows found")
    return df


def sample_row(df: DataFrame):
    """One row for a log line, or None (O2); reads at most one row."""
    rows = df.limit(1).collect()
    return rows[0] if rows else None


def register_views(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> None:
    """Named tables for SQL users: one temporary view per stored table."""
    for name, path in tables.items():
        spark.read.format(fmt).load(path).createOrReplaceTempView(name)


__all__ = ["LAYOUTS", "NoInputError", "read_raw", "raw_batch", "read_partition", "scan_range", "scan_day",
           "next_day", "read_files_with_path_key", "require_rows", "sample_row", "register_views"]
