"""Keyed upsert into a partitioned Parquet table."""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.operators.incremental import upsert
from tickvault.schemas import assert_same_schema
from tickvault.sinks.files import (delete_path, has_data_files, list_folders, path_exists,
                                   swap_in, touch)
from tickvault.sinks.journal import Commit


def month_of_date_key(date_key: str = "date_key") -> Column:
    """yyyyMM from a yyyyMMdd integer key: the fact's partition column."""
    return (F.col(date_key) / 100).cast("int")


class DuplicateKeyError(ValueError):
    pass


def _rebuilt(source: DataFrame, target: DataFrame | None, path: str, work: str, keys: Sequence[str],
             partition_col: str, expr: Column) -> str | None:
    """Write the partitions that ``source`` touches anew below ``work``; None without rows."""
    spark = source.sparkSession
    if target is not None:
        assert_same_schema(source.schema, target.drop(partition_col).schema)
    source.withColumn(partition_col, expr).write.parquet(f"{work}/source")
    src = spark.read.parquet(f"{work}/source")
    twice = src.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        delete_path(spark, work)
        raise DuplicateKeyError(f"the source of {path} holds a key twice: {twice[0].asDict()}")
    touched = [r[0] for r in src.select(partition_col).distinct().collect()]
    if not touched:
        return None
    order = [partition_col, *keys]
    merged = src
    if target is not None:
        nulls = F.col(partition_col).isNull() if None in touched else F.lit(False)
        current = target.where(F.col(partition_col).isin([t for t in touched if t is not None]) | nulls)
        merged = upsert(current, src.select(*current.columns), [*keys])
    # A range on (month, keys): a month lies in few tasks, so it gets few
    # files, and a hot month is split by its keys.
    merged.repartitionByRange(*order).write.partitionBy(partition_col).parquet(f"{work}/rebuilt")
    return f"{work}/rebuilt"


def upsert_table(source: DataFrame, path: str, keys: Sequence[str],
                 partition_col: str = "month_key",
                 partition_expr: Column | None = None, commit: Commit | None = None) -> None:
    """Upsert ``source`` into the table at ``path`` by ``keys``.

    The source is stored once.  Then: fail on a schema change (K10) or on a
    key that the source holds twice, rebuild only the partitions it touches -
    the kept target rows of those partitions plus all source rows - and swap
    each rebuilt folder in.  The table is never read and overwritten by the
    same plan.  The touched partition values are a calendar-bounded list.

    Safe to re-run after a failure at any point.  With ``commit`` the rebuilt
    folders join that unit of work, which its owner ends.  Otherwise they lie
    beside the table (``<path>.staging``, the same file system) and are marked
    ready once all are written; ``recover``, which every read and upsert begins
    with, moves the folders of a ready set that are not in place yet, so the
    high-water mark of a table never stands for folders that are missing.
    """
    spark = source.sparkSession
    expr = partition_expr if partition_expr is not None else month_of_date_key()
    target = read_table(spark, path, partition_col=None)
    if commit is not None:
        rebuilt = _rebuilt(source, target, path, commit.folder("upsert"), keys, partition_col, expr)
        if rebuilt:
            commit.replace_parts(rebuilt, path)
        return
    work = f"{path.rstrip('/')}.staging/_upsert-{uuid.uuid4().hex}"
    rebuilt = _rebuilt(source, target, path, work, keys, partition_col, expr)
    if rebuilt:
        ready = f"{path.rstrip('/')}.staging/ready-{uuid.uuid4().hex}"
        swap_in(spark, rebuilt, ready)
        touch(spark, f"{ready}/_READY")
    delete_path(spark, work)
    recover(spark, path)


def recover(spark, path: str) -> None:
    """Move in what a finished rebuild of ``path`` has not moved yet.

    A set without its mark was not complete: it is dropped, and its run, which
    has failed, is to be repeated.  One writer at a time per table."""
    root = f"{path.rstrip('/')}.staging"
    for name in list_folders(spark, root):
        if not name.startswith("ready-"):
            continue
        if path_exists(spark, f"{root}/{name}/_READY"):
            for folder in list_folders(spark, f"{root}/{name}"):
                swap_in(spark, f"{root}/{name}/{folder}", f"{path.rstrip('/')}/{folder}", trash=f"{root}/_trash")
        delete_path(spark, f"{root}/{name}")


def read_table(spark, path: str, partition_col: str | None = "month_key") -> DataFrame | None:
    """The table at ``path`` (without its partition column), or None when there
    is none yet - no folder, or a folder without data files (an empty first
    load).  Any failure to read existing files is raised."""
    recover(spark, path)
    if not has_data_files(spark, path):
        return None
    df = spark.read.parquet(path)
    return df.drop(partition_col) if partition_col and partition_col in df.columns else df
