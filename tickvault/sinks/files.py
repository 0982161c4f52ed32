"""File sinks: idempotent append, partition overwrite, quarantine, table load,
audit append (K1-K8, K11), plus staging/swap helpers for atomic replacement."""

from __future__ import annotations

import uuid
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickvault.functions.naming import partition_value_from_path
from tickvault.session import work_path

# Layouts of the raw table.  "daily" is the one-folder-per-ticker-day layout
# ticker=/year=/month=MM/day=DD; "monthly" keeps ticker and day as columns and
# writes one folder per month, which keeps files large at scale.  Both give the
# same first-write-wins result per (ticker, date).
LAYOUTS = {
    "daily": ["ticker", "year", "month", "day"],
    "monthly": ["year", "month"],
}
PARTITION_TYPES = {"ticker": T.StringType(), "year": T.IntegerType(),
                   "month": T.IntegerType(), "day": T.IntegerType()}


# ---- file-system helpers (Hadoop FileSystem of the session) ---------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory()) if fs.exists(p) else []


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isFile()) if fs.exists(p) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename ``source`` to ``target``, which must not exist."""
    fs, s = _fs(spark, source)
    _, t = _fs(spark, target)
    if not fs.exists(t.getParent()):
        fs.mkdirs(t.getParent())
    if fs.exists(t) or not fs.rename(s, t):
        raise RuntimeError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def has_data_files(spark: SparkSession, path: str) -> bool:
    """Is there a Parquet file anywhere below ``path``?"""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    found = fs.listFiles(p, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def swap_in(spark: SparkSession, staging: str, target: str, trash: str | None = None) -> None:
    """Replace ``target`` by the fully written ``staging`` folder (two renames).

    Both must be on one file system.  The old folder waits in ``trash`` (by
    default beside the target, under a name that readers of the parent skip)
    until the new one is in place."""
    fs, t = _fs(spark, target)
    _, s = _fs(spark, staging)
    parent = t.getParent()
    if not fs.exists(parent):
        fs.mkdirs(parent)
    old = None
    if fs.exists(t):
        _, bin_ = _fs(spark, trash or f"{parent.toString()}/_replaced")
        fs.mkdirs(bin_)
        _, old = _fs(spark, f"{bin_.toString()}/{uuid.uuid4().hex}")
        if not fs.rename(t, old):
            raise RuntimeError(f"could not move {target} away")
    if not fs.rename(s, t):
        if old is not None:
            fs.rename(old, t)
        raise RuntimeError(f"could not move {staging} to {target}")
    if old is not None:
        fs.delete(old, True)


# ---- raw layer ---------------------------------------------------------------------

def with_partition_columns(df: DataFrame, layout: str = "monthly", date_col: str = "date") -> DataFrame:
    """Add year / month (2 digits) / day (2 digits) path columns (K2)."""
    cols = {"year": F.year(date_col),
            "month": F.date_format(date_col, "MM"),
            "day": F.date_format(date_col, "dd")}
    return df.withColumns({c: cols[c] for c in LAYOUTS[layout] if c in cols})


def raw_read_schema(schema: T.StructType, layout: str) -> T.StructType:
    """File schema plus typed partition columns, so discovery infers nothing."""
    names = {f.name for f in schema.fields}
    extra = [T.StructField(c, PARTITION_TYPES[c]) for c in LAYOUTS[layout] if c not in names]
    return T.StructType(schema.fields + extra)


def folder_tasks(spark: SparkSession) -> int:
    """Tasks of a write or scan whose time is that of its folders, a file each, not of its bytes: a given
    number, since AQE would gather such small partitions into a single task, and a scan takes a few files a task."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


# Of a write of tens of thousands of one-row files.  On a local file system each checksum file beside a
# data file is one more file, and both are given their rights by processes of their own, which is most of
# the time.  Parquet pages carry checksums anyway; other file systems don't look at these settings.
_NO_CHECKSUM_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def folder_columns(layout: str) -> dict[str, Column]:
    """The layout's columns from a data file's path, as read with ``recursiveFileLookup``: Spark's own
    discovery of partitions takes the square of the number of folders on the driver (33 s at 86,000)."""
    parts = LAYOUTS[layout]
    own = F.substring_index("_metadata.file_path", "/", -1 - len(parts))
    values = {c: partition_value_from_path(own, c) for c in parts}
    return {c: F.when(v != "__HIVE_DEFAULT_PARTITION__", v).cast(PARTITION_TYPES[c]) for c, v in values.items()}


def folder_keys(spark: SparkSession, root: str, date_col: str = "date") -> DataFrame:
    """ticker, date, year and month of the data files of the daily layout, from the names of their folders,
    which hold them whole: files are listed, and none is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return (found.select(*[v.alias(c) for c, v in folder_columns("daily").items()]).coalesce(folder_tasks(spark))
                 .select("ticker", F.make_date("year", "month", "day").alias(date_col), "year", "month"))


def append_idempotent(df: DataFrame, root: str, layout: str = "monthly",
                      keys: Sequence[str] = ("ticker", "date"), date_col: str = "date",
                      announce: Callable[[list], None] | None = None) -> Observation:
    """Append only (ticker, date) groups not yet stored; existing ones are skipped,
    so re-running a batch writes nothing and the first write wins (K1, J4).

    The batch is stored once in the shared folder; the months it touches (a
    calendar-bounded list, the folder of NULL dates included) prune the read
    of existing keys, which are matched with a NULL-safe anti join: rows
    without a date are appended once like any others.
    ``announce`` is called with the batch's months (yyyyMM, None for rows without
    a date) before anything is written.
    Returns an Observation holding the number of rows written, their months and
    how many have no date.
    """
    spark = df.sparkSession
    parts = LAYOUTS[layout]
    batch = with_partition_columns(df, layout, date_col)
    stored_before = has_data_files(spark, root)
    if stored_before or announce:
        staged = work_path(spark, "batch")
        batch.write.parquet(staged)
        batch = spark.read.schema(batch.schema).parquet(staged)
        month = F.year(date_col) * 100 + F.month(date_col)
        touched = [r[0] for r in batch.select(month).distinct().collect()]
        if announce:
            announce(touched)
    if stored_before:
        folder = F.col("year") * 100 + F.col("month")
        wanted = folder.isin([m for m in touched if m is not None])
        if None in touched:
            wanted = wanted | F.col("year").isNull()
        if layout == "daily" and set(keys) == {"ticker", date_col} and df.schema[date_col].dataType == T.DateType():
            stored = folder_keys(spark, root, date_col)
        else:
            stored = spark.read.schema(raw_read_schema(df.schema, layout)).parquet(root)
        stored = stored.where(wanted).select(*keys).distinct()
        cond = [batch[k].eqNullSafe(stored[k]) for k in keys]
        batch = batch.join(stored, cond, "left_anti")
    obs = Observation("append_idempotent")
    # Range-partition on the folder columns plus the keys: a hot folder is
    # spread over several tasks, each writing one file into it.  The count is
    # observed after the exchange: below it, the range sampling job would
    # count the rows a second time.
    by = [*parts, *[k for k in keys if k not in parts]]
    ranged = batch.repartitionByRange(folder_tasks(spark), *by) if layout == "daily" else batch.repartitionByRange(*by)
    (ranged.observe(obs, F.count(F.lit(1)).alias("rows_written"),
                    F.collect_set(F.year(date_col) * 100 + F.month(date_col)).alias("months"),     # a calendar's months
                    F.count(F.when(F.col(date_col).isNull(), 1)).alias("undated"))
           .write.mode("append").options(**_NO_CHECKSUM_FILES if layout == "daily" else {}).partitionBy(*parts).parquet(root))
    return obs


# ---- clean layer ----------------------------------------------------------------------

def overwrite_partitions(df: DataFrame, root: str, partition_cols: Sequence[str] = ("ticker",),
                         dynamic: bool = True, max_records_per_file: int | None = None) -> Observation:
    """Partitioned overwrite (K4).  Dynamic mode replaces only the partitions
    present in ``df``; ``dynamic=False`` rebuilds the whole table, so a
    partition without rows goes.  The observation has the rows ``written``.

    Rows are rebalanced on the folder columns before the write: AQE gathers
    small folders and splits a hot one by size, so a folder gets few files of
    even size instead of one from every task."""
    obs = Observation("overwrite_partitions")
    balanced = df.hint("rebalance", *[F.col(c) for c in partition_cols])
    writer = (balanced.observe(obs, F.count(F.lit(1)).alias("written")).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic" if dynamic else "static"))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.partitionBy(*partition_cols).parquet(root)
    return obs


def write_quarantine(rejected: DataFrame, root: str, run_label: str) -> int:
    """Rejected rows with reason under ``run_ts=<label>``; nothing left behind
    when there are none (K5).  One job: the row count is observed during the
    write and an empty output folder is removed afterwards."""
    target = f"{root.rstrip('/')}/run_ts={run_label}"
    obs = Observation("quarantine")
    rejected.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(target)
    n = obs.get["n"]
    if n == 0:
        delete_path(rejected.sparkSession, target)
    return n


# ---- table load, create-if-absent ------------------------------------------------------

def create_table_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty Parquet table with fixed columns when none exists (K7)."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)


class EmptyLoadError(RuntimeError):
    pass


def truncate_load(df: DataFrame, path: str, schema: T.StructType, commit=None) -> None:
    """Replace the table's content with ``df`` as one unit (K6).

    Columns are taken in the table's order and cast to the table types; ones
    that ``df`` lacks are NULL, so the table keeps its columns.  The rows are
    staged and put in place by a commit of a redo journal (``commit``'s, which
    its owner ends, or one of the table's own): whatever the load is stopped at,
    the next one, or ``recover_load``, leaves the old or the new table.  An empty
    ``df`` is refused and the table left as it was (S9)."""
    from tickvault.sinks.journal import Journal

    spark = df.sparkSession
    own = commit or Journal(spark, f"{path.rstrip('/')}.journal").begin()
    if commit is None:
        create_table_if_absent(spark, path, schema)
    present = set(df.columns)
    out = df.select(*[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in schema.fields])
    rows = Observation("truncate_load")
    out.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(own.folder("load"))
    if not rows.get.get("n"):
        raise EmptyLoadError(f"nothing to load into {path}")
    own.replace(own.folder("load"), path)
    if commit is None:
        own.done()


def recover_load(spark: SparkSession, path: str) -> None:
    """Finish a load of ``path`` that was stopped after its commit."""
    from tickvault.sinks.journal import Journal

    Journal(spark, f"{path.rstrip('/')}.journal").recover()


def export_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Truncate-and-insert into a database table over JDBC (K6, optional)."""
    (df.write.mode("overwrite").option("truncate", "true")
       .jdbc(url, table, properties=properties))


def append_rows(df: DataFrame, path: str) -> None:
    """Append-only table (audit log, K11)."""
    df.coalesce(1).write.mode("append").parquet(path)


def compact_partitions(spark: SparkSession, root: str, partition_cols: Sequence[str],
                       staging_root: str, where: str | None = None,
                       rows_per_file: int | None = None,
                       schema: T.StructType | None = None) -> int:
    """Rewrite the folders of a partitioned table into fewer, larger files.

    Daily appends leave one small file per run in each folder; this reads the
    chosen folders (``where`` is a predicate on the partition columns, so only
    they are listed and read), writes them to a staging folder range-partitioned
    on the partition columns (one file per folder, several for a large one when
    ``rows_per_file`` is given) and swaps each rewritten folder in.  Rows are
    unchanged.  Returns the number of folders rewritten.
    """
    cols = list(partition_cols)
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(root)
    if where:
        df = df.where(where)
    # Folder values exactly as written (``month=01`` stays ``01``, not the
    # integer a read infers), so each folder is rewritten under its own name.
    path = F.col("_metadata.file_path")
    df = df.withColumns({c: partition_value_from_path(path, c) for c in cols})
    folders = [tuple(r) for r in df.select(*cols).distinct().collect()]  # one per folder
    if not folders:
        return 0
    staging = f"{staging_root.rstrip('/')}/compact-{uuid.uuid4().hex}"
    writer = df.repartitionByRange(*cols).write
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", str(rows_per_file))
    writer.partitionBy(*cols).parquet(staging)
    for values in folders:
        sub = "/".join(f"{c}={_path_value(v)}" for c, v in zip(cols, values))
        swap_in(spark, f"{staging}/{sub}", f"{root.rstrip('/')}/{sub}")
    delete_path(spark, staging)
    return len(folders)


def _path_value(v) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if v is None else str(v)
