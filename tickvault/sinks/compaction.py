"""Compaction of a partitioned table by file sizes (K2, K4).

Which files to rewrite follows from the listing alone: small ones that can be packed together,
and oversized ones that can be split.  Only those are read, in one job, and every output file
has a slot of its own, so a folder's files come near the target size and a hot folder is split
over as many tasks as it needs.  The new files take the place of the old ones in one commit of
a redo journal beside the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.operators.lookup import broadcast_if_bounded
from tickvault.sinks import files
from tickvault.sinks.journal import Journal


@dataclass(frozen=True)
class Pack:
    """Files of one folder that become ``slots`` new ones."""
    folder: str
    names: tuple[str, ...]
    slots: int


def list_data_files(spark: SparkSession, root: str) -> dict[str, list[tuple[str, int]]]:
    """Folder below ``root`` -> (name, bytes) of its Parquet files."""
    fs, top = files._fs(spark, root)
    found: dict[str, list[tuple[str, int]]] = {}
    if not fs.exists(top):
        return found
    # Plain statuses, a folder at a time: ``listFiles`` looks up each file's owner and blocks too.
    todo = [(top, "")]
    while todo:
        at, folder = todo.pop()
        for status in fs.listStatus(at):
            path = status.getPath()
            name = path.getName()
            if status.isDirectory():
                if not name.startswith(("_", ".")):
                    todo.append((path, f"{folder}/{name}" if folder else name))
            elif name.endswith(".parquet"):
                found.setdefault(folder, []).append((name, status.getLen()))
    return found


def plan(listing: dict[str, list[tuple[str, int]]], target_bytes: int) -> list[Pack]:
    """What to rewrite.  Files between half and twice the target stay; so does a small one that has
    no other to go with."""
    packs = []
    for folder, own in sorted(listing.items()):
        odd = [(n, b) for n, b in own if not target_bytes / 2 <= b <= 2 * target_bytes]
        slots = max(1, round(sum(b for _, b in odd) / target_bytes))
        if odd and (slots < len(odd) or any(b > 2 * target_bytes for _, b in odd)):
            packs.append(Pack(folder, tuple(sorted(n for n, _ in odd)), slots))
    return packs


def sources(listing: dict[str, list[tuple[str, int]]], packs: list[Pack]) -> list[str]:
    """What to read, relative to the root: a folder whose files are all rewritten as one path (its
    listing costs one call however many files it has), else each file."""
    above = {"/".join(parts[:k]) for parts in (f.split("/") for f in listing) for k in range(len(parts))}
    paths = []
    for p in packs:
        whole = p.folder and p.folder not in above and len(p.names) == len(listing[p.folder]) \
            and not any(n.startswith(("_", ".")) for n in p.names)
        paths += [p.folder] if whole else [f"{p.folder}/{n}" if p.folder else n for n in p.names]
    return paths


def _rows(spark: SparkSession, root: str, packs: list[Pack], listing: dict[str, list[tuple[str, int]]]) -> DataFrame:
    """Stored rows of the packs' files, each with the number of its output file."""
    base = root.rstrip("/")
    # Without the folders' columns, as stored; of a folder, the files that the listing counts.
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(*[f"{base}/{x}" for x in sources(listing, packs)])
    firsts, at = [], 0
    for p in packs:
        firsts.append((p.folder, at, p.slots))
        at += p.slots
    table = broadcast_if_bounded(spark.createDataFrame(firsts, "_folder string, _first long, _slots long"), known_rows=len(firsts))
    # The folder of a row's file, as the listing names it.
    stem = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base).toUri().getPath().rstrip("/")
    inside = F.substring_index(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), f"{stem}/", -1)
    folder = F.when(F.instr(inside, "/") > 0, F.regexp_replace(inside, "/[^/]*$", "")).otherwise("")
    return df.withColumns({"_at": folder, "_mix": F.xxhash64("_metadata.file_path", "_metadata.row_index")}) \
        .join(table, F.col("_at") == F.col("_folder")) \
        .withColumn("_slot", (F.col("_first") + F.pmod("_mix", "_slots")).cast("int")) \
        .drop("_at", "_mix", "_folder", "_first", "_slots")


def compact_by_bytes(spark: SparkSession, root: str, target_bytes: int = 128 << 20) -> list[Pack]:
    """Rewrite what ``plan`` names; rows stay as they are.  Returns what was rewritten.

    The driver holds the listing: a name and a size per file."""
    log = Journal(spark, f"{root.rstrip('/')}.journal")
    log.recover()
    listing = list_data_files(spark, root)
    packs = plan(listing, target_bytes)
    if not packs:
        return []
    commit = log.begin()
    total = sum(p.slots for p in packs)
    _rows(spark, root, packs, listing).repartitionById(total, F.col("_slot")) \
        .write.partitionBy("_slot").parquet(commit.folder("packed"))
    at = 0
    for p in packs:
        target = f"{root.rstrip('/')}/{p.folder}" if p.folder else root.rstrip("/")
        for k in range(at, at + p.slots):
            for name in files.list_files(spark, f"{commit.folder('packed')}/_slot={k}"):
                if name.endswith(".parquet"):
                    commit.replace(f"{commit.folder('packed')}/_slot={k}/{name}", f"{target}/{name}")
        for name in p.names:
            commit.remove(f"{target}/{name}")
        at += p.slots
    commit.done()
    return packs


__all__ = ["Pack", "compact_by_bytes", "list_data_files", "plan", "sources"]
