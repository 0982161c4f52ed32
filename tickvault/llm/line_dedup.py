"""Line dedup: exact reference counts behind sharded cuckoo filters.

A line's key is the line without white space at its ends, A-Z lower-cased.  A key of at
least ``min_chars`` characters that at least ``min_docs`` documents hold keeps its lines
only in the holder with the largest id.

The exact table has one row for each key (a 128-bit hash): its count of holders and the
keeper.  The keys to drop go into cuckoo filters, one per shard of the key space; a scan of
the documents probes them and sends only lines that may be repeated to the exact table,
which decides.  Filters are broadcast while they fit ``max_filter_mb``; beyond that all long
lines are joined with the exact table, with the same result.  Holders are summed map-side,
so a line in a third of all documents is one row per task.

``LineStore`` keeps this incrementally.  Its tables, the references that are present, the
counts per key and the filters, lie in folders by shard and change together, in one commit;
a batch recounts only its own keys, and a filter takes those in that came to be repeated and
gives up those that no longer are.  Inserting and then deleting documents gives back the
former counts and filters.

Defined cases: null or empty text is one empty line and never dropped; a null id is smaller
than any other; each row is a document, so repeated rows count as several holders (and all
rows of the keeper's id keep the line); other columns are kept by ``dedup_lines``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.llm.common import WORD_SPACE, map_batches, mix, row_key, stage, use_small_batches
from tickvault.sinks.files import has_data_files
from tickvault.sinks.journal import Commit, Journal

MIN_CHARS, MIN_DOCS = 20, 3
SHARD_KEYS = 500_000
_MASK = (1 << 64) - 1


class CuckooFilter:
    """A set of 64-bit hashes in buckets of four 16-bit fingerprints; never misses a member."""

    SLOTS, KICKS = 4, 500

    def __init__(self, buckets: int = 16, slots: np.ndarray | None = None):
        self.buckets = buckets          # a power of two
        self.slots = np.zeros((buckets, self.SLOTS), np.uint16) if slots is None else slots

    @classmethod
    def build(cls, hashes: np.ndarray) -> CuckooFilter:
        buckets = 16
        while buckets * cls.SLOTS * 0.85 < len(hashes):
            buckets *= 2
        while True:
            made = cls(buckets)
            if all(made.insert(h) for h in hashes):
                return made
            buckets *= 2

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mix(np.asarray(hashes).astype(np.int64).view(np.uint64))
        print_ = (h >> np.uint64(48)).astype(np.uint16)
        print_ = np.where(print_ == 0, np.uint16(1), print_)
        first = (h & np.uint64(self.buckets - 1)).astype(np.int64)
        return print_, first, first ^ self._shift(print_)

    def _shift(self, print_: np.ndarray) -> np.ndarray:
        return (mix(np.asarray(print_).astype(np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        p, a, b = self._places(hashes)
        return (self.slots[a] == p[:, None]).any(axis=1) | (self.slots[b] == p[:, None]).any(axis=1)

    def insert(self, h: int) -> bool:
        """False if the filter is too full; the caller then builds a larger one."""
        (p,), (a,), (b,) = self._places(np.array([h]))
        for at in (a, b):
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = p
                return True
        at = b
        for kick in range(self.KICKS):
            slot = (kick + int(p)) % self.SLOTS
            p, self.slots[at, slot] = self.slots[at, slot], p
            at = at ^ int(self._shift(np.array([p]))[0])
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = p
                return True
        return False

    def delete(self, h: int) -> None:
        """Remove one member; only for hashes that were inserted."""
        (p,), (a,), (b,) = self._places(np.array([h]))
        for at in (a, b):
            found = np.flatnonzero(self.slots[at] == p)
            if len(found):
                self.slots[at, found[0]] = 0
                return


def line_keys(text: bytes | None, min_chars: int = MIN_CHARS) -> list[int | None]:
    """For each line the 128-bit hash of its key, None for a key that is too short."""
    out: list[int | None] = []
    for line in (text or b"").split(b"\n"):
        key = line.strip(WORD_SPACE)
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)
        out.append(xxhash.xxh3_128_intdigest(key.lower()) if long else None)
    return out


def _halves(keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return (np.array([k >> 64 for k in keys], np.uint64).view(np.int64),
            np.array([k & _MASK for k in keys], np.uint64).view(np.int64))


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(row_key(doc_id, text).alias("key"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).alias("text"))


def references(docs: DataFrame, min_chars: int = MIN_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """h1, h2, doc_id: one row for each document and key it holds."""
    use_small_batches(docs.sparkSession)

    def run(cols):
        keys, owner = [], []
        for i, t in enumerate(cols["text"]):
            own = set(line_keys(t, min_chars)) - {None}
            keys += own
            owner += [i] * len(own)
        h1, h2 = _halves(keys)
        yield {"h1": h1, "h2": h2, "doc_id": cols["doc_id"].take(pa.array(owner, pa.int64()))}

    return map_batches(_rows(docs, doc_id, text).drop("key"), run, "h1 long, h2 long, doc_id long")


def repeated(refs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The exact table's rows to act on: h1, h2, n_docs, keeper."""
    return refs.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper")) \
        .where(F.col("n_docs") >= min_docs)


def build_filters(keys: DataFrame, shards: int) -> DataFrame:
    """shard, buckets, slots: a cuckoo filter for each shard of the key space."""
    def run(table: pa.Table) -> pa.Table:
        made = CuckooFilter.build(table.column("h1").to_numpy())
        return pa.table({"shard": table.column("shard")[:1], "buckets": pa.array([made.buckets], pa.int64()),
                         "slots": pa.array([made.slots.tobytes()], pa.binary())})

    return keys.select(F.pmod("h1", F.lit(shards)).alias("shard"), "h1").groupBy("shard") \
        .applyInArrow(run, "shard long, buckets long, slots binary")


def load_filters(rows: list) -> dict[int, CuckooFilter]:
    return {r["shard"]: CuckooFilter(r["buckets"], np.frombuffer(r["slots"], np.uint16).reshape(-1, CuckooFilter.SLOTS))
            for r in rows}


def _probe(rows: DataFrame, filters: list | None, shards: int, min_chars: int) -> DataFrame:
    """key, doc_id, h1, h2 of lines that the filters don't rule out."""
    shared = rows.sparkSession.sparkContext.broadcast([r.asDict() for r in filters] if filters is not None else None)

    def run(cols):
        keys, owner = [], []
        for i, t in enumerate(cols["text"]):
            own = set(line_keys(t, min_chars)) - {None}
            keys += own
            owner += [i] * len(own)
        h1, h2 = _halves(keys)
        if shared.value is not None:
            maybe = np.zeros(len(h1), bool)
            for shard, one in load_filters(shared.value).items():
                own = np.flatnonzero(h1 % shards == shard)      # numpy's % has the divisor's sign, as pmod
                maybe[own] = one.contains(h1[own])
            h1, h2, owner = h1[maybe], h2[maybe], np.array(owner, np.int64)[maybe]
        at = pa.array(owner, pa.int64())
        yield {"key": cols["key"].take(at), "doc_id": cols["doc_id"].take(at), "h1": h1, "h2": h2}

    return map_batches(rows, run, "key binary, doc_id long, h1 long, h2 long")


def drop_lists(docs: DataFrame, dups: DataFrame, filters: DataFrame | None, shards: int,
               min_chars: int = MIN_CHARS, max_filter_mb: int = 64, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """key (of the row) and the keys it must lose; rows that lose none are absent."""
    rows = None
    if filters is not None:
        size = filters.agg(F.sum(F.octet_length("slots"))).first()[0] or 0
        rows = filters.collect() if size <= max_filter_mb << 20 else None
    found = _probe(_rows(docs, doc_id, text), rows, shards, min_chars)
    lose = found.join(dups.select("h1", "h2", "keeper"), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lose.groupBy("key").agg(F.collect_set(F.struct("h1", "h2")).alias("lose"))


def _split(text: bytes | None, lose, min_chars: int) -> tuple[int, list[bytes]]:
    """Number of lines, and the lines that stay."""
    lines = (text or b"").split(b"\n")
    if lose is None or not len(lose):
        return len(lines), lines
    gone = {((x["h1"] & _MASK) << 64) | (x["h2"] & _MASK) for x in lose}
    return len(lines), [line for line, k in zip(lines, line_keys(text, min_chars)) if k not in gone]


def find(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, **names) -> DataFrame:
    """``drop_lists`` of a whole table: count, build the filters, probe, verify."""
    dups = stage(repeated(references(docs, min_chars, **names), min_docs), "line-dups")
    shards = max(1, -(-dups.count() // SHARD_KEYS))
    return drop_lists(docs, dups, build_filters(dups, shards), shards, min_chars, **names)


def digests(docs: DataFrame, lists: DataFrame, min_chars: int = MIN_CHARS, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    def run(cols):
        total, dropped, sha = [], [], []
        for t, lose in zip(cols["text"], cols["lose"].to_pylist()):
            n, kept = _split(t, lose, min_chars)
            total.append(n)
            dropped.append(n - len(kept))
            sha.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
        yield {"doc_id": cols["doc_id"], "n_lines": total, "n_dropped": dropped, "kept_sha256": sha}

    rows = _rows(docs, doc_id, text).join(lists, "key", "left").select("doc_id", "text", "lose")
    return map_batches(rows, run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def dedup_lines(docs: DataFrame, lists: DataFrame, min_chars: int = MIN_CHARS, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """``docs`` with the repeated lines cut out of ``text``; a null text stays null."""
    names = docs.columns
    inner = [f"_c{i}" for i in range(len(names))]
    where = inner[names.index(text)]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(names, inner)],
                       row_key(doc_id, text).alias("key")).join(lists, "key", "left")
    joined = F.pandas_udf(_clean_series(min_chars), "string")
    text_col = F.when(F.col("lose").isNull(), F.col(where)).otherwise(joined(where, "lose"))
    return rows.withColumn(where, text_col).select(*[F.col(k).alias(c) for c, k in zip(names, inner)])


def _clean_series(min_chars: int):
    def clean(text: pd.Series, lose: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or x is None or not len(x) else
                          b"\n".join(_split(t.encode(), x, min_chars)[1]).decode() for t, x in zip(text, lose)], dtype=object)

    return clean


class LineStore:
    """References, counts and filters of many batches, in tables below ``root`` (a shared folder).

    A store that is opened again on its root goes on where it was.  Inserting under a batch name
    that was used before replaces that batch.  Deleting takes out documents as often as they are
    present, never more; the name of a deletion makes it count once, however often it is called.
    """

    REFS, COUNTS = "h1 long, h2 long, doc_id long, n long", "h1 long, h2 long, n_docs long, keeper long"
    FILTERS = "buckets long, slots binary"

    def __init__(self, spark: SparkSession, root: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 shard_keys: int = SHARD_KEYS):
        self.spark, self.root, self.min_chars, self.min_docs, self.shard_keys = spark, root.rstrip("/"), min_chars, min_docs, shard_keys
        self.journal = Journal(spark, self.root)
        self.journal.recover()

    @property
    def shards(self) -> int:
        return self.journal.marks().get("shards", 1)

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        schema = schema if name.startswith("batches/") else f"{schema}, shard long"
        if not has_data_files(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def refs(self) -> DataFrame:
        """h1, h2, doc_id, n: the references that are present."""
        return self._read("refs", self.REFS).drop("shard")

    def counts(self) -> DataFrame:
        """h1, h2, n_docs, keeper of every key that is present."""
        return self._read("counts", self.COUNTS).drop("shard")

    def dups(self) -> DataFrame:
        return self.counts().where(F.col("n_docs") >= self.min_docs)

    @property
    def filters(self) -> DataFrame:
        """shard, buckets, slots."""
        return self._read("filters", self.FILTERS).select("shard", "buckets", "slots")

    def insert(self, batch: str, docs: DataFrame) -> None:
        """Add documents; inserting the same batch name again replaces it."""
        commit = self.journal.begin()
        name = f"batches/{hashlib.sha256(batch.encode()).hexdigest()}"
        self._grouped(references(docs, self.min_chars).withColumn("n", F.lit(1))).write.parquet(commit.folder("batch"))
        new = self.spark.read.schema(self.REFS).parquet(commit.folder("batch"))
        old = self._read(name, self.REFS).withColumn("n", -F.col("n"))
        self._apply(commit, new.unionAll(old))
        commit.replace(commit.folder("batch"), f"{self.root}/{name}")
        commit.done()

    def delete(self, batch: str, docs: DataFrame) -> None:
        """Take out documents that are present."""
        commit = self.journal.begin()
        done = commit.marks.setdefault("deletions", [])
        if batch in done:
            return
        done.append(batch)
        self._apply(commit, references(docs, self.min_chars).withColumn("n", F.lit(-1)))
        commit.done()

    @staticmethod
    def _grouped(refs: DataFrame) -> DataFrame:
        return refs.groupBy("h1", "h2", "doc_id").agg(F.sum("n").alias("n"))

    def _apply(self, commit: Commit, change: DataFrame) -> None:
        """Stage the tables as they are after ``change`` (references with signed numbers)."""
        shards = commit.marks.get("shards")
        change = stage(self._grouped(change).where("n <> 0"), "line-change")
        if shards is None:
            keys = change.select("h1", "h2").distinct().count()
            shards = commit.marks["shards"] = 1 + keys // self.shard_keys
        shard = F.pmod("h1", F.lit(shards)).alias("shard")
        touched = [r[0] for r in change.select(shard).distinct().collect()]
        here = F.col("shard").isin(touched)
        stored = self._read("refs", self.REFS).where(here).drop("shard")
        refs = self._grouped(stored.unionAll(change)).where("n > 0")        # never below nothing
        refs.select("*", shard).write.partitionBy("shard").parquet(commit.folder("refs"))
        refs = self.spark.read.schema(self.REFS).parquet(commit.folder("refs"))
        # Only the batch's keys are counted anew.
        own = stage(change.select("h1", "h2").distinct(), "line-keys")
        before = self._read("counts", self.COUNTS).where(here).drop("shard")
        after = refs.join(own, ["h1", "h2"], "left_semi").groupBy("h1", "h2") \
            .agg(F.sum("n").alias("n_docs"), F.max("doc_id").alias("keeper"))
        after = stage(after, "line-counts")
        before.join(own, ["h1", "h2"], "left_anti").unionByName(after) \
            .select("*", shard).write.partitionBy("shard").parquet(commit.folder("counts"))
        often = F.col("n_docs") >= self.min_docs
        was = before.join(own, ["h1", "h2"], "left_semi").where(often).select("h1", "h2")
        now = after.where(often).select("h1", "h2")
        moves = now.join(was, ["h1", "h2"], "left_anti").select("h1", F.lit(True).alias("comes")).unionAll(
            was.join(now, ["h1", "h2"], "left_anti").select("h1", F.lit(False))).select("*", shard)
        self._filters(commit, moves, touched)
        for name in ("refs", "counts", "filters"):
            written = set(commit.replace_parts(commit.folder(name), f"{self.root}/{name}"))
            for k in touched:       # a shard that has lost all its rows
                if f"shard={k}" not in written and name != "filters":
                    commit.remove(f"{self.root}/{name}/shard={k}")

    def _filters(self, commit: Commit, moves: DataFrame, touched: list[int]) -> None:
        def update(old: pa.Table, new: pa.Table) -> pa.Table:
            one = CuckooFilter() if not old.num_rows else CuckooFilter(
                old.column("buckets")[0].as_py(), np.frombuffer(old.column("slots")[0].as_py(), np.uint16)
                .reshape(-1, CuckooFilter.SLOTS).copy())
            keys, comes = new.column("h1").to_pylist(), new.column("comes").to_pylist()
            for k, c in zip(keys, comes):
                if not c:
                    one.delete(k)
            fits = all([one.insert(k) for k, c in zip(keys, comes) if c])
            shard = (old if old.num_rows else new).column("shard")[:1]
            return pa.table({"shard": shard, "buckets": pa.array([one.buckets], pa.int64()),
                             "slots": pa.array([one.slots.tobytes() if fits else None], pa.binary())})

        stored = self.filters.where(F.col("shard").isin(touched))
        made = stage(stored.groupBy("shard").cogroup(moves.groupBy("shard"))
                     .applyInArrow(update, "shard long, buckets long, slots binary"), "line-filters")
        # A filter that is too full is built anew from its shard's counts.
        full = [r["shard"] for r in made.where("slots is null").select("shard").collect()]
        if full:
            counts = self.spark.read.schema(f"{self.COUNTS}, shard long").parquet(commit.folder("counts")) \
                .where(F.col("shard").isin(full) & (F.col("n_docs") >= self.min_docs))
            made = made.where("slots is not null").unionByName(build_filters(counts, commit.marks["shards"]))
        made.write.partitionBy("shard").parquet(commit.folder("filters"))

    def drop_lists(self, docs: DataFrame) -> DataFrame:
        return drop_lists(docs, self.dups(), self.filters, self.shards, self.min_chars)


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, find(docs))


OP2_SQL = r"""
WITH ws AS (SELECT ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS s),
lines AS (
  SELECT doc_id, no, line, translate(trim(line, (SELECT s FROM ws)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no FROM documents)),
dups AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, l.no, l.line, d.k IS NOT NULL AND l.doc_id <> d.keeper AS gone FROM lines l LEFT JOIN dups d ON d.k = l.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
