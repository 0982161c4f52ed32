"""Helpers shared by the operators on text tables.

Python runs only inside Spark tasks, on Arrow batches.  Words are hashed with
xxHash (64 bits); windows of words combine those hashes by a polynomial, so one
pass of numpy operations gives the hash of every window of a batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickvault.session import ensure_checkpoint_dir

BATCH_ROWS = 512
WORD_SPACE = b" \t\n\r\x0b\x0c"          # what bytes.split() splits at
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)   # odd, so invertible


def use_small_batches(spark: SparkSession) -> None:
    """Bound the rows of one Arrow batch: a row may hold a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_measured(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``stage``, and aggregates of the written rows without another job."""
    seen = Observation()
    out = stage(df.observe(seen, *[m.alias(k) for k, m in measures.items()]), name)
    return out, seen.get


def map_batches(df: DataFrame, fn: Callable[[dict], Iterable[dict]], schema: str) -> DataFrame:
    """Apply ``fn`` (columns by name in, columns by name out) to each Arrow batch."""
    target = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in fn(columns(batch)):
                yield record_batch(out, target)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def record_batch(out: dict, target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
         for f in target], schema=target)


class Columns(dict):
    """Columns of a batch; ``batch`` has them as Arrow arrays."""

    batch: pa.RecordBatch


def columns(batch: pa.RecordBatch) -> Columns:
    """Strings as lists of UTF-8 bytes, everything else as Arrow arrays."""
    out = Columns((name, col.cast(pa.large_binary()).to_pylist()
                   if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else col)
                  for name, col in zip(batch.schema.names, batch.columns))
    out.batch = batch
    return out


def row_keys(*cols: str) -> tuple[Column, Column]:
    """The halves of a 128-bit key of a row's columns; equal rows share it, nulls count as a value."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in cols] + [F.col(c).isNull() for c in cols]
    # The first column of xxhash64 is the seed of the next: two independent halves.
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def row_key(*cols: str) -> Column:
    """``row_keys`` as 16 bytes."""
    return F.concat(*[F.unhex(F.lpad(F.hex(half), 16, "0")) for half in row_keys(*cols)])


def own_names(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns under names that clash with none of ours, and these names in order."""
    inner = [f"_own{k}" for k in range(len(df.columns))]
    return df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(df.columns, inner)]), inner


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 3 = 1; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def learnable(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 != 1, F.lit(False))


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; sizes sketches, never results."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


# ---- words and windows -------------------------------------------------------

def word_hashes(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the word count of each text."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            own = (text.lower() if lower else text).split()
            counts[i] = len(own)
            words += own
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), counts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (both[0], both[1])
    return have


def window_hashes(items: np.ndarray, size: int, base: int = 0) -> np.ndarray:
    """Hash of ``items[i:i+size]`` for every i; windows of equal items get equal hashes."""
    n = len(items) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers(_BASES[base], len(items))
    total = np.zeros(len(items) + 1, np.uint64)
    np.cumsum(items * up[:len(items)], out=total[1:])
    return mix((total[size:] - total[:-size]) * down[:n])


class PrefixHashes:
    """``window_hashes`` of several sizes, or at few places, from one pass over the items."""

    def __init__(self, items: np.ndarray, base: int = 0):
        self.n = len(items)
        up, self.down = _powers(_BASES[base], self.n)
        self.total = np.zeros(self.n + 1, np.uint64)
        np.cumsum(items * up[:self.n], out=self.total[1:])

    def windows(self, size: int) -> np.ndarray:
        n = self.n - size + 1
        return mix((self.total[size:] - self.total[:-size]) * self.down[:n]) if n > 0 else np.empty(0, np.uint64)

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        return mix((self.total[starts + size] - self.total[starts]) * self.down[starts])


def window_starts(counts: np.ndarray, size: int) -> np.ndarray:
    """Positions in the concatenated items at which a window stays inside its text."""
    ends = np.repeat(np.cumsum(counts), counts)
    return np.flatnonzero(np.arange(len(ends)) + size <= ends)


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Boolean mask of the n positions inside any window that begins at ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:-1]) > 0


def leftmost_min(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest of ``values[i:i+width]`` for every i.

    Values are compared by their upper 32 bits; the lower ones hold the position meanwhile.
    """
    if len(values) < width:
        return np.empty(0, np.int64)
    best = (values & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while span < width:
        step = min(span, width - span)
        best = np.minimum(best[:-step], best[step:])
        span += step
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
