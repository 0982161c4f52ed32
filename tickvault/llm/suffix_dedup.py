"""Removal of repeated byte strings by merging shard Burrows-Wheeler transforms.

A document is UTF-8 bytes; a window is ``size`` of them.  Windows with the same smallest
``GRAM``-byte hash (their anchor) lie side by side, and equal windows have equal anchors,
so the text around one anchor, a context, is all that equal windows need to meet:

1. Of the 168 bytes around a window's anchor, 84 or more lie before or after it, so the
   anchor with the 84 bytes before it, or with those after it, is inside the window.  A
   count-min sketch of these strings rules out windows whose string occurs once; none that
   repeats is lost.  What is left of the contexts is counted, equal ones summed map-side.
2. Contexts found twice are repeated as a whole.  For the rest, the contexts of an anchor
   go to one bucket.  There, shards of contexts are suffix-sorted, each by itself, and
   their Burrows-Wheeler transforms are merged: an interleave, which starts as one shard
   after the other, is dealt out stably by the preceding symbols again and again, and is
   right for one more symbol each time.  Where neighbours part, the class boundary gives
   their common prefix; the classes left after ``size`` symbols are the repeated
   intervals.  After ``STEP`` single symbols the classes serve as symbols of that length.
3. An anchor with more than ``HOT_BYTES`` of different contexts goes another exact way: its
   windows are grouped by a 128-bit hash, summed map-side.

Documents get back the ranges of windows that turned out not to repeat, and cut the rest.

Defined cases: null and empty texts have no bytes; windows never cross documents; equal
windows may overlap or lie in one document; repeated rows are separate occurrences; a null
id is an id like any other; removed bytes may split a character; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickvault.llm import repeat_sketch
from tickvault.llm.common import (PrefixHashes, covered, leftmost_min, map_batches, mix, row_keys, stage, use_small_batches,
                                  window_hashes)

SIZE, GRAM = 200, 32
STEP = 10                       # divides SIZE
SHARDS = 4
BUCKET_BYTES = 2 << 20
HOT_BYTES = 4 << 20
SIDE = (SIZE - GRAM) // 2       # bytes that any window has on one side of its anchor at least
SLICE = 1 << 20                 # bytes hashed at a time
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BEFORE = np.uint64(0x5851F42D4C957F2D)


class Slice:
    """A part of a text: its offset, bytes, runs of windows with the same anchor, the anchors and their places."""

    def __init__(self, at: int, part: bytes):
        self.at, self.part = at, part
        self.sums = PrefixHashes(_BYTE[np.frombuffer(part, np.uint8)])
        grams = self.sums.windows(GRAM)
        low = leftmost_min(grams, SIZE - GRAM + 1)
        self.first = np.flatnonzero(np.diff(low, prepend=-1))
        self.end = np.append(self.first[1:], len(low))
        self.place = low[self.first]
        self.anchor = grams[self.place]

    def sides(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which runs have windows with the bytes before, or after, their anchor; and the hashes of those strings."""
        before, after = self.first <= self.place - SIDE, self.end - 1 >= self.place - SIDE
        return before, after, mix(self.sums.at(self.place[before] - SIDE, SIDE + GRAM) ^ _BEFORE), self.sums.at(self.place[after], SIDE + GRAM)


def runs(texts: list[bytes | None]) -> Iterator[tuple[int, Slice]]:
    """The slices of all texts, with the text's number."""
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text or b"") - SIZE + 1), SLICE):
            yield i, Slice(at, text[at:at + SLICE + SIZE - 1])


def possible(sketch: dict, s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Runs of windows cut down to those that may repeat; empty where start and end are equal."""
    first, end, place = s.first, s.end, s.place
    before, after, hash_before, hash_after = s.sides()
    before[before] = repeat_sketch.maybe_repeated(sketch, hash_before)
    after[after] = repeat_sketch.maybe_repeated(sketch, hash_after)
    # Windows up to place - SIDE hold the string before, those from there on the string after.
    low = np.where(before, first, np.maximum(first, place - SIDE + np.where(after, 0, 1 << 40)))
    high = np.where(after, end, np.minimum(end, place - SIDE + 1))
    return low, np.maximum(low, high)


# ---- one bucket --------------------------------------------------------------

def suffix_order(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes of a shard by their first 224 symbols, never past the end of a string.

    ``symbols`` has 0 at ``ends`` and bytes plus one elsewhere; ends sort by position.
    """
    n = len(symbols)
    key = np.zeros(n, np.uint64)
    alive = np.ones(n, bool)
    wide = np.concatenate([symbols, np.zeros(8, symbols.dtype)]).astype(np.uint64)
    for k in range(7):
        here = wide[k:k + n]
        key = key * np.uint64(257) + np.where(alive, here, np.uint64(0))
        alive &= here != 0
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (sorted_key[1:] != sorted_key[:-1]) | ~alive[order[1:]] | ~alive[order[:-1]]
    length = 7
    rank = np.empty(n + 256, np.int64)
    rank[n:] = -1
    while length < SIZE:
        head = np.flatnonzero(fresh)
        rank[order] = head[np.cumsum(fresh) - 1]
        sizes = np.diff(head, append=n)
        open_ = np.repeat(sizes > 1, sizes)
        if not open_.any():
            break
        at = np.flatnonzero(open_)
        own = order[at]
        second = rank[np.minimum(own + length, n)]
        by = np.lexsort((second, rank[own]))
        order[at] = own[by]
        first, second = rank[own][by], second[by]
        fresh[at[1:]] |= (first[1:] == first[:-1]) & (second[1:] != second[:-1])
        length *= 2
    return order


def merge_shards(shards: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Positions (over all shards) in merged order, and the class of equal ``STEP``-prefixes.

    ``shards``: symbols and suffix order of each.  The interleave holds shard numbers only;
    the k-th entry of a shard stands for its k-th suffix.
    """
    sizes = [len(s) for s, _ in shards]
    base = np.cumsum([0, *sizes[:-1]])
    last = np.concatenate([s[order - 1] for s, order in shards])        # the transforms, shard after shard
    ends = [int((s == 0).sum()) for s, _ in shards]
    stops = np.repeat(np.arange(len(shards), dtype=np.uint8), ends)
    inter = np.concatenate([stops, np.repeat(np.arange(len(shards), dtype=np.uint8), np.array(sizes) - ends)])
    kind = np.zeros(len(inter), np.int32)       # no symbol seen yet: all are alike, ends included
    symbols = np.empty(len(inter), np.uint16)
    for _ in range(STEP):
        symbols[np.argsort(inter, kind="stable")] = last
        inside = np.flatnonzero(symbols)
        deal = inside[np.argsort((symbols[inside] - 1).astype(np.uint8), kind="stable")]
        above, symbol = kind[deal], symbols[deal]
        fresh = np.empty(len(deal), bool)
        fresh[:1] = True
        fresh[1:] = (above[1:] != above[:-1]) | (symbol[1:] != symbol[:-1])
        inter = np.concatenate([stops, inter[deal]])
        kind[:len(stops)] = np.arange(len(stops))
        kind[len(stops):] = len(stops) - 1 + np.cumsum(fresh, dtype=np.int32)
    place = np.empty(len(inter), np.int64)
    place[np.argsort(inter, kind="stable")] = np.concatenate([order + b for (_, order), b in zip(shards, base)])
    return place, kind


def repeated_starts(contexts: list[bytes]) -> list[np.ndarray]:
    """For each context a mask of its windows that another context (or place) holds too."""
    shards, where = [], np.empty((len(contexts), 2), np.int64)
    base = 0
    for k in range(min(SHARDS, len(contexts))):
        own = range(k, len(contexts), SHARDS)
        lengths = np.array([len(contexts[i]) + 1 for i in own])
        ends = np.cumsum(lengths) - 1
        symbols = np.frombuffer(b"\x00".join([contexts[i] for i in own]) + b"\x00", np.uint8).astype(np.uint16) + 1
        symbols[ends] = 0
        where[list(own), 0], where[list(own), 1] = base + ends + 1 - lengths, lengths - 1
        shards.append((symbols, suffix_order(symbols, ends)))
        base += len(symbols)
    place, kind = merge_shards(shards)
    unit = np.empty(base, np.int32)             # class of the STEP symbols from a position
    unit[place] = kind
    inside = np.zeros(base + 1, bool)           # does a window fit from there?
    for at, n in where:
        inside[at:at + n - SIZE + 1] = True
    # The same refinement with STEP symbols at a time.  A row stands for the suffix that it will
    # have reached at the end; rows alone in their class stay alone and leave.
    target = np.flatnonzero(inside)
    target = target[np.argsort(unit[target + SIZE - STEP], kind="stable")]
    kind = unit[target + SIZE - STEP]
    for done in range(STEP, SIZE, STEP):
        fresh = np.ones(len(target), bool)
        fresh[1:] = kind[1:] != kind[:-1]
        head = np.flatnonzero(fresh)
        many = np.repeat(np.diff(head, append=len(target)) > 1, np.diff(head, append=len(target)))
        target, kind = target[many], np.cumsum(fresh)[many]
        symbol = unit[target + SIZE - STEP - done]
        deal = np.argsort(symbol, kind="stable")
        target, above, symbol = target[deal], kind[deal], symbol[deal]
        fresh = np.ones(len(target), bool)
        fresh[1:] = (above[1:] != above[:-1]) | (symbol[1:] != symbol[:-1])
        kind = np.cumsum(fresh)
    twice = np.zeros(base, bool)
    if len(target):
        size = np.bincount(kind)
        twice[target[size[kind] > 1]] = True
    return [twice[at:at + n - SIZE + 1] for at, n in where]


def _ranges(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(mask.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _bucket(table: pa.Table) -> pa.Table:
    """k1, k2, low, high: windows of a bucket's single contexts that don't repeat."""
    anchor, n, start = (table.column(c).to_numpy() for c in ("anchor", "n", "start"))
    context, k1, k2 = (table.column(c).to_pylist() for c in ("context", "k1", "k2"))
    order = np.argsort(anchor, kind="stable")
    cuts = np.flatnonzero(np.diff(anchor[order], prepend=anchor[order[0]] - 1))
    sizes = np.diff(cuts, append=len(order))
    least = np.minimum.reduceat(n[order], cuts)
    open_ = order[np.repeat((sizes > 1) & (least == 1), sizes)]
    masks = dict(zip(open_.tolist(), repeated_starts([context[i] for i in open_]))) if len(open_) else {}
    keys, low, high = ([], []), [], []
    for i in np.flatnonzero(n == 1).tolist():
        mask = masks.get(i)
        a, b = _ranges(~mask) if mask is not None else ([0], [len(context[i]) - SIZE + 1])
        for own, k in zip(keys, (k1[i], k2[i])):
            own += [k] * len(a)
        low += [start[i] + x for x in a]
        high += [start[i] + x for x in b]
    return pa.table({"k1": pa.array(keys[0], pa.int64()), "k2": pa.array(keys[1], pa.int64()), "low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64())})


# ---- the whole table ---------------------------------------------------------

class RepeatedBytes:
    """The sketch of a table of documents and the ranges of windows that don't repeat."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot_bytes: int = HOT_BYTES):
        use_small_batches(docs.sparkSession)
        self.hot_bytes = hot_bytes
        self.rows = docs.select(*[k.alias(n) for k, n in zip(row_keys(doc_id, text), ("k1", "k2"))], F.col(doc_id).cast("long").alias("doc_id"),
                                F.col(text).alias("text"))

        def strings(cols):
            found = [np.empty(0, np.uint64)]
            for _, s in runs(cols["text"]):
                found += s.sides()[2:]
            return np.concatenate(found)

        sketch = repeat_sketch.build(self.rows.select("text"), strings, repeat_sketch.slots_for(docs, 0.25))
        self.sketch = docs.sparkSession.sparkContext.broadcast(sketch)

    def contexts(self) -> DataFrame:
        """anchor, context, n, k1, k2, start: different contexts, as far as their windows may repeat."""
        shared = self.sketch

        def run(cols):
            k1, k2 = (cols[k].to_numpy() for k in ("k1", "k2"))
            out = {"anchor": [], "context": [], "k1": [], "k2": [], "start": []}
            for i, s in runs(cols["text"]):
                low, high = possible(shared.value, s)
                again = np.flatnonzero(high > low)
                out["anchor"].append(s.anchor[again].view(np.int64))
                out["context"] += [s.part[a:b + SIZE - 1] for a, b in zip(low[again].tolist(), high[again].tolist())]
                out["k1"].append(np.full(len(again), k1[i]))
                out["k2"].append(np.full(len(again), k2[i]))
                out["start"].append(s.at + low[again])
                if sum(map(len, out["start"])) > 1 << 15:
                    yield _flat(out)
                    out = {k: [] for k in out}
            yield _flat(out)

        return map_batches(self.rows.select("k1", "k2", "text"), run, "anchor long, context binary, k1 long, k2 long, start long") \
            .groupBy("anchor", "context").agg(F.count("*").alias("n"), *_first())

    def single_windows(self) -> DataFrame:
        """k1, k2 and the ranges (of window starts in the document) that were estimated to repeat and don't."""
        found = stage(self.contexts(), "contexts")
        by_anchor = found.groupBy("anchor").agg(F.sum(F.octet_length("context")).alias("size"))
        total = by_anchor.agg(F.sum("size")).first()[0] or 0
        hot = stage(by_anchor.where(F.col("size") > self.hot_bytes).select("anchor"), "hot-anchors")
        buckets = max(1, -(-total // BUCKET_BYTES))
        usual = found.join(hot, "anchor", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))) \
            .groupBy("bucket").applyInArrow(_bucket, "k1 long, k2 long, low long, high long")
        return usual.unionAll(self._hot(found.join(hot, "anchor", "left_semi"))) \
            .groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "high")).alias("single"))

    @staticmethod
    def _hot(contexts: DataFrame) -> DataFrame:
        def windows(cols):
            for context, n, k1, k2, start in zip(*[cols[c].to_pylist() for c in ("context", "n", "k1", "k2", "start")]):
                items = _BYTE[np.frombuffer(context, np.uint8)]
                m = len(items) - SIZE + 1
                yield {"h1": window_hashes(items, SIZE).view(np.int64), "h2": window_hashes(items, SIZE, 1).view(np.int64),
                       "n": np.full(m, n), "k1": np.full(m, k1), "k2": np.full(m, k2), "start": start + np.arange(m)}

        return map_batches(contexts, windows, "h1 long, h2 long, n long, k1 long, k2 long, start long") \
            .groupBy("h1", "h2").agg(F.sum("n").alias("n"), *_first()) \
            .where("n = 1").select("k1", "k2", F.col("start").alias("low"), (F.col("start") + 1).alias("high"))

    def kept(self, what, schema: str) -> DataFrame:
        """``what(cols, masks)`` for each batch; masks mark the removed bytes of each text."""
        shared = self.sketch

        def run(cols):
            masks = [np.zeros(len(t or b""), bool) for t in cols["text"]]
            alarms = cols["single"].to_pylist()
            for i, s in runs(cols["text"]):
                low, high = possible(shared.value, s)
                edge = np.zeros(s.end[-1] + 1, np.int32)        # runs don't overlap
                edge[:] = np.bincount(low[high > low], minlength=len(edge)) - np.bincount(high[high > low], minlength=len(edge))
                starts = np.cumsum(edge[:-1]) > 0
                for x in alarms[i] or ():
                    starts[max(0, x["low"] - s.at):max(0, x["high"] - s.at)] = False
                masks[i][s.at:s.at + len(s.part)] |= covered(np.flatnonzero(starts), SIZE, len(s.part))
            yield what(cols, masks)

        return map_batches(self.rows.join(self.single_windows(), ["k1", "k2"], "left").select("doc_id", "text", "single"), run, schema)


def _first() -> list:
    """The row's own key and place, where a group has one row."""
    return [F.min(c).alias(c) for c in ("k1", "k2", "start")]


def _flat(out: dict) -> dict:
    join = lambda xs: np.concatenate([np.empty(0, np.int64), *xs])
    return {"anchor": join(out["anchor"]), "context": pa.array(out["context"], pa.binary()),
            **{k: join(out[k]) for k in ("k1", "k2", "start")}}


def digests(found: RepeatedBytes) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    def run(cols, masks):
        texts = [t or b"" for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "n_bytes": [len(t) for t in texts], "n_removed": [int(m.sum()) for m in masks],
                "n_spans": [len(_ranges(m)[0]) for m in masks],
                "kept_sha256": [hashlib.sha256(np.frombuffer(t, np.uint8)[~m].tobytes()).hexdigest() for t, m in zip(texts, masks)]}

    return found.kept(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def spans(found: RepeatedBytes) -> DataFrame:
    """doc_id and the removed byte ranges [low, high)."""
    def run(cols, masks):
        cut = [_ranges(m) for m in masks]
        return {"doc_id": cols["doc_id"], "spans": pa.array([[{"low": int(a), "high": int(b)} for a, b in zip(*x)] for x in cut],
                                                            pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])))}

    return found.kept(run, "doc_id long, spans array<struct<low: bigint, high: bigint>>")


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return digests(RepeatedBytes(spark.read.parquet(f"{sf_dir}/documents.parquet")))
