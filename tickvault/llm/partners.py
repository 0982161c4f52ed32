"""Which sets may have a partner that they overlap by 75 % of the union?  No pair is missed.

A set of ``n`` hashes sends all but its ``n // 4`` largest ones.  Of two linked sets the larger one
holds ``n`` hashes and they share ``ceil(3n / 4)`` at least; what either of them leaves out are the
largest of the shared ones, ``n // 4`` at most.  So half of ``n``, and half of the smaller set's
size, is sent by both: a set of whose hashes under ``ceil(n / 2)`` are sent by another one has no
partner.

Nothing here has a size fixed beforehand that a large input could fill.  Tasks send the hashes of
some thousand sets at a time, sorted, in parts by shard of the hash space, about four bytes a
hash.  A shard, of some million hashes, answers which of them came twice; the answers are summed
for each of these batches of sets.  What comes back is a bitmap over the keys of the sets that may
have a partner.  Two hashes in one slot of a shard (a thirtieth of them, at most) count as repeated,
which only lets more sets pass.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickvault.llm import repeat_sketch
from tickvault.llm.common import columns, estimated_bytes, mix

SLOT_BITS, SHARD_HASHES = 27, 1 << 22       # of one shard
MIN_SHARDS, MAX_SHARDS, UNKNOWN = 64, 1 << 16, 1 << 50
FLUSH = 1 << 22
BATCH_SETS = (1 << 16) - 1
NO_ANSWER = np.uint16(BATCH_SETS)           # known to be repeated: a hash that a batch holds twice goes once


def shards_for(docs: DataFrame) -> int:
    """A power of two: shards of about ``SHARD_HASHES`` hashes, one for each four bytes of the stored table."""
    size, shards = estimated_bytes(docs), MIN_SHARDS
    if size > UNKNOWN:                      # a table that isn't stored
        return 512
    while shards < min(MAX_SHARDS, size / 4 / SHARD_HASHES):
        shards *= 2
    return shards


def sent(own: np.ndarray) -> np.ndarray:
    """Of a sorted set, the part that is sent."""
    return own[:len(own) - len(own) // 4]


def _parts(sets: list[np.ndarray], keys: np.ndarray, sizes: list[int], shards: int, name: int) -> dict:
    """One batch of sets as rows: its part for each shard, and the sets themselves."""
    own = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
    places = mix(np.concatenate(sets)) >> np.uint64(64 - SLOT_BITS - (shards.bit_length() - 1))
    order = np.argsort(places)
    places, own = places[order], own[order]
    first = np.ones(len(places), bool)
    first[1:] = places[1:] != places[:-1]
    many = ~first
    many[:-1] |= ~first[1:]
    known = np.bincount(own[many], minlength=len(sets)).astype("<u4")
    own[many] = NO_ANSWER
    places, own = places[first], own[first]
    cuts = np.searchsorted(places, np.arange(shards + 1, dtype=np.uint64) << np.uint64(SLOT_BITS))
    full = np.flatnonzero(np.diff(cuts))
    gaps = [np.diff(places[cuts[s]:cuts[s + 1]] & np.uint64((1 << SLOT_BITS) - 1), prepend=np.uint64(0)).astype("<u4") for s in full]
    return {"shard": pa.array([*full.tolist(), -1 - (name & 0xFFFF)], pa.int32()), "batch": pa.array([name] * (len(full) + 1), pa.int64()),
            "low": pa.array([(g & np.uint32(0xFFFF)).astype("<u2").tobytes() for g in gaps] + [keys.tobytes()], pa.binary()),
            "high": pa.array([(g >> np.uint32(16)).astype("<u2").tobytes() for g in gaps] + [np.array(sizes, "<u4").tobytes()], pa.binary()),
            "own": pa.array([own[cuts[s]:cuts[s + 1]].astype("<u2").tobytes() for s in full] + [known.tobytes()], pa.binary())}


def _answers(table: pa.Table) -> pa.Table:
    """For each batch in a shard the sets of hashes that came twice, one entry for each hash."""
    if table.column("shard")[0].as_py() < 0:            # the sets themselves
        return table.select(["batch", "low", "high", "own"])
    low, high, own = ([np.frombuffer(x, "<u2") for x in table.column(c).to_pylist()] for c in ("low", "high", "own"))
    lengths = [len(x) for x in low]
    places = np.concatenate([np.cumsum(a.astype(np.uint32) | b.astype(np.uint32) << np.uint32(16), dtype=np.uint32)
                             for a, b in zip(low, high)])
    order = np.argsort(places)
    same = places[order][1:] == places[order][:-1]
    again = np.zeros(len(places), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    ends = np.cumsum(lengths)
    told = [o[m & (o != NO_ANSWER)] for o, m in zip(own, np.split(again, ends[:-1]))]
    kept = [k for k, o in enumerate(told) if len(o)]
    none = pa.array([None] * len(kept), pa.binary())
    return pa.table({"batch": table.column("batch").take(pa.array(kept, pa.int64())), "low": none, "high": none,
                     "own": pa.array([told[k].tobytes() for k in kept], pa.binary())})


def _passed(slots: int) -> Callable[[pa.Table], pa.Table]:
    block = min(repeat_sketch.BLOCK, slots)

    def run(table: pa.Table) -> pa.Table:
        keys = sizes = total = None
        told = []
        for low, high, own in zip(*(table.column(c).to_pylist() for c in ("low", "high", "own"))):
            if low is None:
                told.append(np.frombuffer(own, "<u2"))
            else:
                keys, sizes, total = np.frombuffer(low, "<u8"), np.frombuffer(high, "<u4").astype(np.int64), np.frombuffer(own, "<u4").astype(np.int64)
        if keys is None:
            raise RuntimeError("a batch of sets was read in another order when its task ran again")
        if told:
            total = total + np.bincount(np.concatenate(told), minlength=len(keys))
        at = np.unique(repeat_sketch.places(keys[2 * total >= sizes], slots, 0))
        blocks = np.unique(at // block)
        return pa.table({"block": pa.array(blocks, pa.int32()),
                         "at": pa.array([(at[at // block == b] % block).astype("<u4").tobytes() for b in blocks], pa.binary())})

    return run


def build(rows: DataFrame, sets: Callable[[dict], list[np.ndarray]], slots: int) -> dict:
    """Bitmap, in the form of a sketch, over the first halves of the ``key`` of rows that may have a partner.

    ``sets``: the sorted hashes of each row of an Arrow batch of ``rows``.  Rows must come in the same
    order when a task runs again, as those of stored tables do."""
    shards, block = shards_for(rows), min(repeat_sketch.BLOCK, slots)

    def partial(batches):
        held: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        sizes: list[int] = []
        part, done = TaskContext.get().partitionId(), 0

        def emit():
            nonlocal done
            names = np.concatenate(keys)
            name = np.uint64(xxhash.xxh3_64_intdigest(names.tobytes() + f"{part} {done}".encode())).view(np.int64)
            out = _parts(held, names, sizes, shards, int(name))
            done += 1
            for x in (held, keys, sizes):
                x.clear()
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            cols = columns(batch)
            found = sets(cols)
            if held and (sum(map(len, held)) >= FLUSH or len(held) + len(found) > BATCH_SETS):
                yield emit()
            keep = [k for k, own in enumerate(found) if len(own)]
            if keep:
                held += [sent(found[k]) for k in keep]
                sizes += [len(found[k]) for k in keep]
                keys.append(key_halves(cols["key"])[keep])
        if held:
            yield emit()

    def merge(table: pa.Table) -> pa.Table:
        bits = np.zeros(block, bool)
        for at in table.column("at").to_pylist():
            bits[np.frombuffer(at, "<u4")] = True
        return pa.table({"block": table.column("block")[:1], "data": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    merged = rows.mapInArrow(partial, "shard int, batch long, low binary, high binary, own binary") \
        .groupBy("shard").applyInArrow(_answers, "batch long, low binary, high binary, own binary") \
        .groupBy("batch").applyInArrow(_passed(slots), "block int, at binary") \
        .groupBy("block").applyInArrow(merge, "block int, data binary")
    bits = np.zeros(slots // 8, np.uint8)
    for r in merged.toLocalIterator():      # slots / 8 bytes in all, a bound fixed beforehand
        data = np.frombuffer(r["data"], np.uint8)
        bits[r["block"] * len(data):(r["block"] + 1) * len(data)] = data
    return {"slots": slots, "rows": [bits]}


def key_halves(keys: pa.Array) -> np.ndarray:
    """The first eight bytes of 16-byte keys."""
    return np.frombuffer(b"".join(keys.to_pylist()), "<u8").reshape(-1, 2)[:, 0]
