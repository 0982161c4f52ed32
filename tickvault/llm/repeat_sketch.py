"""Count-min sketch that answers one question: may this hash occur twice or more?

Counters saturate at 2, so a row of the sketch is a bitmap of the slots that got two
hits.  Every task collects the slots of its own hashes and emits them sorted, by block of
the slot space; a block's partial sketches are merged in one group, whose size is bounded
by the block.  The merged bitmaps have a size fixed beforehand (``slots`` bits for each
row of the sketch, at most ``MAX_SLOTS``) and are broadcast.  An estimate never falls below
the true count, so a hash that does occur twice is always reported; a sketch that is too
small for its input only reports more.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickvault.llm.common import columns, estimated_bytes, mix

MIN_SLOTS, MAX_SLOTS = 1 << 20, 1 << 29
BLOCK = 1 << 20
FLUSH = 1 << 22


def slots_for(docs: DataFrame, per_byte: float) -> int:
    """A power of two: ``per_byte`` slots for each byte of the stored table, within bounds."""
    slots = MIN_SLOTS
    while slots < min(MAX_SLOTS, per_byte * estimated_bytes(docs)):
        slots *= 2
    return slots


def places(hashes: np.ndarray, slots: int, row: int) -> np.ndarray:
    return (mix(hashes + np.uint64(row * 0x632BE59BD9B4E019 & (1 << 64) - 1)) & np.uint64(slots - 1)).astype(np.int64)


def maybe_repeated(sketch: dict, hashes: np.ndarray) -> np.ndarray:
    """False only for hashes that the sketched input holds once at most."""
    out = np.ones(len(hashes), bool)
    for row, bits in enumerate(sketch["rows"]):
        at = places(hashes, sketch["slots"], row)
        out &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return out


def _levels(counts: np.ndarray) -> np.ndarray:
    """Counts up to 127 as they are, larger ones by eighths of their logarithm, in a byte."""
    high = 128 + 8 * np.log2(np.maximum(counts, 128) / 128)
    return np.where(counts < 128, counts, np.minimum(high, 255)).astype(np.uint8)


def estimates(sketch: dict, hashes: np.ndarray) -> np.ndarray:
    """Levels of the counts, never too low, of a sketch built with ``counts``."""
    out = np.full(len(hashes), 255, np.uint8)
    for row, counts in enumerate(sketch["rows"]):
        out = np.minimum(out, counts[places(hashes, sketch["slots"], row)])
    return out


def build(docs: DataFrame, hashes: Callable[[dict], np.ndarray], slots: int, rows: int = 2, counts: bool = False) -> dict:
    """Sketch of all hashes that ``hashes`` returns for the Arrow batches of ``docs``.

    A dict of plain arrays, ready for a broadcast: bitmaps, or with ``counts`` a byte a slot.
    """
    block = min(BLOCK, slots)
    most, width = (2 ** 32 - 1, "<u4") if counts else (2, "u1")

    def partial(batches):
        held: list[np.ndarray] = []

        def emit():
            found = np.concatenate(held)
            held.clear()
            for row in range(rows):
                at, n = np.unique(places(found, slots, row), return_counts=True)
                cuts = np.searchsorted(at, np.arange(0, slots + 1, block))
                full = np.flatnonzero(np.diff(cuts))
                gaps = [np.diff(at[cuts[b]:cuts[b + 1]] % block, prepend=0).astype("<u4").tobytes() for b in full]
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array([row] * len(full), pa.int32()), "block": pa.array(full, pa.int32()),
                    "gaps": pa.array(gaps, pa.binary()),
                    "n": pa.array([np.minimum(n[cuts[b]:cuts[b + 1]], most).astype(width).tobytes() for b in full], pa.binary())})

        for batch in batches:
            held.append(hashes(columns(batch)))
            if sum(map(len, held)) >= FLUSH:
                yield from emit()
        if sum(map(len, held)):
            yield from emit()

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(block, np.int64)
        for gaps, n in zip(table.column("gaps").to_pylist(), table.column("n").to_pylist()):
            at = np.cumsum(np.frombuffer(gaps, "<u4").astype(np.int64))
            total[at] += np.frombuffer(n, width)
        out = _levels(total) if counts else np.packbits(total > 1, bitorder="little")
        return pa.table({"row": table.column("row")[:1], "block": table.column("block")[:1],
                         "data": pa.array([out.tobytes()], pa.binary())})

    merged = docs.mapInArrow(partial, "row int, block int, gaps binary, n binary") \
        .groupBy("row", "block").applyInArrow(merge, "row int, block int, data binary")
    per = 1 if counts else 8
    sketch = {"slots": slots, "rows": [np.zeros(slots // per, np.uint8) for _ in range(rows)]}
    # rows * slots / per bytes in all, a bound fixed beforehand; one partition at a time.
    for r in merged.toLocalIterator():
        data = np.frombuffer(r["data"], np.uint8)
        sketch["rows"][r["row"]][r["block"] * len(data):(r["block"] + 1) * len(data)] = data
    return sketch
