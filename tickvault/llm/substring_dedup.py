"""Removal of repeated word windows: count-min prefilter, then exact groups.

A window is ``size`` consecutive words of one document.  Pass 1 sketches the corpus: every
window is represented by the smallest hash among the ``gram``-word grams inside it, which
equal windows share, so a window's estimate is its gram's and never too low.  Only one
position in about ``(size - gram + 2) / 2`` is such a minimum, and only those are counted.
Pass 2 groups exactly the windows estimated to occur twice, by a 128-bit hash, summed
map-side; those found once are false alarms.  Pass 3 has each document's estimates again,
takes its false alarms off and cuts the words that the remaining windows cover.  All
partial results are rows of Spark tables; only the sketch, of fixed size, is broadcast.

Defined cases: null, empty and shorter texts have no window; overlapping occurrences and
those in one document count; repeated rows are separate occurrences; a null id is an id
like any other; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickvault.llm import repeat_sketch
from tickvault.llm.common import (covered, leftmost_min, map_batches, row_keys, signed, use_small_batches,
                                  window_hashes, window_starts, word_hashes)

WINDOW, GRAM = 35, 18


def _minima(items: np.ndarray, counts: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the position of each window's smallest gram, and all grams' hashes."""
    starts = window_starts(counts, size)
    grams = window_hashes(items, gram)
    if not len(starts):
        return starts, starts, grams
    return starts, leftmost_min(grams, size - gram + 1)[starts], grams


def _estimated(items, counts, sketch, size, gram) -> np.ndarray:
    """Starts of the windows that may occur twice."""
    starts, at, grams = _minima(items, counts, size, gram)
    if not len(starts):
        return starts
    unique, back = np.unique(at, return_inverse=True)
    return starts[repeat_sketch.maybe_repeated(sketch, grams[unique])[back]]


class RepeatedWindows:
    """The sketch of a table of documents, and the false alarms found in it."""

    def __init__(self, docs: DataFrame, size: int = WINDOW, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text"):
        use_small_batches(docs.sparkSession)
        self.size, self.gram = size, gram
        self.rows = docs.select(*[k.alias(n) for k, n in zip(row_keys(doc_id, text), ("k1", "k2"))], F.col(doc_id).cast("long").alias("doc_id"),
                                F.col(text).alias("text"))

        def sampled(cols):
            items, counts = word_hashes(cols["text"])
            _, at, grams = _minima(items, counts, size, gram)
            return grams[np.unique(at)]

        sketch = repeat_sketch.build(self.rows.select("text"), sampled, repeat_sketch.slots_for(docs, 0.25))
        self.sketch = docs.sparkSession.sparkContext.broadcast(sketch)

    def false_alarms(self) -> DataFrame:
        """k1, k2 and the window starts (in the document) that were estimated repeated and aren't."""
        shared, size, gram = self.sketch, self.size, self.gram

        def run(cols):
            items, counts = word_hashes(cols["text"])
            starts = _estimated(items, counts, shared.value, size, gram)
            begin = np.cumsum(counts) - counts
            owner = np.repeat(np.arange(len(counts)), counts)[starts]
            yield {"h1": signed(window_hashes(items, size)[starts]),
                   "h2": signed(window_hashes(items, size, 1)[starts]),
                   **{k: cols[k].take(pa.array(owner)) for k in ("k1", "k2")}, "pos": (starts - begin[owner]).astype(np.int32)}

        found = map_batches(self.rows.select("k1", "k2", "text"), run, "h1 long, h2 long, k1 long, k2 long, pos int")
        first = [F.min(c).alias(c) for c in ("k1", "k2", "pos")]        # one row's, where n is 1
        once = found.groupBy("h1", "h2").agg(F.count("*").alias("n"), *first).where("n = 1")
        return once.groupBy("k1", "k2").agg(F.collect_list("pos").alias("alarms"))

    def kept(self, what, schema: str) -> DataFrame:
        """``what(cols, words, mask, begin)`` for each batch; the mask marks removed words."""
        shared, size, gram = self.sketch, self.size, self.gram

        def run(cols):
            items, counts = word_hashes(cols["text"])
            starts = _estimated(items, counts, shared.value, size, gram)
            begin = np.cumsum(counts) - counts
            alarms = [np.array(x.as_py(), np.int64) + begin[i] for i, x in enumerate(cols["alarms"]) if x.is_valid]
            if alarms:
                starts = np.setdiff1d(starts, np.concatenate(alarms), assume_unique=True)
            yield what(cols, covered(starts, size, len(items)), counts, begin)

        return map_batches(self.rows.join(self.false_alarms(), ["k1", "k2"], "left").select("doc_id", "text", "alarms"), run, schema)


def kept_words(text: bytes | None, mask: np.ndarray) -> bytes:
    words = (text or b"").split()
    return b" ".join([w for w, gone in zip(words, mask) if not gone]) if mask.any() else b" ".join(words)


def digests(found: RepeatedWindows) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    def run(cols, mask, counts, begin):
        own = [mask[b:b + n] for b, n in zip(begin, counts)]
        return {"doc_id": cols["doc_id"], "n_words": counts, "n_removed": [int(m.sum()) for m in own],
                "kept_sha256": [hashlib.sha256(kept_words(t, m)).hexdigest() for t, m in zip(cols["text"], own)]}

    return found.kept(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cleaned(found: RepeatedWindows) -> DataFrame:
    """doc_id and the kept words, joined by one space."""
    def run(cols, mask, counts, begin):
        return {"doc_id": cols["doc_id"], "text": [kept_words(t, mask[b:b + n]).decode("utf-8", "replace")
                                                   for t, b, n in zip(cols["text"], begin, counts)]}

    return found.kept(run, "doc_id long, text string")


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return digests(RepeatedWindows(spark.read.parquet(f"{sf_dir}/documents.parquet")))


OP6_SQL = r"""
WITH toks AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
wins AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS pos, unnest(list_transform(range(1, len(w) - 33),
         lambda i: sha256(array_to_string(w[i:i + 34], ' ')))) AS h
  FROM toks WHERE len(w) >= 35),
twice AS (SELECT h FROM wins GROUP BY h HAVING count(*) > 1),
hit AS (
  SELECT doc_id, list_distinct(flatten(list(range(pos, pos + 35)))) AS gone
  FROM wins JOIN twice USING (h) GROUP BY doc_id),
kept AS (
  SELECT t.doc_id, len(t.w) AS n_words, coalesce(len(h.gone), 0) AS n_removed,
         CASE WHEN h.gone IS NULL THEN t.w ELSE list_transform(list_filter(list_zip(t.w, range(1, len(t.w) + 1)),
              lambda x: NOT list_contains(h.gone, x[2])), lambda x: x[1]) END AS k
  FROM toks t LEFT JOIN hit h ON h.doc_id = t.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(k, ' ')) AS kept_sha256
FROM kept
"""
