"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every learnable document in Spark tasks; only
class-by-bucket matrices of sums reach the driver and are broadcast, each of at most
``max_matrix_mb``.  Languages beyond what one matrix holds go in further matrices; the
documents are then scored against one after another, with the best language so far stored
in between.  Scoring adds the log probabilities of a text's n-grams with numpy, a bounded
slice at a time.

Defined cases: null text or one without a letter: ``und`` with score 0; no learnable
rows: every text is ``und``; documents with null ``lang`` are not learned from; a null
``doc_id`` is neither held out nor learned from; repeated rows count as often as they
occur; ties go to the first language by code point; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import held_out, learnable, map_batches, mix, stage, use_small_batches

NGRAMS = (1, 2, 3)
BUCKETS = 1 << 16
SLICE = 1 << 16          # characters of a text taken at a time
UNDETERMINED = "und"


def _grams(text: bytes, buckets: int, slice_: int = SLICE) -> Iterator[np.ndarray]:
    """Buckets of the 1- to 3-grams of the lower-cased text, one blank at either end, in slices."""
    chars = np.frombuffer(f" {text.decode('utf-8', 'replace').lower()} ".encode("utf-32-le"), np.uint32)
    for start in range(0, len(chars), slice_):
        part = chars[start:start + slice_ + max(NGRAMS) - 1].astype(np.uint64)
        for n in NGRAMS:
            m = min(slice_, len(part) - n + 1)
            if m > 0:
                code = part[:m] + np.uint64(0)
                for k in range(1, n):
                    code |= part[k:k + m] << np.uint64(21 * k)
                yield (mix(code ^ np.uint64(n * 0x9E3779B97F4A7C1)) & np.uint64(buckets - 1)).astype(np.int64)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS,
          smoothing: float = 0.5, max_matrix_mb: float = 128) -> list[dict]:
    """Matrices of some languages each: languages, log priors and log probabilities (buckets by languages).

    The driver holds a row for each language and one matrix at a time."""
    use_small_batches(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")) \
        .where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        held: dict[str, list[np.ndarray]] = {}

        def add(name):
            found = np.bincount(np.concatenate(held.pop(name)), minlength=buckets)
            sums[name] = sums[name] + found if name in sums else found

        def emit():
            for name in list(held):
                add(name)
            for name, total in sums.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()),
                     pa.array(total[at], pa.int64())], ["lang", "bucket", "n"])
            sums.clear()

        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary()).to_pylist()
            for t, name in zip(texts, batch.column(1).to_pylist()):
                own = held.setdefault(name, [])
                for part in _grams(t, buckets):
                    own.append(part)
                    if len(own) > 512 or len(part) > SLICE // 2:
                        add(name)
                        own = held.setdefault(name, [])
                if not own:
                    del held[name]
            if len(held.keys() | sums.keys()) > 64:         # counters of half a megabyte each
                yield from emit()
        yield from emit()

    sums = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    each = max(1, int(max_matrix_mb * (1 << 20)) // (4 * buckets))
    if len(names) > each:
        sums = stage(sums, "language-sums")
    every = float(sum(sizes.values()))
    models = []
    for k in range(0, len(names), each):
        own = names[k:k + each]
        matrix = np.zeros((buckets, len(own)))
        table = (sums if len(names) <= each else sums.where(F.col("lang").isin(own))).toArrow()
        col = {name: i for i, name in enumerate(own)}
        matrix[table.column("bucket").to_numpy(), np.array([col[x] for x in table.column("lang").to_pylist()], np.int64)] = table.column("n").to_numpy()
        total = matrix.sum(axis=0)
        models.append({"languages": own, "buckets": buckets, "prior": np.log(np.array([sizes[x] for x in own], float) / every),
                       "matrix": np.log((matrix + smoothing) / (total + smoothing * buckets)).astype(np.float32)})
    return models


def log_scores(text: bytes, model: dict) -> np.ndarray:
    """Log probability of the text with each language, up to a constant."""
    logs, matrix = model["prior"].copy(), model["matrix"]
    for part in _grams(text, model["buckets"]):
        logs += matrix[part].sum(axis=0, dtype=np.float64)
    return logs


def predict(docs: DataFrame, models: list[dict], text: str = "text",
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score`` (posterior of that language)."""
    spark = docs.sparkSession
    use_small_batches(spark)
    kept = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept)], F.col(text).alias("_text"),
                       F.lit(UNDETERMINED).alias("lang_pred"), F.lit(None).cast("double").alias("_log"), F.lit(0.0).alias("_sum"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def against(shared, last: bool):
        def score(cols):
            m = shared.value
            langs, logs, sums = [x.decode() for x in cols["lang_pred"]], cols["_log"].to_pylist(), cols["_sum"].to_pylist()
            for i, t in enumerate(cols["_text"]):
                if not t or not any(map(str.isalpha, t.decode("utf-8", "replace"))):
                    continue
                own = log_scores(t, m)
                best = int(np.argmax(own))
                top = own[best] if logs[i] is None else max(logs[i], own[best])
                sums[i] = float(np.exp(own - top).sum()) + (0.0 if logs[i] is None else sums[i] * float(np.exp(logs[i] - top)))
                if logs[i] is None or own[best] > logs[i]:      # ties stay with the language before
                    langs[i] = m["languages"][best]
                logs[i] = float(top)
            out = {**{k: cols.batch.column(k) for k in kept}, "lang_pred": langs}
            if last:
                yield out | {"score": [1.0 / x if x else 0.0 for x in sums]}
            else:
                yield out | {"_text": cols.batch.column("_text"), "_log": logs, "_sum": sums}

        return score

    first = ", ".join(f"{k} {types[k]}" for k in kept)
    for k, model in enumerate(models):
        shared, last = spark.sparkContext.broadcast(model), k + 1 == len(models)
        rows = map_batches(rows, against(shared, last), f"{first}, lang_pred string, " +
                           ("score double" if last else "_text string, _log double, _sum double"))
        if not last:
            rows = stage(rows, "language-scores")
    if not models:
        rows = rows.withColumn("score", F.lit(0.0))
    return rows.select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], "lang_pred", "score")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(learnable()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
