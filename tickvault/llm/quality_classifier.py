"""Quality classifier: Bradley-Terry ranking learnt from preference pairs.

Pairs of a preferred (label 1) and another document (label 0) are drawn from a bounded
sample of labelled rows (``max_labelled``); the weights minimise the logistic loss of
the pair's difference in features, so a document's score is its Bradley-Terry strength.
Features are shares and averages of the text's shape, and the frequencies of its words and
of its three-byte sequences, hashed into ``HASHED`` buckets each.
The cut is a quantile of the sample's scores: as large a share lies above it as is
labelled 1.  Scores of whole texts come from Arrow batches in Spark tasks; only sampled
rows' features (``len(NAMES) + 2 * HASHED`` single-precision numbers each, 22 MB for the
largest sample) reach the driver.

Defined cases: null or empty text has all features 0 and is scored like any other;
without labels of both kinds every score is 0.5 (so predicted 1); null labels and ids
are not learnt from; repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import WORD_SPACE, held_out, learnable, map_batches, use_small_batches, word_hashes

LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
MARKS = [b"#*$%&", b"|", b"!?", b".,;:", b"<>{}[]()=/\\_~^@", b"\"'`-+"]
NAMES = ["words", "word_len", "letters", "upper", "digits", *[f"mark{i}" for i in range(len(MARKS))],
         "distinct", "line_words", "dup_lines"]
HASHED = 128
SLICE = 1 << 20         # bytes of a text hashed at a time


def _share(t: bytes, chars: bytes) -> float:
    return (len(t) - len(t.translate(None, chars))) / max(1, len(t))


def shape(text: bytes | None) -> list[float]:
    """Shares and averages of one text; long texts differ from short ones only in ``words``."""
    t = text or b""
    words = t.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    bare = t.translate(None, WORD_SPACE)
    lines = [x for x in t.split(b"\n") if x.strip(WORD_SPACE)]
    return [math.log1p(n) / 10, len(bare) / n / 10, _share(bare, LETTERS), _share(bare, UPPER), _share(bare, DIGITS),
            *[10 * _share(bare, m) for m in MARKS], len(set(words)) / n, math.log1p(n / len(lines)) / 5,
            1 - len(set(lines)) / len(lines)]


def frequencies(text: bytes | None) -> np.ndarray:
    """Square roots of the shares of hashed words, and of hashed three-byte sequences of the lower-cased text."""
    t = (text or b"").lower()
    words, _ = word_hashes([t])
    by_word = np.bincount((words & np.uint64(HASHED - 1)).astype(np.int64), minlength=HASHED).astype(float)
    by_bytes = np.zeros(HASHED)
    for at in range(0, max(0, len(t) - 2), SLICE):
        b = np.frombuffer(t[at:at + SLICE + 2], np.uint8).astype(np.uint32)
        code = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761)
        by_bytes += np.bincount((code >> np.uint32(25)).astype(np.int64), minlength=HASHED)
    return np.sqrt(np.concatenate([x / max(1.0, x.sum()) for x in (by_word, by_bytes)]))


def features(texts: list[bytes | None]) -> np.ndarray:
    """A row for each text: its shape and its hashed frequencies."""
    if not texts:
        return np.empty((0, len(NAMES) + 2 * HASHED), np.float32)
    return np.array([np.concatenate([shape(t), frequencies(t)]) for t in texts], np.float32)


def fit(x: np.ndarray, y: np.ndarray, pairs: int = 20_000, l2: float = 1e-3, seed: int = 7) -> dict:
    """Weights by Newton steps on the pairs' logistic loss; the cut by score quantile."""
    if not len(y) or y.min() == y.max():
        return {"w": None}
    mean, spread = x.mean(axis=0, dtype=float), x.std(axis=0, dtype=float)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = _extended(x, mean, spread)
    rng = np.random.default_rng(seed)
    d = z[rng.choice(np.flatnonzero(y == 1), pairs)] - z[rng.choice(np.flatnonzero(y == 0), pairs)]
    w = bradley_terry(d, l2)
    s = z @ w
    return {"mean": mean, "spread": spread, "w": w, "cut": float(np.quantile(s, 1 - y.mean())), "scale": float(s.std()) or 1.0}


def bradley_terry(d: np.ndarray, l2: float) -> np.ndarray:
    """Weights w with the least mean of log(1 + exp(-d w)) + l2 / 2 |w|^2: preferred less other feature rows ``d``."""
    w = np.zeros(d.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        grad = -(d * (1 - p)[:, None]).mean(axis=0) + l2 * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _extended(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Standardised features, and the squares of the shape's."""
    z = np.clip((x - mean) / spread, -6, 6)
    own = z[:, :len(NAMES)]
    return np.concatenate([own, own * own / 6, z[:, len(NAMES):] / 4], axis=1)


def score_texts(texts: list[bytes | None], model: dict) -> np.ndarray:
    if model["w"] is None:
        return np.full(len(texts), 0.5)
    s = _extended(features(texts), model["mean"], model["spread"]) @ model["w"]
    return 1 / (1 + np.exp(-np.clip(4 * (s - model["cut"]) / model["scale"], -500, 500)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = 20_000,
          doc_id: str = "doc_id", text: str = "text") -> dict:
    """Model from at most ``max_labelled`` labelled rows, chosen by a hash of their id."""
    use_small_batches(docs.sparkSession)
    sample = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()) \
        .select(F.col(doc_id).cast("long").alias("_id"), F.col(label).cast("int").alias("_y")) \
        .dropDuplicates(["_id"]).orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text")) \
        .join(F.broadcast(sample), "_id")      # at most max_labelled rows of two numbers

    def measure(cols):
        yield {"id": cols["_id"], "y": cols["_y"], "x": [r.tobytes() for r in features(cols["_text"])]}

    got = map_batches(rows, measure, "id long, y int, x binary").orderBy("id", "x").toArrow()
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, len(NAMES) + 2 * HASHED)
    return fit(x, got.column("y").to_numpy().astype(float))


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score and predicted of every row."""
    spark = docs.sparkSession
    use_small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(cols):
        s = score_texts(cols["_text"], shared.value)
        yield {"doc_id": cols["doc_id"], "score": s, "predicted": (s >= 0.5).astype(np.int32)}

    return map_batches(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text")), run,
                       "doc_id long, score double, predicted int")


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(learnable())
    return score(docs, train(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
