"""Hard negatives against a plain scan of all pairs."""

import math
import random

import numpy as np
import pytest

from tickvault.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score long, win int, grp int, shard int, copies int"


def contract(rows, every=100, positives=5, negatives=10, low=30, high=90):
    use = []
    for vec_id, x, label in rows:
        if vec_id is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        use.append((vec_id, [math.floor(256 * float(np.float32(c))) for c in x], label))
    dot = lambda x, y: sum(p * q for p, q in zip(x, y))
    out = []
    for a, v, label in use:
        if a % every:
            continue
        scored = [(-dot(v, y), b, other) for b, y, other in use]
        same = sorted((s, b) for s, b, other in scored if other == label and b != a)[:positives]
        for ps, p in same:
            inside = sorted((s, b) for s, b, other in scored if other != label and low * -ps <= 100 * -s <= high * -ps)[:negatives]
            out += [(a, p, i + 1, b, -ps, -s) for i, (s, b) in enumerate(inside)]
    return sorted(out)


def vectors(seed=2, n=700, d=20):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    rows = []
    for k in range(n):
        c = centres[k % 6]
        x = [0.5 * c[i] + rng.gauss(0, 0.6) for i in range(d)]
        size = math.sqrt(sum(e * e for e in x))
        rows.append((k * 5, [e / size for e in x], rng.randrange(4)))
    hot = [0.3] * d
    rows += [(10_000 + k, hot, k % 2) for k in range(150)]                  # one vector many times
    rows += [rows[0], rows[0], rows[40], rows[3]]                              # repeated rows, anchors among them
    rows += [(0, rows[9][1], 3), (200, rows[8][1], 1)]                         # one id, other vectors
    rows += [(600, None, 1), (700, [0.1] * d, None), (None, hot, 1), (800, [0.1, None], 2), (900, [float("nan")] * d, 1),
             (1000, [float("inf")] * d, 1), (1100, [], 0), (1200, [0.7, -0.2], 1), (1300, [0.0] * d, 2), (-100, [-e for e in hot], 0),
             (99_900, hot, 77)]                                             # alone with its label
    return rows


def table(spark, rows):
    return spark.createDataFrame([r + (1, 2, 3, 4, 5) for r in rows], SCHEMA).repartition(4)


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def rows():
    return vectors()


def test_against_all_pairs(spark, rows):
    use = hard_negatives.usable(table(spark, rows))
    want = contract(rows)
    assert len(want) > 500
    assert got(hard_negatives.mine(use)) == want
    # Many shards, several rounds, several groups of anchors.
    assert got(hard_negatives.mine(use, shard_rows=60, group_rows=3)) == want


def test_other_bounds(spark, rows):
    use = hard_negatives.usable(table(spark, rows))
    assert got(hard_negatives.mine(use, every=50, positives=2, negatives=40, low=-20, high=100, shard_rows=300)) == \
        contract(rows, 50, 2, 40, -20, 100)


def test_empty(spark):
    assert hard_negatives.mine(hard_negatives.usable(table(spark, []))).count() == 0


def test_index_leaves_dimensions_out_and_loses_no_pair():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 32)) * np.linspace(3, 0.05, 32)
    x = np.floor(256 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    shard = hard_negatives.Shard(np.arange(400), np.zeros(400), x, np.ones(400, np.int64))
    q = x[:30]
    norms = hard_negatives._suffix_norms(q[:, shard.order].astype(np.float64))
    every = np.ones((30, 400), bool)
    scores = q @ x.T
    for limit in (60_000.0, 40_000.0, 0.0, -70_000.0):
        a, b, s = shard.pairs(q[:, shard.order].astype(np.float64), q, norms, np.full(30, limit), every)
        assert set(zip(a.tolist(), b.tolist())) == set(zip(*(i.tolist() for i in np.nonzero(scores >= limit))))
        assert (s == scores[a, b]).all()
    left_out = (shard.norms * norms.max(axis=0) < 40_000).any(axis=1)
    assert left_out.mean() > 0.9


def test_scores_beyond_64_bits_fail():
    big = np.array([[2 ** 40, 2 ** 40]])
    with pytest.raises(OverflowError):
        hard_negatives.exact_scores(big, big, np.array([0]), np.array([0]))
    near = np.array([[2 ** 31, 5]])
    assert hard_negatives.exact_scores(near, near, np.array([0]), np.array([0])).tolist() == [2 ** 62 + 25]


def test_rounds_cover_all_shards():
    for n in (1, 2, 7, 64, 1000):
        assert [k for a, b in hard_negatives._rounds(n) for k in range(a, b)] == list(range(n))
