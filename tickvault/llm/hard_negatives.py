"""Hard negatives by threshold joins over an inverted index with norm bounds.

Vectors of integers are dealt by hash into shards of some thousand rows, anchors into
groups of some hundred; a group and a shard meet in one task.  Such a task looks for each
anchor's best rows inside a window of scores:

* the shard's inverted index lists, dimension by dimension, only rows whose remaining
  dimensions could still reach the threshold: a row's dimensions from the first one at which
  its suffix norm times the anchors' largest suffix norm stays below are left out;
* partial scores are added up along the lists, and rows that can't reach any anchor's
  threshold with the norms that remain are dropped on the way;
* what is left is scored exactly on all dimensions;
* thresholds start high in the window and are lowered, with a new index, until it holds
  enough rows or its lower end is reached.

Shards are searched in rounds, each of ``GROWTH`` times as many shards as all before: the
k-th best score so far is a threshold that the later shards needn't go below, so the rows
that leave a round stay in proportion to the anchors.  Every anchor is still held against
every row, none is sampled.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component,
take no part; vectors of unequal length count as padded with zeros; repeated rows are rows
of their own, as candidates and as anchors, but a row with the anchor's id is never its
positive; ties go to the smaller id; a score must fit 64 bits, or the task fails; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickvault.llm.common import stage

SHARD_ROWS = 8192
GROUP_ROWS = 512
GROWTH = 8
CHUNK = 8                     # dimensions added to the partial scores at a time
STEPS = (0.25, 0.5, 0.75, 1.0)  # parts of a window that the threshold goes down
VERIFY = 20_000               # pairs scored exactly at a time
FOUND = "anchor_id long, anchor_key long, win int, vec_id long, score long"
_FOUND = pa.schema([("anchor_id", pa.int64()), ("anchor_key", pa.int64()), ("win", pa.int32()), ("vec_id", pa.int64()),
                    ("score", pa.int64())])


def usable(vectors: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, label, v (array of long) and copies of every row that takes part."""
    x = F.col(vector)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & finite)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                       F.transform(x, lambda e: F.floor(scale * e.cast("double"))).alias("v")) \
        .groupBy("vec_id", "label", "v").agg(F.count("*").alias("copies"))


# ---- in a task ---------------------------------------------------------------

def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = lists.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = flat
    return out


def _width(lists: pa.ChunkedArray) -> int:
    import pyarrow.compute as pc

    return pc.max(pc.list_value_length(lists)).as_py() or 0


def _suffix_norms(x: np.ndarray) -> np.ndarray:
    """Norm of the components from every chunk border on; the last column is 0."""
    squares = np.square(x).reshape(len(x), -1, CHUNK).sum(axis=2)
    return np.sqrt(np.concatenate([np.cumsum(squares[:, ::-1], axis=1)[:, ::-1], np.zeros((len(x), 1))], axis=1))


class Shard:
    """Rows of a shard, dimensions in the order of falling weight."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, whole: np.ndarray, copies: np.ndarray):
        self.ids, self.labels, self.whole, self.copies = ids, labels, whole, copies
        self.order = np.argsort(-np.square(whole.astype(np.float64)).sum(axis=0), kind="stable")
        self.x = whole[:, self.order].astype(np.float64)
        self.norms = _suffix_norms(self.x)

    def pairs(self, q: np.ndarray, q_whole: np.ndarray, q_norms: np.ndarray, limit: np.ndarray,
              allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all allowed pairs whose score reaches the anchor's limit."""
        slack = 1 + 1e-9 * q_norms[:, 0] * self.norms[:, 0].max(initial=0)
        low = limit - slack
        # Left out from `depth` on: what lies beyond can't reach the lowest threshold alone.
        short = self.norms * q_norms.max(axis=0) < low.min()
        depth = np.where(short.any(axis=1), short.argmax(axis=1), short.shape[1] - 1)
        row = np.flatnonzero((depth > 0) & allowed.any(axis=0))
        row = row[np.argsort(-depth[row], kind="stable")]
        partial = np.zeros((len(q), len(row)))
        for c in range(int(depth[row].max(initial=0))):
            n = int(np.searchsorted(-depth[row], -c))          # rows listed in this chunk's dimensions
            part = slice(c * CHUNK, (c + 1) * CHUNK)
            partial[:, :n] += q[:, part] @ self.x[row[:n], part].T
            if c % 2:
                seen = np.minimum(c + 1, depth[row])
                able = (partial + q_norms[:, seen] * self.norms[row, seen] >= low[:, None]).any(axis=0)
                if able.mean() < 0.7:
                    row, partial = row[able], partial[:, able]
                    if not len(row):
                        break
        seen = depth[row]
        a, b = np.nonzero((partial + q_norms[:, seen] * self.norms[row, seen] >= low[:, None]) & allowed[:, row])
        b = row[b]
        score = exact_scores(q_whole, self.whole, a, b)
        keep = score >= limit[a]
        return a[keep], b[keep], score[keep]


def exact_scores(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of x[a] and y[b], in Python's integers where 64 bits might not do."""
    most = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(np.abs(y.astype(np.float64)).max(initial=0)) * max(x.shape[1], 1)
    out = np.empty(len(a), np.int64)
    for k in range(0, len(a), VERIFY):
        part = slice(k, k + VERIFY)
        if most < 2 ** 62:
            out[part] = np.einsum("ij,ij->i", x[a[part]], y[b[part]])
        else:
            out[part] = [int(np.dot(x[i].astype(object), y[j].astype(object))) for i, j in zip(a[part], b[part])]
    return out


def best_in_windows(shard: Shard, q_whole: np.ndarray, allowed: np.ndarray, windows: np.ndarray, k: int) -> list[tuple]:
    """First k rows of each window as (window, row, score); windows: (anchor, lower end, upper end, known).

    ``known`` marks a lower end that k rows are known to reach; its threshold starts there.
    """
    q = q_whole[:, shard.order].astype(np.float64)
    norms = _suffix_norms(q)
    bound = np.ceil(norms[:, 0] * shard.norms[:, 0].max(initial=0)) + 1
    owner = windows["anchor"]
    top = np.minimum(windows["high"].astype(np.float64), bound[owner])
    end = np.maximum(windows["low"].astype(np.float64), -bound[owner])
    open_, out = np.flatnonzero(top >= end), []
    for step in STEPS:
        if not len(open_):
            break
        now = np.where(windows["known"][open_] | (step == STEPS[-1]), end[open_], top[open_] - (top[open_] - end[open_]) * step)
        limit = np.full(len(q), np.inf)
        np.minimum.at(limit, owner[open_], now)
        use = np.flatnonzero(limit < np.inf)
        a, b, score = shard.pairs(q[use], q_whole[use], norms[use], np.ceil(limit[use]), allowed[use])
        rank = np.lexsort((shard.ids[b], -score, a))
        a, b, score = use[a[rank]], b[rank], score[rank]
        first, last = np.searchsorted(a, np.arange(len(q))), np.searchsorted(a, np.arange(len(q)), "right")
        left = []
        for w, t in zip(open_.tolist(), now.tolist()):
            lo, hi = first[owner[w]], last[owner[w]]
            own = score[lo:hi]
            inside = lo + np.flatnonzero((own <= windows["high"][w]) & (own >= t))[:k]
            many = shard.copies[b[inside]].sum() >= k
            if many or t == end[w]:
                taken = 0
                for i in inside.tolist():
                    for _ in range(min(int(shard.copies[b[i]]), k - taken)):
                        out.append((w, b[i], score[i]))
                        taken += 1
            else:
                left.append(w)
        open_ = np.array(left, np.int64)
    return out


def _search(same_label: bool, k: int):
    def task(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return _FOUND.empty_table()
        asks = pa.Table.from_struct_array(asked["asks"].combine_chunks().flatten())
        width = -(-max(_width(rows["v"]), _width(asks["v"]), 1) // CHUNK) * CHUNK
        shard = Shard(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["v"], width), rows["copies"].to_numpy())
        ids, keys = asks["vec_id"].to_numpy(), asks["anchor_key"].to_numpy()
        allowed = asks["label"].to_numpy()[:, None] == shard.labels
        allowed = allowed & (ids[:, None] != shard.ids) if same_label else ~allowed
        kind = [("anchor", np.int64), ("win", np.int32), ("low", np.int64), ("high", np.int64), ("known", bool)]
        windows = np.array([(i, w["win"], w["low"], w["high"], w["known"]) for i, ws in enumerate(asks["windows"].to_pylist()) for w in ws], kind)
        out = best_in_windows(shard, _matrix(asks["v"], width), allowed, windows, k)
        at = np.array([w for w, _, _ in out], np.int64)
        row = np.array([r for _, r, _ in out], np.int64)
        anchor = windows["anchor"][at]
        return pa.Table.from_arrays([pa.array(ids[anchor]), pa.array(keys[anchor]), pa.array(windows["win"][at]), pa.array(shard.ids[row]),
                                     pa.array([int(s) for _, _, s in out], pa.int64())], schema=_FOUND)

    return task


# ---- on Spark ----------------------------------------------------------------

def _rounds(shards: int) -> list[tuple[int, int]]:
    out, at = [], 0
    while at < shards:
        size = max(1, at * (GROWTH - 1))
        out.append((at, min(shards, at + size)))
        at += size
    return out


def best_rows(rows: DataFrame, n_rows: int, asks: DataFrame, n_anchors: int, same_label: bool, k: int,
              shard_rows: int = SHARD_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """First k rows of each window: anchor_id, anchor_key, win, vec_id, score, place.

    ``asks`` has vec_id, anchor_key, label, v and ``windows`` (win, low, high, known).
    """
    shards, groups = -(-max(n_rows, 1) // shard_rows), -(-max(n_anchors, 1) // group_rows)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "label", "v", F.lit("shard")), F.lit(shards)).cast("int"))
    every = dealt.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    order = Window.partitionBy("anchor_id", "anchor_key", "win").orderBy(F.desc("score"), "vec_id")
    best = None
    for start, end in _rounds(shards):
        now = asks
        if best is not None:
            floors = best.where(F.col("place") == k).groupBy("anchor_id", "anchor_key").agg(F.map_from_entries(
                F.collect_list(F.struct("win", "score"))).alias("floors")).withColumnRenamed("anchor_id", "vec_id")
            now = asks.join(floors, ["vec_id", "anchor_key"], "left").withColumn("windows", F.expr(
                "transform(windows, w -> named_struct('win', w.win, 'low', coalesce(greatest(w.low, floors[w.win]), w.low), "
                "'high', w.high, 'known', floors[w.win] is not null))"))
        packed = now.withColumn("grp", F.pmod(F.xxhash64("vec_id", "anchor_key", F.lit("group")), F.lit(groups)).cast("int")) \
            .groupBy("grp").agg(F.collect_list(F.struct("vec_id", "anchor_key", "label", "v", "windows")).alias("asks")) \
            .withColumn("shard", F.explode(F.sequence(F.lit(start), F.lit(end - 1))))
        part = every.where((F.col("shard") >= start) & (F.col("shard") < end))
        found = part.groupBy("shard", "grp").cogroup(packed.groupBy("shard", "grp")).applyInArrow(_search(same_label, k), FOUND)
        if best is not None:
            found = found.unionByName(best.drop("place"))
        best = stage(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k), "best-rows")
    return best


def mine(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         shard_rows: int = SHARD_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` comes from ``usable``.  Anchors are rows whose id ``every`` divides.  Negatives of a
    positive score between ``low`` and ``high`` per cent of its score.
    """
    rows = stage(rows, "vectors")
    n_rows = rows.count()
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("anchor_key", F.xxhash64("label", "v"))
    n_anchors = anchors.count()

    def asks(windows) -> DataFrame:
        return anchors.join(windows, (F.col("vec_id") == F.col("anchor_id")) & (F.col("anchor_key") == F.col("own_key"))) \
            .select("vec_id", "anchor_key", "label", "v", "windows")

    whole = F.expr(f"array(named_struct('win', 0, 'low', {-2 ** 63 + 1}L, 'high', {2 ** 63 - 1}L, 'known', false))")
    same = best_rows(rows, n_rows, anchors.select("vec_id", "anchor_key", "label", "v", whole.alias("windows")), n_anchors,
                     True, positives, shard_rows, group_rows)
    same = same.select("anchor_id", F.col("anchor_key").alias("own_key"), F.col("place").alias("win"),
                       F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    share = lambda percent: f"cast({percent} * cast(positive_score as decimal(30)) as decimal(38))"
    bounds = same.withColumn("high", F.expr(f"({share(high)} - pmod({share(high)}, 100)) div 100")) \
        .withColumn("low", F.expr(f"-(({share(-low)} - pmod({share(-low)}, 100)) div 100)")).where("low <= high")
    windows = bounds.groupBy("anchor_id", "own_key").agg(F.collect_list(
        F.expr("named_struct('win', win, 'low', low, 'high', high, 'known', false)")).alias("windows"))
    other = best_rows(rows, n_rows, asks(windows), n_anchors, False, negatives, shard_rows, group_rows)
    copies = anchors.select(F.col("vec_id").alias("anchor_id"), F.col("anchor_key").alias("own_key"), "copies")
    return other.select("anchor_id", F.col("anchor_key").alias("own_key"), "win", F.col("place").alias("rank"),
                        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")) \
        .join(same, ["anchor_id", "own_key", "win"]).join(copies, ["anchor_id", "own_key"]) \
        .withColumn("copy", F.explode(F.expr("sequence(1, copies)"))) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(usable(vectors.withColumn("label", moved)))


OP11_SQL = """
with rows_ as (
  select row_number() over () as rid, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)),
same as (
  select a.rid, a.vec_id as anchor_id, a.label, a.v, x.vec_id as positive_id,
         list_inner_product(a.v, x.v)::bigint as positive_score,
         row_number() over (partition by a.rid order by list_inner_product(a.v, x.v) desc, x.vec_id) as place
  from rows_ a join rows_ x on x.label = a.label and x.vec_id <> a.vec_id where a.vec_id % 100 = 0
  qualify place <= 5),
other as (
  select a.rid, x.vec_id as negative_id, list_inner_product(a.v, x.v)::bigint as negative_score
  from rows_ a join rows_ x on x.label <> a.label where a.vec_id % 100 = 0)
select s.anchor_id, s.positive_id,
       row_number() over (partition by s.rid, s.place order by o.negative_score desc, o.negative_id)::int as rank,
       o.negative_id, s.positive_score, o.negative_score
from same s join other o on o.rid = s.rid
 and 30 * s.positive_score <= 100 * o.negative_score and 100 * o.negative_score <= 90 * s.positive_score
qualify rank <= 10
"""
