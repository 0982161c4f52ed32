"""N-gram Jaccard join: classes of documents whose shingle sets overlap by 75 % or more.

A document's set holds its distinct ``SIZE``-word shingles, as 64-bit hashes.  Equal sets
collapse into one class first, so copies are never paired.  Then:

1. Shingles are counted, in shards whose number follows the input (``partners``): documents with
   too few that occur anywhere else can't be linked and are dropped; none that can is.
2. Shingles are ordered by estimated rarity; two linked classes share one of the first
   ``n - ceil(0.75 n) + 1`` of each, so classes meet in the groups of those shingles.
3. A group's hub is the class that shares the largest part of its shingles.  Every class
   is tried against the best hub of its groups, and then against the best one outside the
   hub's component; verified links are turned into components.  That settles large groups
   of near copies with as many pairs as members.
4. Where a group still holds several components, its classes are indexed in a count-vector
   R-tree: shingles are hashed into ``DIMS`` groups, the counts are a point, and the sum of
   coordinate minima bounds the overlap, for a node by its largest counts; so does what
   follows the common shingle in both orders.  Only pairs of different components that the
   bounds can't rule out are verified on the whole sets.
   Groups of more than ``TREE_ROWS`` classes are split into blocks that meet pairwise.

Defined cases: null, empty and blank texts have an empty set and are linked with nothing;
texts of fewer words than a shingle are one shingle; repeated rows are copies; a null id
never is a component's smallest unless all are null; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickvault.llm import partners, repeat_sketch
from tickvault.llm.common import (map_batches, mix, own_names, row_key, signed, stage, stage_measured, use_small_batches,
                                  window_hashes, window_starts, word_hashes)
from tickvault.llm.components import components

SIZE = 5
DIMS, TREE_ROWS, LEAF = 256, 2048, 32
BUCKET_ROWS = 1 << 15           # rows of groups that meet in a task, on average
FULL = np.uint8(255)            # a count that may be larger


def shingle_hashes(texts: list[bytes | None], size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all texts, repeated ones included, and the index of each one's text."""
    items, counts = word_hashes(texts, lower=True)
    starts = window_starts(counts, size)
    owner = np.repeat(np.arange(len(counts)), counts)[starts]
    found = window_hashes(items, size)[starts]
    begin = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        one = [window_hashes(items[begin[i]:begin[i] + counts[i]], int(counts[i]))[0] + np.uint64(counts[i]) for i in short]
        found = np.concatenate([found, mix(np.array(one, np.uint64))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    return found, owner


def shingle_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """key, doc_id, n (set size) and, for documents that may be linked, class; and class, n and shingles
    of the latter, read apart so that the shingles are stored once, by class."""
    spark = docs.sparkSession
    use_small_batches(spark)
    rows = docs.select(row_key(doc_id, text).alias("key"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).alias("text"))

    def sets(texts):
        found, owner = shingle_hashes(texts)
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
        return [np.unique(found[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]

    able = partners.build(rows.select("key", "text"), lambda cols: sets(cols["text"]), repeat_sketch.slots_for(docs, 1 / 64))
    shared = spark.sparkContext.broadcast(able)

    def may_be_linked(cols):
        return repeat_sketch.maybe_repeated(shared.value, partners.key_halves(cols["key"]))

    def name(own):
        return xxhash.xxh3_128_digest(own.tobytes())

    def named(cols):
        found = sets(cols["text"])
        names = [name(own) if linked and len(own) else None for own, linked in zip(found, may_be_linked(cols))]
        yield {"key": cols["key"], "doc_id": cols["doc_id"], "n": [len(own) for own in found], "class": pa.array(names, pa.binary())}

    def stored(cols):
        found = {name(own): own for own in sets([cols["text"][k] for k in np.flatnonzero(may_be_linked(cols))]) if len(own)}
        yield {"class": pa.array(list(found), pa.binary()), "n": [len(own) for own in found.values()],
               "shingles": pa.array([signed(own) for own in found.values()], pa.list_(pa.int64()))}

    return map_batches(rows, named, "key binary, doc_id long, n long, class binary"), \
        map_batches(rows.select("key", "text"), stored, "class binary, n long, shingles array<long>")


def prefixes(classes: DataFrame) -> DataFrame:
    """cid, n, shared (per mille of shingles that may recur), point, and the prefix's shingles
    that may recur, from position ``skip`` of the order on."""
    spark = classes.sparkSession
    rows = classes.select("cid", "shingles")
    flat = lambda cols: cols["shingles"].flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    slots = min(1 << 25, repeat_sketch.slots_for(rows, 0.25))
    shared = spark.sparkContext.broadcast(repeat_sketch.build(rows.select("shingles"), flat, slots, counts=True))

    def run(cols):
        out = {"cid": [], "n": [], "shared": [], "point": [], "skip": [], "prefix": []}
        for cid, one in zip(cols["cid"].to_pylist(), cols["shingles"]):
            own = one.values.to_numpy(zero_copy_only=False).view(np.uint64)
            count, n = repeat_sketch.estimates(shared.value, own), len(own)
            again = int((count > 1).sum())
            if 4 * again < 3 * n:
                continue
            first = np.lexsort((own, count))[:n - -(-3 * n // 4) + 1]
            out["cid"].append(cid)
            out["n"].append(n)
            out["shared"].append(1000 * again // n)
            out["point"].append(np.minimum(np.bincount((mix(own) % np.uint64(DIMS)).astype(np.int64), minlength=DIMS),
                                           FULL).astype(np.uint8).tobytes())
            out["skip"].append(int((count[first] == 1).sum()))
            out["prefix"].append(signed(own[first][count[first] > 1]))
        yield out | {"prefix": pa.array(out["prefix"], pa.list_(pa.int64())), "point": pa.array(out["point"], pa.binary())}

    return map_batches(rows, run, "cid long, n long, shared int, point binary, skip int, prefix array<long>")


class CountTree:
    """R-tree over count vectors, packed by size and then by the most spread coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, reach: np.ndarray):
        wide = np.argsort(-points.astype(np.float64).var(axis=0))[:2]
        slabs = np.argsort(sizes, kind="stable")
        step = max(LEAF, int(np.ceil(len(sizes) / max(1.0, np.sqrt(len(sizes) / LEAF)))))
        order = [s[np.lexsort((points[s, wide[1]], points[s, wide[0]]))] for s in
                 (slabs[i:i + step] for i in range(0, len(slabs), step))]
        self.order = np.concatenate(order)
        self.points, self.sizes, self.reach = points[self.order], sizes[self.order], reach[self.order]
        self.open = (self.points == FULL).any(axis=1)
        self.cuts = np.arange(0, len(sizes), LEAF)
        self.high = np.maximum.reduceat(self.points, self.cuts, axis=0)
        self.node_open = np.maximum.reduceat(self.open, self.cuts)
        self.node_reach = np.maximum.reduceat(self.reach, self.cuts)
        self.least, self.most = np.minimum.reduceat(self.sizes, self.cuts), np.maximum.reduceat(self.sizes, self.cuts)

    def near(self, point: np.ndarray, size: int, reach: int) -> np.ndarray:
        """Indexes of points whose set can overlap by 75 % of the union.

        ``reach``: how much of a set is left from the common shingle on, in the order."""
        open_ = bool((point == FULL).any())     # with a full counter on both sides there is no bound
        nodes = np.flatnonzero((4 * self.most >= 3 * size) & (3 * self.least <= 4 * size) &
                               (7 * np.minimum(self.node_reach, reach) >= 3 * (size + self.least)))
        if len(nodes):
            bound = np.minimum(self.high[nodes], point).sum(axis=1, dtype=np.int64)
            nodes = nodes[(7 * bound >= 3 * (size + self.least[nodes])) | (self.node_open[nodes] & open_)]
        if not len(nodes):
            return nodes
        at = (self.cuts[nodes][:, None] + np.arange(LEAF)).ravel()
        at = at[at < len(self.sizes)]
        own = self.sizes[at]
        at = at[(4 * own >= 3 * size) & (3 * own <= 4 * size) & (7 * np.minimum(self.reach[at], reach) >= 3 * (size + own))]
        bound = np.minimum(self.points[at], point).sum(axis=1, dtype=np.int64)
        return self.order[at[(7 * bound >= 3 * (size + self.sizes[at])) | (self.open[at] & open_)]]


def _tree_pairs(table: pa.Table) -> pa.Table:
    """a, b: pairs of one bucket of groups that the bounds can't rule out."""
    group = np.stack([table.column(c).to_numpy() for c in ("t", "left", "right")], axis=1)
    cid, n, label, side, reach = (table.column(c).to_numpy() for c in ("cid", "n", "label", "side", "reach"))
    points = np.frombuffer(b"".join(table.column("point").to_pylist()), np.uint8).reshape(-1, DIMS)
    order = np.lexsort((group[:, 2], group[:, 1], group[:, 0]))
    ends = np.flatnonzero(np.any(np.diff(group[order], axis=0) != 0, axis=1)) + 1
    a, b = [], []
    for own in np.split(order, ends):
        if not len(own) or (label[own] == label[own[0]]).all():
            continue
        one_block = group[own[0], 1] == group[own[0], 2]
        left, right = (own, own) if one_block else (own[side[own] == 0], own[side[own] == 1])
        if not len(left) or not len(right):
            continue
        tree = CountTree(points[left], n[left], reach[left])
        for i in right:
            near = left[tree.near(points[i], n[i], reach[i])]
            near = near[(label[near] != label[i]) & ((cid[near] < cid[i]) | (not one_block))]
            a.append(cid[near])
            b.append(np.full(len(near), cid[i]))
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})


def verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sets overlap by 75 % of their union."""
    own = classes.select("cid", "n", "shingles")
    left = own.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = own.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b") \
        .where(7 * F.size(F.array_intersect("sa", "sb")) >= 3 * (F.col("na") + F.col("nb"))).select("a", "b")


def _labelled(rows: DataFrame, edges: DataFrame | None) -> DataFrame:
    """``rows`` with their component so far, without groups that are one component."""
    if edges is None:
        rows = rows.withColumn("label", F.col("cid"))
    else:
        rows = rows.join(components(edges), F.col("cid") == F.col("node"), "left") \
            .withColumn("label", F.coalesce("label", "cid")).drop("node")
    return rows


def links(classes: DataFrame) -> DataFrame:
    """a, b: links that make the components of the classes (cid, n, shingles)."""
    heads = stage(prefixes(classes), "jaccard-heads")
    edges = None
    for turn in range(2):
        rows = _labelled(heads.select("cid", "n", "shared", "prefix"), edges) \
            .select("cid", "n", "shared", "label", F.explode("prefix").alias("t"))
        best = F.struct((-F.col("shared")).alias("s"), "cid", "n", "label")
        groups = rows.groupBy("t").agg(F.min(best).alias("hub"), F.min("label").alias("low"), F.max("label").alias("high")) \
            .where("low <> high").select("t", "hub")
        if turn:        # next, the best class outside the first one's component
            groups = rows.join(groups, "t").where(F.col("label") != F.col("hub.label")) \
                .groupBy("t").agg(F.min(best).alias("hub"))
        pairs = rows.join(groups, "t").where(
            (F.col("label") != F.col("hub.label")) & (4 * F.col("n") >= 3 * F.col("hub.n")) & (4 * F.col("hub.n") >= 3 * F.col("n"))) \
            .groupBy("cid").agg(F.min("hub").alias("hub")) \
            .select(F.least("cid", "hub.cid").alias("a"), F.greatest("cid", "hub.cid").alias("b")).distinct()
        found = verified(pairs, classes)
        edges = stage(found if edges is None else edges.unionAll(found), "jaccard-edges")
    # A component that is in no group with another one is settled.
    rows = stage(_labelled(heads, edges).select("cid", "n", "point", "label", "skip", F.posexplode("prefix").alias("at", "t"))
                 .withColumn("reach", F.col("n") - F.col("skip") - F.col("at")).drop("skip", "at"), "jaccard-rows")
    size, made = stage_measured(
        rows.groupBy("t").agg(F.count("*").alias("g"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high").select("t", "g", F.ceil(F.col("g") / TREE_ROWS).cast("int").alias("blocks")),
        "jaccard-groups", rows=F.sum(F.col("g").cast("decimal(38,0)") * F.col("blocks")))
    size = size.drop("g")
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    other = F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")
    rows = rows.join(size, "t").select("t", "cid", "n", "point", "label", "reach", own.alias("own"), other) \
        .select("t", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"),
                (F.col("own") > F.col("other")).cast("int").alias("side"), "cid", "n", "point", "label", "reach")
    buckets = max(64, int(made.get("rows") or 0) // BUCKET_ROWS)
    pairs = rows.withColumn("bucket", F.pmod(F.xxhash64("t", "left", "right"), F.lit(buckets))) \
        .groupBy("bucket").applyInArrow(_tree_pairs, "a long, b long").distinct()
    return edges.unionAll(stage(verified(pairs, classes), "jaccard-edges"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """key, doc_id, n_shingles, component_id and component (null: alone) of every document."""
    sets, shingles = shingle_sets(docs, doc_id, text)
    sets = stage(sets, "jaccard-sets")
    copies = sets.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("least"))
    classes = stage(shingles.groupBy("class")
                    .agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
                    .withColumn("cid", F.monotonically_increasing_id()), "jaccard-classes")     # staged, so the ids stay
    label = components(links(classes)).select("node", "label")
    named = classes.select("class", "cid").join(copies, "class") \
        .join(label, F.col("cid") == F.col("node"), "left").withColumn("label", F.coalesce("label", "cid"))
    named = stage(named.select("class", "label", "least"), "jaccard-named")
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    known = named.join(smallest, "label").select(F.col("class").alias("_class"), "component_id", F.col("label").alias("component"))
    return sets.select("key", "doc_id", "n", "class").join(known, F.col("class") == F.col("_class"), "left") \
        .select("key", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                "component")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the smallest id, nulls last; of rows alike in id
    and text the least by all columns."""
    found = join(docs, doc_id, text).where(F.col("component").isNotNull())
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    first = found.groupBy("component").agg(F.min(rank).alias("r")).select("component", F.col("r.key").alias("first"))
    fate = found.join(first, "component").groupBy("key").agg(F.bool_or(F.col("key") == F.col("first")).alias("stays"))
    rows, inner = own_names(docs)
    place = dict(zip(docs.columns, inner))
    rows = rows.withColumn("at", row_key(place[doc_id], place[text]))
    rows = rows.join(fate, F.col("at") == F.col("key"), "left")
    alone = rows.where(F.col("stays").isNull()).select(*inner)
    same = rows.where("stays").groupBy("at").agg(F.min_by(F.struct(*inner), F.to_json(F.struct(*inner))).alias("r")).select("r.*")
    return alone.unionAll(same).select(*[F.col(k).alias(c) for c, k in place.items()])


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


OP7_SQL = r"""
WITH RECURSIVE toks AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(array_to_string(w, ' '))] ELSE
         list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' ')))) END AS s FROM toks),
classes AS (SELECT min(doc_id) AS c, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
toksets AS (SELECT c, len(s) AS n, unnest(s) AS t FROM classes),
rare AS (SELECT t FROM toksets GROUP BY t HAVING count(*) > 1),
shared AS (SELECT c, n, t FROM toksets SEMI JOIN rare USING (t)),
able AS (SELECT c FROM shared GROUP BY c, n HAVING 4 * count(*) >= 3 * n),
links AS (
  SELECT x.c AS a, y.c AS b FROM shared x JOIN shared y ON x.t = y.t AND x.c < y.c AND 4 * x.n >= 3 * y.n AND 4 * y.n >= 3 * x.n
  WHERE x.c IN (SELECT c FROM able) AND y.c IN (SELECT c FROM able)
  GROUP BY x.c, y.c, x.n, y.n HAVING 7 * count(*) >= 3 * (x.n + y.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(c, r) AS (SELECT c, c FROM classes UNION SELECT reach.c, b FROM reach JOIN both_ways ON reach.r = a),
comp AS (SELECT c, min(r) AS component_id FROM reach GROUP BY c)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes k ON len(d.s) > 0 AND k.s = list_sort(d.s) LEFT JOIN comp m ON m.c = k.c
"""
