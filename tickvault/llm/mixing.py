"""Mixing sources to target weights, with DataFrame operations only.

The words of a source form one stream, documents ordered by a hashed bucket and their id;
the stream is packed into blocks of ``block_words`` words (the last one may be shorter).
The mixture has output shards of about ``shard_slots`` slots.  A shard takes the integer
part of every source's expected slots as it is and draws the rest from a multinomial over
the fractional parts: each shard's counts have the expectation of a plain multinomial
draw with far less variance, so a source's words come near its target even in a small
mixture.  A prefix sum over shards numbers each source's slots; slot j takes index
``j mod blocks`` of pass ``j div blocks``, through a pseudorandom permutation of that
pass, and slots meet their blocks in one join on (source, block).  Slots beyond
``max_epochs`` passes stay empty, so no document is taken more often.

``plain=True`` draws all slots of a shard from the multinomial instead.

No source is gathered in one task: prefix sums run over buckets of some thousand rows and
then over the buckets' totals.  The plan, a row for each source, is made on the driver and
stored as a table; it is broadcast up to ``BROADCAST_SOURCES`` sources and joined beyond.

Defined cases: null and empty texts have size 0 and are never taken; a null source is a
source of its own, last in order; null ids are kept; repeated rows are separate documents;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickvault.llm.common import row_key, stage

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 32
SHARD_SLOTS = 4096
MAX_EPOCHS = 3
BUCKET_ROWS = 4096
PREFIX_GROUP = 1024
BROADCAST_SOURCES = 10_000
BINS = 4096             # parts of the unit interval in which draws look for their source


def targets(sizes: dict, weights: dict, max_epochs: int = MAX_EPOCHS) -> dict:
    """Words to take from each source: shares by weight, at most ``max_epochs`` its size."""
    total, found, free = float(sum(sizes.values())), {}, set(sizes)
    while free:
        left = total - sum(found.values())
        weight = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / weight > max_epochs * sizes[s]}
        if not over:
            return found | {s: left * weights[s] / weight for s in free}
        found |= {s: float(max_epochs * sizes[s]) for s in over}
        free -= over
    return found


def cycled_weights(names: list) -> dict:
    """Weights 1, 2, 3, repeating over the sources by code point, null last."""
    ordered = sorted(names, key=lambda s: (s is None, s or ""))
    return {s: 1 + k % 3 for k, s in enumerate(ordered)}


def _mix_plan(stats: list, weights, block_words: int, shard_slots: int, seed: int, plain: bool = False) -> tuple[list[dict], int]:
    """A row for each source with words, and the number of output shards."""
    sizes = {r["source"]: r["words"] for r in stats}
    goal = targets(sizes, weights(list(sizes)))
    rows = []
    for k, r in enumerate(sorted(stats, key=lambda r: (r["source"] is None, r["source"] or ""))):
        blocks = -(-r["words"] // block_words)
        rng = random.Random(f"{seed}/{k}")
        steps = []
        for _ in range(MAX_EPOCHS):     # index i of a pass is block (a * i + c) mod blocks
            most = max(1, min(blocks, (1 << 62) // max(1, blocks)))
            a = rng.randint(1, most)
            while math.gcd(a, max(1, blocks)) != 1:
                a = a % most + 1
            steps.append({"a": a, "c": rng.randrange(max(1, blocks))})
        rows.append({"k": k, "source": r["source"], "words": r["words"],
                     "buckets": -(-r["docs"] // BUCKET_ROWS), "target": goal[r["source"]], "blocks": blocks,
                     "slots": goal[r["source"]] * blocks / r["words"] if r["words"] else 0.0, "steps": steps})
    slots = sum(r["slots"] for r in rows)
    shards = max(1, math.ceil(slots / shard_slots)) if slots else 0
    low = 0.0
    each = [r["slots"] / shards if shards else 0.0 for r in rows]
    base = [0 if plain else int(x) for x in each]
    rest = sum(x - n for x, n in zip(each, base))
    for r, x, n in zip(rows, each, base):
        r["base"] = n
        r["low"], low = low, low + (x - n) / rest if rest else low
        r["high"] = low
    if rows:
        rows[-1]["high"] = 2.0          # rounding leaves no gap
    return rows, shards


PLAN = ("k int, source string, words long, buckets long, target double, blocks long, slots double, "
        "steps array<struct<a: long, c: long>>, base long, low double, high double")


class Mix:
    """A planned mixture over staged rows; ``blocks`` and ``slots`` meet in ``pieces``."""

    def __init__(self, docs: DataFrame, weights=cycled_weights, with_text: bool = False,
                 block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 1,
                 plain: bool = False, doc_id: str = "doc_id", text: str = "text", source: str = "source"):
        self.length, self.seed, self.with_text = block_words, seed, with_text
        # Only keys and sizes are stored and ordered; texts join their place once it is known.
        key = row_key(doc_id, text).alias("key")
        self.text = docs.select(key, F.col(text).alias("text"))
        key_col = [key] if with_text else []
        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                           F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                           *key_col)
        self.rows = stage(rows, "mix-rows")
        stats = self.rows.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("words")).collect()   # a row a source
        self.plan, self.shards = _mix_plan(stats, weights, block_words, shard_slots, seed, plain)
        names = [f.partition(" ")[0] for f in PLAN.replace("struct<a: long, c: long>", "").split(", ")]
        spark = docs.sparkSession
        self.table = stage(spark.createDataFrame([tuple(r[n] for n in names) for r in self.plan], PLAN), "mix-plan")
        self.placed = self._placed()

    def info(self, *cols) -> DataFrame:
        """Columns of the plan, for a join."""
        own = self.table.select(*cols)
        return F.broadcast(own) if len(self.plan) <= BROADCAST_SOURCES else own

    def _placed(self) -> DataFrame:
        """Rows with their source's number and the offset of their first word in its stream."""
        info = self.info("k", F.col("source").alias("_s"), "buckets")
        tie = ["key"] if self.with_text else []
        rows = self.rows.join(info, F.col("source").eqNullSafe(F.col("_s"))).drop("_s") \
            .withColumn("bucket", F.pmod(F.xxhash64(F.lit(self.seed), "doc_id", "size"), F.col("buckets")))
        ahead = rows.groupBy("k", "bucket").agg(F.sum("size").alias("n"))
        ahead = ahead.select("k", "bucket", (F.sum("n").over(
            Window.partitionBy("k").orderBy("bucket")) - F.col("n")).alias("ahead"))
        inside = F.sum("size").over(Window.partitionBy("k", "bucket").orderBy("doc_id", "size", *tie)
                                    .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
        return rows.withColumn("inside", inside).join(ahead, ["k", "bucket"]) \
            .withColumn("start", F.col("ahead") + F.col("inside")).drop("buckets", "bucket", "inside", "ahead")

    def blocks(self) -> DataFrame:
        """k, block and the piece of each document in it: doc_id, start, first, n (and text)."""
        size, span = F.lit(self.length), F.sequence(
            F.expr(f"start div {self.length}"), F.expr(f"(start + size - 1) div {self.length}"))

        def piece(b: Column) -> Column:
            low = F.greatest(F.col("start"), b * size)
            first, n = low - F.col("start"), F.least(F.col("start") + F.col("size"), (b + 1) * size) - low
            fields = [b.alias("block"), first.alias("first"), n.alias("n")]
            if self.with_text:
                fields.append(F.array_join(F.slice("words", (first + 1).cast("int"), n.cast("int")), " ").alias("text"))
            return F.struct(*fields)

        rows = self.placed.where(F.col("size") > 0)
        if self.with_text:
            # Equal rows have equal texts: one of them for each key.
            rows = rows.join(self.text.dropDuplicates(["key"]), "key").withColumn("words", F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
        return rows.select("k", "doc_id", "start", F.inline(F.transform(span, piece)))

    def counts(self) -> DataFrame:
        """Slots of each source in each output shard, and the source's slots in shards before."""
        spark = self.rows.sparkSession
        rest = sum(r["slots"] for r in self.plan) / max(1, self.shards) - sum(r["base"] for r in self.plan)
        drawn = F.floor((F.col("shard") + 1) * F.lit(rest)) - F.floor(F.col("shard") * F.lit(rest))
        unit = F.pmod(F.xxhash64(F.lit(self.seed), F.col("shard"), F.col("i")), F.lit(1 << 32)) / float(1 << 32)
        draws = spark.range(self.shards).withColumnRenamed("id", "shard").where(drawn > 0) \
            .select("shard", F.explode(F.sequence(F.lit(1), drawn.cast("int"))).alias("i")) \
            .select("shard", unit.alias("u")).withColumn("bin", F.floor(F.col("u") * BINS).cast("int"))
        # A draw's source is the one whose part of the unit interval holds it.
        spans = self.table.where("high > low").select("k", "low", "high", F.explode(F.sequence(
            F.floor(F.col("low") * BINS).cast("int"), F.least(F.floor(F.col("high") * BINS), F.lit(BINS - 1)).cast("int"))).alias("bin"))
        spans = F.broadcast(spans) if len(self.plan) <= BROADCAST_SOURCES else spans
        hit = draws.join(spans, "bin").where((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high"))) \
            .select("shard", "k", F.lit(1).cast("long").alias("n"))
        sure = self.table.where("base > 0").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, self.shards - 1)).cast("long"))).alias("shard"),
                                                   "k", F.col("base").alias("n"))
        own = hit.unionAll(sure).groupBy("shard", "k").agg(F.sum("n").alias("n")).withColumn("part", F.expr(f"shard div {PREFIX_GROUP}"))
        parts = own.groupBy("k", "part").agg(F.sum("n").alias("m"))
        parts = parts.select("k", "part", (F.sum("m").over(Window.partitionBy("k").orderBy("part")) - F.col("m")).alias("ahead"))
        inside = F.sum("n").over(Window.partitionBy("k", "part").orderBy("shard")) - F.col("n")
        return own.withColumn("inside", inside).join(parts, ["k", "part"]) \
            .select("shard", "k", "n", (F.col("ahead") + F.col("inside")).alias("before"))

    def slots(self) -> DataFrame:
        """shard, k, slot (of the source) and the block that the slot takes."""
        info = self.info("k", "blocks", "steps")
        slots = self.counts().where(F.col("n") > 0) \
            .select("shard", "k", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("slot")) \
            .join(info, "k").where(F.col("slot") < F.col("blocks") * MAX_EPOCHS)
        step = F.expr("get(steps, cast(slot div blocks as int))")
        return slots.withColumn("step", step).select("shard", "k", "slot", F.pmod(
            F.col("step.a") * F.expr("slot % blocks") + F.col("step.c"), F.col("blocks")).alias("block"))

    def pieces(self) -> DataFrame:
        """Every piece of every filled slot."""
        # Slots come from a few counts, by which a planner would take them for small: no broadcast.
        return self.slots().hint("merge").join(self.blocks(), ["k", "block"])

    def texts(self) -> DataFrame:
        """shard, source, slot, block, doc_ids, n_words and text of every filled slot."""
        part = F.struct("start", "doc_id", "n", "text")
        whole = self.blocks().groupBy("k", "block").agg(F.array_sort(F.collect_list(part)).alias("p"))  # <= block_words
        whole = whole.select("k", "block", F.col("p.doc_id").alias("doc_ids"), F.array_join("p.text", " ").alias("text"),
                             F.aggregate("p.n", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_words"))
        return self.slots().hint("merge").join(whole, ["k", "block"]).join(self.info("k", "source"), "k") \
            .select("shard", "source", "slot", "block", "doc_ids", "n_words", "text")

    def taken(self) -> DataFrame:
        """Every document with its size, its source's size and target, and the words taken."""
        sums = self.pieces().groupBy("k", "start").agg(F.sum("n").alias("_taken"))
        info = self.info("k", F.col("words").alias("source_size"), "target")
        return self.placed.select("k", "start", "doc_id", "size").join(sums, ["k", "start"], "left").join(info, "k") \
            .select("doc_id", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.coalesce("_taken", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken"))


def op1_source_mixing(spark, sf_dir: str) -> DataFrame:
    return Mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).taken()
