"""Phrase collocations from stripes: each prefix keys a counter of the words that follow it.

A task counts the texts of one language at a time: the empty prefix's stripe holds the
words, a word's stripe the words after it, a pair's stripe the words after the pair, up to
one word less than the longest phrase.  Positions become numbers, so a stripe is a run of a
sorted numpy array.  Stripes travel packed, many to a row: prefixes, stripe lengths, next
words, counts.  A stripe is cut by the hash of its next words into as many segments as there
are buckets, so no bucket holds a hot prefix whole, and the number of buckets follows the
characters of the corpus.  A bucket adds its segments elementwise; a cell of the sum is an
extension with its count.  The cell of a prefix in its own prefix's stripe is that prefix's
total, the sum over the empty prefix's stripe is the number of words, and the largest cells
around a phrase decide whether a longer phrase subsumes it.  All that only concerns phrases
of ``min_count`` or more occurrences, and goes on with Spark's joins and grouped maxima.

Defined cases: null and empty texts have no words; null ``lang`` counts as ``und``; repeated
rows count each time; a piece of a text is never cut, longer texts are counted piecewise;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickvault.llm.common import columns, mix, record_batch, stage, use_small_batches

BREAK = b"\xff"                                     # never a byte of UTF-8
_CLEAN = bytes(255 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
FLUSH_BYTES = 8 << 20           # text counted at a time in a task
BUCKET_CHARS = 4 << 20          # text whose cells meet in a bucket
PACKED = "bucket int, lang string, size int, prefixes binary, lengths binary, nexts binary, counts binary"
_PACKED = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("size", pa.int32()), ("prefixes", pa.binary()),
                     ("lengths", pa.binary()), ("nexts", pa.binary()), ("counts", pa.binary())])
COUNTED = "lang string, size int, phrase string, f long"
_COUNTED = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


class _Numbers(dict):
    """Numbers its keys in the order of their first use."""

    def __missing__(self, key):
        self[key] = made = len(self)
        return made


def _cut(text: bytes, limit: int) -> Iterator[bytes]:
    """Parts of a cleaned text, cut only between pieces."""
    at = 0
    while len(text) - at > limit:
        end = text.rfind(BREAK, at, at + limit)
        if end < 0:
            end = text.find(BREAK, at + limit)
            if end < 0:
                break
        yield text[at:end]
        at = end + 1
    yield text[at:]


def stripes(parts: list[bytes], max_words: int) -> Iterator[tuple]:
    """(size, prefix texts, prefix number of each cell, next words, counts, hashes) by phrase size.

    Cells are sorted by prefix, so each prefix's stripe is one run.
    """
    numbers = _Numbers()
    numbers[BREAK]                                   # 0 ends a piece
    ids = np.concatenate([np.fromiter(map(numbers.__getitem__, (part + BREAK).replace(BREAK, b" \xff ").split()), np.int64)
                          for part in parts])       # only one part's words lie in memory as such
    text = list(numbers)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, text), np.uint64, len(text))
    gram = np.where(ids > 0, 0, -1)                  # number of the prefix that starts here
    prefixes, prefix_hash = [b""], np.zeros(1, np.uint64)
    for size in range(1, max_words + 1):
        follow = ids[size - 1:]
        at = np.flatnonzero((gram[:len(follow)] >= 0) & (follow > 0))
        cells, back, counts = np.unique(gram[at] << 32 | follow[at], return_inverse=True, return_counts=True)
        if not len(cells):
            return
        prefix, following = cells >> 32, cells & 0xFFFFFFFF
        hashes = mix(prefix_hash[prefix] * np.uint64(0x9E3779B97F4A7C15) + hashed[following] + np.uint64(size))
        nexts = [text[k] for k in following.tolist()]
        yield size, prefixes, prefix, nexts, counts, hashes
        if size == max_words:
            return
        prefixes = nexts if size == 1 else [prefixes[p] + b" " + w for p, w in zip(prefix.tolist(), nexts)]
        prefix_hash = hashes
        gram = np.full(len(ids), -1)
        gram[at] = back.reshape(-1)


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest needs; ``_wide`` reads them back."""
    return counts.astype("u1" if counts.max() < 1 << 8 else "<u2" if counts.max() < 1 << 16 else "<u8")


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, {1: "u1", 2: "<u2", 8: "<u8"}[len(data) // n]).astype(np.int64)


def _pack(lang: str, parts: list[bytes], max_words: int, buckets: int) -> Iterator[dict]:
    """Packed stripe segments by bucket."""
    seed = np.uint64(xxhash.xxh3_64_intdigest(lang))
    for size, prefixes, prefix, nexts, counts, hashes in stripes(parts, max_words):
        bucket = (mix(hashes + seed) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        prefix, bucket, counts = prefix[order], bucket[order], _narrow(counts[order])
        nexts = [nexts[k] for k in order.tolist()]
        heads = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (prefix[1:] != prefix[:-1])]))
        lengths = np.diff(np.append(heads, len(prefix))).astype("<i4")
        names = [prefixes[p] for p in prefix[heads].tolist()]
        first = np.flatnonzero(np.concatenate([[True], bucket[heads][1:] != bucket[heads][:-1]]))
        for a, b in zip(first, np.append(first[1:], len(heads))):
            lo, hi = heads[a], heads[b] if b < len(heads) else len(prefix)
            yield {"bucket": bucket[lo], "lang": lang, "size": size, "prefixes": b"\n".join(names[a:b]),
                   "lengths": lengths[a:b].tobytes(), "nexts": b"\n".join(nexts[lo:hi]), "counts": counts[lo:hi].tobytes()}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def count_stripes(docs: DataFrame, max_words: int, buckets: int) -> DataFrame:
    """Packed stripes of all documents (lang, text), by bucket."""

    def run(batches):
        held: dict[str, list[bytes]] = {}
        size = 0

        def flush():
            rows, weight = [], 0
            for lang, parts in held.items():
                for row in _pack(lang, parts, max_words, buckets):
                    rows.append(row)
                    weight += len(row["nexts"])
                    if weight > 4 << 20:
                        yield _batch(rows, _PACKED)
                        rows, weight = [], 0
            if rows:
                yield _batch(rows, _PACKED)
            held.clear()

        for batch in batches:
            cols = columns(batch)
            for lang, text in zip(cols["lang"], cols["text"]):
                for part in _cut((text or b"").translate(_CLEAN), FLUSH_BYTES):
                    held.setdefault(lang.decode(), []).append(part)
                    size += len(part)
                    if size >= FLUSH_BYTES:
                        yield from flush()
                        size = 0
        yield from flush()

    return docs.mapInArrow(run, PACKED)


def merge_stripes(packed: DataFrame, min_count: int) -> DataFrame:
    """lang, size, phrase, f of every phrase of ``min_count`` or more; size 0: words in all (partial sums)."""

    def merge(table: pa.Table) -> pa.Table:
        groups: dict[tuple, list[dict]] = {}
        for row in table.to_pylist():
            groups.setdefault((row["lang"], row["size"]), []).append(row)
        out = []
        for (lang, size), blocks in groups.items():
            names, following = _Numbers(), _Numbers()
            cells, counts = [], []
            for b in blocks:
                prefix = np.fromiter(map(names.__getitem__, b["prefixes"].split(b"\n")), np.int64)
                word = np.fromiter(map(following.__getitem__, b["nexts"].split(b"\n")), np.int64)
                cells.append(np.repeat(prefix, np.frombuffer(b["lengths"], "<i4")) << 32 | word)
                counts.append(_wide(b["counts"], len(word)))
            cell, back = np.unique(np.concatenate(cells), return_inverse=True)
            total = np.zeros(len(cell), np.int64)
            np.add.at(total, back.reshape(-1), np.concatenate(counts))
            if size == 1:
                out.append({"lang": lang, "size": 0, "phrase": "", "f": int(total.sum())})
            keep = np.flatnonzero(total >= min_count)
            prefixes, nexts = list(names), list(following)
            for c, f in zip(cell[keep].tolist(), total[keep].tolist()):
                phrase = nexts[c & 0xFFFFFFFF] if size == 1 else prefixes[c >> 32] + b" " + nexts[c & 0xFFFFFFFF]
                out.append({"lang": lang, "size": size, "phrase": phrase.decode(), "f": f})
        return pa.Table.from_pylist(out, schema=_COUNTED)

    return packed.groupBy("bucket").applyInArrow(merge, COUNTED)


def count_phrases(docs: DataFrame, max_words: int = 3, min_count: int = 10, text: str = "text", lang: str = "lang",
                  bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """Counts of all phrases of ``min_count`` or more, and of all words (size 0), stored."""
    use_small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    return stage(merge_stripes(count_stripes(rows, max_words, 1 + chars // bucket_chars), min_count), "phrases")


def collocations(counted: DataFrame, top: int = 2000, subsumed_percent: int = 50) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is that of its weakest cut, floor(10^6 a^2 / (l r)) in 38 digits.  A
    phrase inside a longer one with ``subsumed_percent`` of its occurrences is left out.
    """
    words = counted.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    phrases = counted.where("size > 0")
    longer = phrases.where("size > 2").select("lang", "f", F.explode(F.expr(
        "flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), "
        "i -> array_join(slice(split(phrase, ' '), i, s), ' '))))")).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    candidates = phrases.where("size > 1").join(longer, ["lang", "phrase"], "left") \
        .where(f"most is null or 100 * cast(most as decimal(20)) < {int(subsumed_percent)} * cast(f as decimal(20))")
    part = phrases.select(F.col("lang").alias("p_lang"), F.col("phrase").alias("p_phrase"), F.col("f").alias("p_f"))

    def total(df: DataFrame, side: str, name: str) -> DataFrame:
        return df.join(part, (F.col("lang") == F.col("p_lang")) & (F.col(side) == F.col("p_phrase"))) \
            .select(*df.columns, F.col("p_f").alias(name))

    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size - 1)")).alias("k")) \
        .withColumn("left", F.expr("substring_index(phrase, ' ', k)")) \
        .withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    cuts = total(total(cuts, "left", "l"), "right", "r").withColumn(
        "score", F.expr("(cast(1000000 as decimal(38)) * a * a) div (cast(l as decimal(19)) * cast(r as decimal(19)))"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # First the best of each part of a language, so that no task ranks all phrases of a large one.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    parts = 1 + math.isqrt(phrases.where("size > 1").count() // max(1, top))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(parts)).alias("part"))
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    best = best.withColumn("place", place).where(F.col("place") <= top)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))) \
        .where(F.col("rank") <= top).join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(count_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet")))


OP12_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
grams as (
  select lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) as phrase
  from worded, (values (1), (2), (3)) as sizes(size) where len(ws) >= size),
counted as (select lang, size, phrase, count(*) as f from grams group by all),
totals as (select lang, sum(f)::bigint as n from counted where size = 1 group by lang),
often as (select * from counted where f >= 10),
longer as (
  select lang, part, max(f) as most from (
    select lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) as part
    from often where size = 3) group by lang, part),
candidates as (
  select o.lang, o.size, o.phrase, o.f from often o left join longer g on g.lang = o.lang and g.part = o.phrase
  where o.size > 1 and (g.most is null or 100 * g.most < 50 * o.f)),
cuts as (
  select lang, phrase, f as a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') as lhs,
         array_to_string(string_split(phrase, ' ')[k + 1:size], ' ') as rhs
  from candidates, (values (1), (2)) as places(k) where k < size),
scored as (
  select c.lang, c.phrase, c.a, c.k, x.f as l, y.f as r,
         ((1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join often x on x.lang = c.lang and x.phrase = c.lhs join often y on y.lang = c.lang and y.phrase = c.rhs),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select k.lang, k.rank::int as rank, k.phrase, k.a, k.l, k.r, t.n, k.score
from ranked k join totals t on t.lang = k.lang where k.rank <= 2000
"""
