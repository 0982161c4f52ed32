"""Benchmark decontamination, with DataFrame and SQL functions only.

Test items are normalised (A-Z lower-cased, runs of letters, digits and non-ASCII
characters as words) and cut into windows of ``size`` words; an item of fewer words is one
window.  The distinct window hashes, counted against ``set_size`` first, travel to every
task as a hash set inside the scan's expression.  A scan reads each text once, keeps only
the windows whose hash is in the set, and an equality join on the windows' words verifies
them, so a hash collision never counts.  A benchmark of up to ``max_sets`` times that size is
held against the documents in blocks; beyond it the hashes stay in their table, and the
hashes of the documents' windows are joined with it.

Defined cases: null and empty texts have no words, on either side; an item with a null id
marks words but is not listed; repeated items and rows change nothing for others; overlapping
and equal windows count a word once; other columns are ignored; without items nothing is hit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import own_names, row_key, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: As GAP for text that isn't lower-cased yet.
RAW_GAP = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def normal_words(text: str) -> Column:
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, GAP), "")


def windows(benchmark: DataFrame, size: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, len, h and the words of every distinct window of every item."""
    items = benchmark.select(F.col(item_id).alias("item_id"), normal_words(text).alias("words")) \
        .where(F.size("words") > 0).withColumn("len", F.least(F.size("words"), F.lit(size)))
    return items.select("item_id", "len", F.explode(F.expr(
        "transform(sequence(1, size(words) - len + 1), i -> slice(words, i, len))")).alias("w")) \
        .select("item_id", "len", F.xxhash64("w").alias("h"), F.array_join("w", " ").alias("win")).distinct()


def _scan(rows: DataFrame, hashes: dict[int, list[int]]) -> DataFrame:
    """``rows`` with the number of words and the windows whose hash is in the set."""
    found = [F.expr(f"""transform(
        filter(CASE WHEN size(words) >= {n} THEN sequence(1, size(words) - {n - 1}) ELSE array() END,
               i -> xxhash64(slice(words, i, {n})) IN ({','.join(f'{h}L' if h > -2 ** 63 else str(h) for h in own)})),
        i -> named_struct('pos', i, 'len', {n}, 'win', array_join(slice(words, i, {n}), ' ')))""")
             for n, own in sorted(hashes.items())]
    hits = F.concat(*found) if found else F.expr("cast(array() as array<struct<pos: int, len: int, win: string>>)")
    return rows.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))


def _join(rows: DataFrame, wins: DataFrame, lengths: list[int]) -> DataFrame:
    """key, pos, len, win of the windows whose hash is in the table ``wins``."""
    spots = F.concat(*[F.expr(f"""transform(
        CASE WHEN size(words) >= {n} THEN sequence(1, size(words) - {n - 1}) ELSE array() END,
        i -> named_struct('pos', i, 'len', {n}, 'h', xxhash64(slice(words, i, {n}))))""") for n in lengths])
    found = rows.select("key", F.inline(spots)).join(wins.select("len", "h").distinct(), ["len", "h"], "left_semi")
    at = found.groupBy("key").agg(F.collect_set(F.struct("pos", "len")).alias("at"))      # one document's
    return rows.join(at, "key").select("key", F.inline(F.expr(
        "transform(at, x -> named_struct('pos', x.pos, 'len', x.len, 'win', array_join(slice(words, x.pos, x.len), ' ')))")))


def scan(docs: DataFrame, benchmark: DataFrame, size: int = 10, set_size: int = 50_000,
         max_sets: int = 4, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every document (doc_id, key, n_words), and its verified hits (key, pos, len, item_id)."""
    wins = stage(windows(benchmark, size), "bench-windows")
    lengths = {r["len"]: r["n"] for r in wins.select("len", "h").distinct().groupBy("len").agg(F.count("*").alias("n")).collect()}
    rows, inner = own_names(docs)
    place = dict(zip(docs.columns, inner))
    rows = rows.select(F.col(place[doc_id]).alias("doc_id"), row_key(place[doc_id], place[text]).alias("key"),
                       normal_words(place[text]).alias("words"))
    if sum(lengths.values()) > set_size * max_sets:
        found = _join(rows, wins, sorted(lengths)).distinct()
        whole = rows.select("doc_id", "key", F.size("words").cast("long").alias("n_words"))
    else:
        hashes = [tuple(r) for r in wins.select("len", "h").distinct().orderBy("len", "h").collect()]
        parts = []
        for at in range(0, max(1, len(hashes)), set_size):
            own: dict[int, list[int]] = {}
            for n, h in hashes[at:at + set_size]:
                own.setdefault(n, []).append(h)
            parts.append(stage(_scan(rows, own), "bench-scan"))
        found = reduce(DataFrame.unionAll, [p.where(F.size("hits") > 0).select("key", F.inline("hits")) for p in parts]).distinct()
        whole = parts[0].select("doc_id", "key", "n_words")
    hits = found.join(wins.select("item_id", "len", "win"), ["len", "win"]).select("key", "pos", "len", "item_id")
    return whole, hits


def marked(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Every document with its hit words and the items found in it."""
    reach = F.expr("""aggregate(spans, named_struct('n', 0L, 'reach', 0L), (a, x) -> named_struct(
        'n', a.n + greatest(0L, x.pos + x.len - greatest(a.reach, cast(x.pos as bigint))),
        'reach', greatest(a.reach, cast(x.pos + x.len as bigint)))).n""")
    by_doc = hits.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("pos", "len"))).alias("spans"),
                                     F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")) \
        .select("key", reach.alias("n_hit"), "items")
    return rows.join(by_doc, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names of our own with the row's key ``at``, and the names."""
    rows, inner = own_names(docs)
    place = dict(zip(docs.columns, inner))
    return rows.withColumn("at", row_key(place[doc_id], place[text])), place


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold a window of the benchmark."""
    _, hits = scan(docs, benchmark, **options)
    rows, place = _keyed(docs, options.get("doc_id", "doc_id"), options.get("text", "text"))
    bad = hits.select("key").distinct()
    return rows.join(bad, F.col("at") == F.col("key"), "left_anti").select(*[F.col(k).alias(c) for c, k in place.items()])


def remove_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with the hit words, each with the characters up to the next word, cut out."""
    text = options.get("text", "text")
    _, hits = scan(docs, benchmark, **options)
    spots = hits.select("key", F.explode(F.sequence("pos", F.col("pos") + F.col("len") - 1)).alias("p")) \
        .groupBy("key").agg(F.collect_set("p").alias("hit"))
    rows, place = _keyed(docs, options.get("doc_id", "doc_id"), text)
    body = F.col(place[text])
    token = F.regexp_extract_all(body, F.lit(f"([^{RAW_GAP}]+[{RAW_GAP}]*)"), F.lit(1))
    lead = F.regexp_extract(body, f"^[{RAW_GAP}]*", 0)
    kept = F.filter(F.col("tokens"), lambda _, i: ~F.array_contains(F.col("hit"), i + 1))
    return rows.join(spots, F.col("at") == F.col("key"), "left") \
        .withColumn("tokens", F.when(F.col("hit").isNotNull(), token)) \
        .withColumn(place[text], F.when(F.col("hit").isNull(), body).otherwise(F.concat(lead, F.array_join(kept, "")))) \
        .select(*[F.col(k).alias(c) for c, k in place.items()])


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return marked(*scan(docs, bench)).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP8_SQL = r"""
WITH norm AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
toks AS (
  SELECT kind, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM norm),
wins AS (
  SELECT id AS item_id, least(len(w), 10) AS n,
         unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS win
  FROM toks WHERE kind = 'b' AND len(w) > 0),
sizes AS (SELECT DISTINCT n FROM wins),
spots AS (
  SELECT t.id AS doc_id, s.n, t.w, unnest(range(1, len(t.w) - s.n + 2)) AS pos
  FROM toks t JOIN sizes s ON len(t.w) >= s.n WHERE t.kind = 'd'),
hits AS (
  SELECT DISTINCT p.doc_id, p.pos, p.n, b.item_id
  FROM (SELECT doc_id, pos, n, array_to_string(w[pos:pos + n - 1], ' ') AS win FROM spots) p
  JOIN (SELECT DISTINCT * FROM wins) b ON b.win = p.win AND b.n = p.n),
words AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS spot FROM (SELECT DISTINCT doc_id, pos, n FROM hits)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT t.id AS doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(x.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
       x.n_hit IS NOT NULL AS contaminated
FROM toks t LEFT JOIN words x ON x.doc_id = t.id LEFT JOIN items i ON i.doc_id = t.id WHERE t.kind = 'd'
"""
