"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each document gets its counts in one pass.  Sketches of the derived ratios, of all values
and of those above zero, are built per (language, source) and merged per language and over
all.  With ``z`` the share of zeros, ``q`` quantiles of all values and ``p`` of those above
zero, a ratio's fence is

* where it is common (the median is above zero): ``q50 + max((1 + 2 spread) (q50 - q25),
  floor)``.  For a symmetric ratio that is the upper quartile plus ``spread`` interquartile
  ranges, but junk in up to nearly half of a group can't raise it;
* where it is rare: the lesser of ``(1 + 2 spread) p25``, by what documents have that have
  any, and ``floor (1 + 2 spread (1 - z))``, by how many have any, which holds where those
  are junk in bulk.

A document is held against the strictest of the fences of its group, its language and all
rows, so that a source of nothing but junk doesn't set its own measure; word length isn't
held against other languages, of which some write no spaces.  The fence of fewer than
``min_rows`` documents goes over into the next wider one in proportion, so no verdict hangs
on the row that reaches ``min_rows``.  Sketches hold a bounded number of values and merge
map-side, so a group of a third of all rows costs no more than another.

Defined cases: null or empty text has no words and fails the base rules; null ``lang``
or ``source`` form groups of their own; repeated rows each get a row; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import (WORD_SPACE, covered, map_batches, mix, stage, use_small_batches,
                                  window_hashes, window_starts, word_hashes)

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
WINDOW = 8
# Ratio: (numerator, denominator, floor: the least room above what is usual).
RATIOS = {
    "r_word": ("word_chars", "n_words", 1.5),
    "r_symbol": ("n_symbols", "n_words", 0.1),
    "r_upper": ("n_upper", "word_chars", 0.03),
    "r_dup_line": ("n_dup_lines", "n_lines", 0.4),
    "r_repeat": ("n_repeat_words", "n_words", 0.12),
}
#: Ratios that differ with the script, not held against other languages.
OWN_LANGUAGE = frozenset(("r_word",))


def _repeat_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word count of each text and its words inside windows that it holds twice or more."""
    items, counts = word_hashes(texts)
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = window_starts(counts, WINDOW)
    if not len(starts):
        return counts, np.zeros(len(counts), np.int64)
    keys = mix(window_hashes(items, WINDOW)[starts] + owner[starts].astype(np.uint64) *
               np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = covered(starts[twice], WINDOW, len(items))
    return counts, np.bincount(owner[hit], minlength=len(counts))


def measure(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
            doc_id: str = "doc_id") -> DataFrame:
    """doc_id, lang, source and the counts of every document."""
    use_small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"),
                       F.col(source).cast("string").alias("source"), F.col(text).alias("text"))

    def count(cols):
        texts = cols["text"]
        words, repeats = _repeat_words(texts)
        chars, symbols, upper, lines, dups = ([] for _ in range(5))
        for t in texts:
            t = t or b""
            bare = t.translate(None, WORD_SPACE)
            chars.append(len(bare.decode("utf-8", "replace")))
            symbols.append(len(t) - len(t.translate(None, SYMBOLS)))
            upper.append(len(t) - len(t.translate(None, UPPER)))
            own = [x for x in t.split(b"\n") if x.strip(WORD_SPACE)]
            lines.append(len(own))
            dups.append(len(own) - len(set(own)))
        text_of = lambda xs: [x.decode() if x is not None else None for x in xs]
        yield {"doc_id": cols["doc_id"], "lang": text_of(cols["lang"]), "source": text_of(cols["source"]),
               "n_words": words, "word_chars": chars, "n_symbols": symbols, "n_upper": upper,
               "n_lines": lines, "n_dup_lines": dups, "n_repeat_words": repeats}

    return map_batches(rows, count, "doc_id long, lang string, source string, n_words long, word_chars long, "
                       "n_symbols long, n_upper long, n_lines long, n_dup_lines long, n_repeat_words long")


def fences(measured: DataFrame, spread: float = 3.0) -> dict[str, DataFrame]:
    """Upper fence of each ratio by group, by language and over all rows."""
    ratios = measured.select("lang", "source", *[
        F.when(F.col(d) > 0, F.col(n) / F.col(d)).otherwise(0.0).alias(r) for r, (n, d, _) in RATIOS.items()])
    some = lambda r: F.when(F.col(r) > 0, F.col(r))
    by_group = ratios.groupBy("lang", "source").agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(r).alias(r) for r in RATIOS],
        *[F.kll_sketch_agg_double(some(r)).alias(f"some_{r}") for r in RATIOS], *[F.count(some(r)).alias(f"n_{r}") for r in RATIOS])

    def merged(*keys: str) -> DataFrame:
        return by_group.groupBy(*keys).agg(
            F.sum("n").alias("n"), *[F.kll_merge_agg_double(f"{k}{r}").alias(f"{k}{r}") for r in RATIOS for k in ("", "some_")],
            *[F.sum(f"n_{r}").alias(f"n_{r}") for r in RATIOS]).where("n > 0")

    def fence(df: DataFrame, keys: list[str], mark: str) -> DataFrame:
        def bound(r: str, floor: float):
            q = lambda c, p: F.kll_sketch_get_quantile_double(F.col(c), F.lit(p))
            usual = q(r, 0.5) + F.greatest((1 + 2 * spread) * (q(r, 0.5) - q(r, 0.25)), F.lit(floor))
            rare = F.lit(floor) * (1 + 2 * spread * F.col(f"n_{r}") / F.col("n"))
            return F.when(q(r, 0.5) > 0, usual).when(F.col(f"n_{r}") > 0, F.least((1 + 2 * spread) * q(f"some_{r}", 0.25), rare)) \
                .otherwise(rare)

        return df.select(*[F.col(k).alias(f"{mark}_{k}") for k in keys], F.col("n").alias(f"{mark}_n"),
                         *[bound(r, floor).alias(f"{mark}_{r}") for r, (_, _, floor) in RATIOS.items()])

    return {"g": fence(by_group, ["lang", "source"], "g"), "l": fence(merged("lang"), ["lang"], "l"),
            "a": fence(merged(), [], "a")}


def judge(measured: DataFrame, min_rows: int = 200, spread: float = 3.0) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``."""
    by = {k: stage(v, f"fences-{k}") for k, v in fences(measured, spread).items()}
    every = by["a"].first()       # a single row
    out = measured.join(by["g"], F.col("lang").eqNullSafe(F.col("g_lang")) &
                        F.col("source").eqNullSafe(F.col("g_source")), "left") \
        .join(by["l"], F.col("lang").eqNullSafe(F.col("l_lang")), "left")
    inside = F.lit(True)

    def blend(own: str, n: str, wider):
        part = F.least(F.col(n) / min_rows, F.lit(1.0))
        return F.coalesce(part * F.col(own) + (1 - part) * wider, wider)

    for r, (n, d, _) in RATIOS.items():
        over_all = F.lit(every[f"a_{r}"] if every else None).cast("double")
        by_lang = blend(f"l_{r}", "l_n", over_all)
        tops = [blend(f"g_{r}", "g_n", by_lang), by_lang] + [over_all] * (r not in OWN_LANGUAGE)
        inside = inside & (F.when(F.col(d) > 0, F.col(n) / F.col(d)).otherwise(0.0) <= F.least(*tops))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select(*[measured[c] for c in measured.columns], failed.alias("base_failed"),
                      F.when(failed, False).otherwise(F.coalesce(inside, F.lit(True))).alias("kept"))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(stage(measure(docs), "measures")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
