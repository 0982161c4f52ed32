"""Collocations against a plain counting of phrases."""

import random
from collections import Counter, defaultdict

import cases
import numpy as np

from tickvault.llm import collocations


def pieces(text):
    out, piece, word = [], [], ""
    for c in cases.lower(text or "") + ".":
        stop = c in ".,;:!?\n\x0b\x0c\r"
        if stop or c in " \t":
            piece += [word] if word else []
            word = ""
            if stop:
                out.append(piece)
                piece = []
        else:
            word += c
    return out


def contract(rows, max_words=3, min_count=10, top=2000, percent=50):
    f = defaultdict(Counter)
    for text, lang in rows:
        for p in pieces(text):
            for size in range(1, max_words + 1):
                for i in range(len(p) - size + 1):
                    f["und" if lang is None else lang][tuple(p[i:i + size])] += 1
    out = []
    for lang, own in f.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        some = {p: a for p, a in own.items() if len(p) > 1 and a >= min_count}
        inside = defaultdict(int)
        for p, a in some.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i:i + size]] = max(inside[p[i:i + size]], a)
        scored = []
        for p, a in some.items():
            if inside[p] and 100 * inside[p] >= percent * a:
                continue
            s, k = min((10 ** 6 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def texts(seed=4, n=900):
    rng = random.Random(seed)
    words = ["the", "The", "of", "New", "York", "a", "é", "日本", "x-y", "it's", "\x00", "<b>"] + cases.WORDS[:8]
    rows = []
    for k in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! "]) for _ in range(rng.randint(0, 60)))
        text += "new york city " * rng.randint(0, 3) + "machine learning " * rng.randint(0, 2)
        rows.append((text, ["en", "fr", None, "und", ""][k % 5]))
    return rows + rows[:6] + [(None, "en"), (None, None), ("", "fr"), (" .,;:!?\n\x0b\x0c\r\t", "fr"), ("only once", "de")]


def got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def table(spark, rows):
    return spark.createDataFrame([r + (1, "x", 2) for r in rows], "text string, lang string, f long, phrase string, size int").repartition(5)


def test_against_plain_counts(spark):
    rows = texts()
    docs = table(spark, rows)
    want = contract(rows)
    assert len(want) > 100 and any(" " in p[2].replace(" ", "", 1) for p in want)
    assert got(collocations.collocations(collocations.count_phrases(docs))) == want
    many = collocations.count_phrases(docs, bucket_chars=100)        # stripes cut into many segments
    assert got(collocations.collocations(many)) == want


def test_longer_phrases_and_bounds(spark):
    rows = texts(7, 60)
    counted = collocations.count_phrases(table(spark, rows), max_words=5, min_count=4)
    assert got(collocations.collocations(counted, top=25, subsumed_percent=80)) == contract(rows, 5, 4, 25, 80)


def test_flushes_and_cut_texts(spark, monkeypatch):
    rows = texts(9, 80)
    monkeypatch.setattr(collocations, "FLUSH_BYTES", 300)
    assert got(collocations.collocations(collocations.count_phrases(table(spark, rows), bucket_chars=2000))) == contract(rows)


def test_awkward_rows(spark, docs, rows, empty):
    assert got(collocations.collocations(collocations.count_phrases(docs))) == contract([(r[1], r[2]) for r in rows])
    assert collocations.collocations(collocations.count_phrases(empty)).count() == 0


def test_cuts_keep_pieces():
    text = b"ab cd\xffef\xff\xffgh" + b"i" * 30 + b"\xffz"
    for limit in range(1, 50):
        parts = list(collocations._cut(text, limit))
        assert b"\xff".join(parts) == text and all(len(p) <= limit or b"\xff" not in p for p in parts)


def test_exact_scores_beyond_64_bits(spark):
    big = 3_037_000_500_123
    counted = spark.createDataFrame([("en", 0, "", 10 ** 14), ("en", 1, "p", big), ("en", 1, "q", big + 7), ("en", 2, "p q", big - 1)],
                                    collocations.COUNTED)
    assert got(collocations.collocations(counted)) == [
        ("en", 1, "p q", big - 1, big, big + 7, 10 ** 14, 10 ** 6 * (big - 1) ** 2 // (big * (big + 7)))]
    assert np.int64(big) * 2 > 0
