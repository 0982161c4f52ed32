"""Mixing, decontamination, classifiers, rules, extraction and the pipeline."""

import hashlib
import json
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

import corpus_pipeline
from tickvault.llm import decontaminate, html_extraction, language_id, mixing, quality_classifier, quality_rules
from tickvault.llm.common import held_out, learnable

NULLS_LAST = lambda s: (s is None, s or "")


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- mixing ------------------------------------------------------------------

def test_targets_reshare_what_sources_lack():
    found = mixing.targets({"a": 10, "b": 1000, "c": 0, None: 500}, {"a": 5, "b": 1, "c": 2, None: 1})
    assert found["a"] == 30 and found["c"] == 0
    assert found["b"] == pytest.approx(740) and found[None] == pytest.approx(740)
    assert mixing.targets({"a": 0}, {"a": 1}) == {"a": 0.0} and mixing.targets({}, {}) == {}


def test_mix_contract(docs, rows, empty):
    found = mixing.Mix(docs, block_words=4, shard_slots=300).taken().collect()
    size = [len(cases.words(r[1])) for r in rows]
    total = defaultdict(int)
    for r, n in zip(rows, size):
        total[r[3]] += n
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(total, key=NULLS_LAST))}
    goal = mixing.targets(dict(total), weights)
    assert sorted(((r["doc_id"], r["size"]) for r in found), key=repr) == sorted(((r[0], n) for r, n in zip(rows, size)), key=repr)
    assert sorted(r["source_size"] for r in found) == sorted(total[r[3]] for r in rows)
    assert sorted(r["target"] for r in found) == pytest.approx(sorted(goal[r[3]] for r in rows))
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in found)
    taken = defaultdict(int)
    for r in found:
        taken[r["source_size"], r["target"]] += r["taken"]
    for (_, target), n in taken.items():
        assert abs(n - target) <= 0.03 * target + 8
    assert found and sorted(found, key=repr) == sorted(mixing.Mix(docs, block_words=4, shard_slots=300).taken().collect(), key=repr)
    assert mixing.Mix(empty).taken().count() == 0 and mixing.Mix(empty, with_text=True).texts().count() == 0


def test_blocks_hold_the_stream(docs, rows):
    mix = mixing.Mix(docs, with_text=True, block_words=16, shard_slots=100)
    texts = mix.texts().collect()
    assert all(len(cases.words(r["text"])) == r["n_words"] <= 16 for r in texts)
    pieces = Counter()
    for r in mix.blocks().collect():
        pieces[r["k"]] += r["n"]
        assert len(cases.words(r["text"])) == r["n"]
    total = defaultdict(int)
    for r in rows:
        total[r[3]] += len(cases.words(r[1]))
    assert [pieces[k] for k, _ in enumerate(sorted(total, key=NULLS_LAST))] == [total[s] for s in sorted(total, key=NULLS_LAST)]
    blocks = Counter((r["source"], r["block"]) for r in texts)
    for s in total:       # passes are permutations: a block's uses differ by one at most
        uses = [n for (x, _), n in blocks.items() if x == s]
        count = -(-total[s] // 16)
        uses += [0] * (count - len(uses))
        assert max(uses) - min(uses) <= 1 and max(uses) <= 3
    per_shard = Counter(r["shard"] for r in texts)
    assert max(per_shard.values()) <= 101 and len(per_shard) > 5


def many_sources(spark, n=120):
    rng = np.random.default_rng(12)
    rows = [(k, " ".join(rng.choice(cases.WORDS, int(rng.integers(0, 60)))), f"s{int(rng.integers(0, n)):03d}" if k % 9 else None) for k in range(900)]
    rows += [(2000 + k, " ".join(rng.choice(cases.WORDS, 300)), "big") for k in range(20)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)


@pytest.mark.parametrize("plain", [False, True])
def test_taken_by_hand(spark, plain, monkeypatch):
    """Words taken of each document, from the slots one at a time; with a joined plan the same as with a broadcast one."""
    rows, docs = many_sources(spark)
    mix = mixing.Mix(docs, block_words=8, shard_slots=64, plain=plain)
    slots = mix.slots().collect()
    by_source = Counter((r["k"], r["block"]) for r in slots)
    want = []
    for r in mix.placed.collect():
        taken = 0
        for w in range(r["start"], r["start"] + r["size"]):
            taken += by_source[r["k"], w // 8]
        want.append((r["doc_id"], r["size"], taken))
    found = mix.taken().select("doc_id", "size", "taken").collect()
    assert sorted(map(tuple, found)) == sorted(want) and {r["doc_id"] for r in found} == {r[0] for r in rows}
    # Each pass takes a block once, each source's slots are numbered without gaps.
    assert max(by_source.values()) <= 3
    for k in {r["k"] for r in slots}:
        own = sorted(r["slot"] for r in slots if r["k"] == k)
        assert own == list(range(len(own)))
    # Sources come near their targets: the plain draw within five standard deviations, else within a slot a shard.
    goal = {r["k"]: r["slots"] for r in mix.plan}
    drawn = Counter()
    for r in mix.counts().collect():
        drawn[r["k"]] += r["n"]
    assert sum(drawn.values()) == pytest.approx(sum(goal.values()), abs=mix.shards + 1)
    for k, want_slots in goal.items():
        assert abs(drawn[k] - want_slots) <= 5 * np.sqrt(want_slots) + 3
    # Without a bound on sources.
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 3)
    assert got(mixing.Mix(docs, block_words=8, shard_slots=64, plain=plain).taken()) == got(mix.taken())


def test_single_small_source(spark):
    docs = spark.createDataFrame([(1, "a b c", "s"), (2, None, "s"), (3, "", None)], "doc_id long, text string, source string")
    assert got(mixing.Mix(docs).taken()) == [(1, 3, 3, 3.0, 3), (2, 0, 3, 3.0, 0), (3, 0, 0, 0.0, 0)]


# ---- decontamination ---------------------------------------------------------

def normal(text):
    out, word = [], ""
    for c in cases.lower(text or "") + " ":
        if c.isascii() and not c.isalnum():
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def hit_contract(rows, items):
    wins = defaultdict(set)
    for item, text in items:
        w = normal(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[i:i + n])].add(item)
    out = []
    for r in rows:
        w = normal(r[1])
        mask, found = [False] * len(w), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                own = wins.get(tuple(w[i:i + n]))
                if own:
                    mask[i:i + n] = [True] * n
                    found |= own
        names = sorted(str(x) for x in found if x is not None)
        out.append((r[0], len(w), sum(mask), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), any(mask)))
    return out


@pytest.mark.parametrize("set_size, max_sets", [(50_000, 4), (7, 4), (7, 100), (1, 0)])
def test_hits(spark, docs, rows, set_size, max_sets):
    from pyspark.sql import functions as F

    middle = normal(rows[8][1])
    items = [(1, " ".join(middle[:14]).upper()), (12, "- ".join(middle[5:17])), (3, "two, WORDS!"), (None, rows[10][1]),
             (4, None), (5, "..."), (12, " ".join(middle[5:17])), (7, " ".join(middle[20:30])), (2, "日 nothing of this kind")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, key long")
    found = decontaminate.marked(*decontaminate.scan(docs, bench, set_size=set_size, max_sets=max_sets)) \
        .select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), "contaminated")
    want = hit_contract(rows, items)
    assert got(found) == sorted(want, key=repr) and sum(x[5] for x in want) >= 3
    clean = decontaminate.remove_documents(docs, bench)
    assert clean.columns == docs.columns
    assert got(clean.select("doc_id")) == sorted([(x[0],) for x in want if not x[5]], key=repr)
    cut = decontaminate.remove_spans(docs, bench)
    assert cut.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in cut.collect()}
    by_id = {x[0]: x for x in want if x[0] not in (4, None)}
    texts = {r[0]: r[1] for r in rows}
    assert all(len(normal(left[d])) == x[1] - x[2] for d, x in by_id.items())
    assert all(left[d] == texts[d] for d, x in by_id.items() if not x[5])


def test_nothing_to_hit(spark, docs, empty, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not [r for r in decontaminate.marked(*decontaminate.scan(docs, none)).collect() if r["contaminated"]]
    assert decontaminate.remove_documents(docs, none).count() == len(rows)
    assert decontaminate.marked(*decontaminate.scan(empty, none)).count() == 0


# ---- language ID -------------------------------------------------------------

ALPHABETS = {"one": "abcdef ", "two": "cdefgh ", "three": "éàü ef "}


@pytest.fixture(scope="module")
def spoken(spark):
    rng = np.random.default_rng(8)
    rows = [(k, "".join(rng.choice(list(ALPHABETS[lang]), int(rng.integers(20, 200)))), lang, 1)
            for k, lang in enumerate(rng.choice(list(ALPHABETS), 300))]
    rows += [(1000, None, "one", 1), (1001, "", "one", 1), (1002, " 123 !?", "two", 1), (1003, "abc abc abc", None, 1), (None, "cde gh", "two", 1),
             (1004, "ab" * 40_000, "one", 1), (0, rows[0][1], rows[0][2], 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, score long")


def test_language(spoken, empty):
    rows, docs = spoken
    model = language_id.train(docs.where(learnable()))
    found = language_id.predict(docs, model)
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == len(rows)
    assert all((by_id[k]["lang_pred"], by_id[k]["score"]) == ("und", 0.0) for k in (1000, 1001, 1002))
    assert by_id[1004]["lang_pred"] == "one" and by_id[1003]["lang_pred"] == "one"
    unseen = [r for r in rows if r[0] is not None and r[0] < 300 and zlib.crc32(str(r[0]).encode()) % 3 == 1]
    right = sum(by_id[r[0]]["lang_pred"] == r[2] for r in unseen)
    assert right >= 0.97 * len(unseen)
    assert {r["doc_id"] for r in docs.where(held_out()).select("doc_id").collect()} >= {r[0] for r in unseen}
    nothing = language_id.train(empty)
    assert {r["lang_pred"] for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0


def gram_buckets(text, buckets):
    """The n-grams' buckets one at a time, in plain integers."""
    mask, out = (1 << 64) - 1, []
    text = f" {text.lower()} "
    for n in (1, 2, 3):
        for i in range(len(text) - n + 1):
            x = 0
            for k, c in enumerate(text[i:i + n]):
                x |= ord(c) << 21 * k
            x ^= n * 0x9E3779B97F4A7C1
            x ^= x >> 33
            x = x * 0xFF51AFD7ED558CCD & mask
            x ^= x >> 33
            x = x * 0xC4CEB9FE1A85EC53 & mask
            x ^= x >> 33
            out.append(x & buckets - 1)
    return out


def plain_bayes(rows, buckets):
    """Counts, and the posterior of every row's best language, in plain Python."""
    import math
    counts, docs = defaultdict(Counter), Counter()
    for r in rows:
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1 and r[1] is not None and r[2] is not None:
            docs[r[2]] += 1
            counts[r[2]].update(gram_buckets(r[1], buckets))
    logs = {lang: {b: math.log((c[b] + 0.5) / (sum(c.values()) + 0.5 * buckets)) for b in range(buckets)} for lang, c in counts.items()}
    out = []
    for r in rows:
        if not r[1] or not any(map(str.isalpha, r[1])):
            out.append((r[0], "und", 0.0))
            continue
        grams = gram_buckets(r[1], buckets)
        scores = {lang: math.log(docs[lang] / sum(docs.values())) + sum(own[g] for g in grams) for lang, own in logs.items()}
        best = max(sorted(scores), key=scores.get)
        out.append((r[0], best, 1 / sum(math.exp(x - scores[best]) for x in scores.values())))
    return counts, out


def test_language_matches_plain_bayes(spoken):
    rows, docs = spoken
    rows = [r for r in rows if r[0] != 1004]        # the long text would take plain Python minutes
    docs = docs.where("doc_id <> 1004 or doc_id is null")
    counts, want = plain_bayes(rows, 1 << 10)
    for mb in (1, 8 / 1024, 4 / 1024):              # all languages in a matrix, two, one
        models = language_id.train(docs.where(learnable()), buckets=1 << 10, max_matrix_mb=mb)
        assert [x for m in models for x in m["languages"]] == sorted(counts)
        assert len(models) == {1: 1, 8 / 1024: 2, 4 / 1024: 3}[mb]
        for m in models:
            for k, lang in enumerate(m["languages"]):
                total = sum(counts[lang].values())
                assert np.allclose(m["matrix"][:, k], np.log((np.array([counts[lang][b] for b in range(1 << 10)]) + 0.5) / (total + 512)), atol=1e-5)
        found = sorted(map(tuple, language_id.predict(docs, models).collect()), key=repr)
        want = sorted(want, key=repr)
        assert [x[:2] for x in found] == [x[:2] for x in want]
        assert [x[2] for x in found] == pytest.approx([x[2] for x in want], abs=2e-3)


def test_grams_in_slices():
    text = "Ab é日x" * 40
    for size in (1, 2, 3, 7, 1000):
        found = np.concatenate(list(language_id._grams(text.encode(), 1 << 12, size)))
        assert sorted(found.tolist()) == sorted(gram_buckets(text, 1 << 12))


# ---- quality -----------------------------------------------------------------

@pytest.fixture(scope="module")
def judged(spark):
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for k in range(300):
        good = k % 4 != 0
        own = rng.choice(cases.WORDS, int(rng.integers(30, 90)))
        text = " ".join(own if good else [w.upper() + "###" for w in own]) + "."
        rows.append((k, text, "en", "s", 1))
        labels.append((k, int(good), 0))
    rows += [(900, None, None, None, 1), (901, "", "en", "s", 1), (902, "x", None, "s", 1), (903, "word " * 30_000, "en", None, 1), rows[5], rows[4]]
    labels += [(900, None, 1), (None, 1, 1), (5, 1, 0), (4444, 0, 0)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score long"), \
        spark.createDataFrame(labels, "doc_id long, quality int, text int")


def test_classifier(spark, judged, empty):
    rows, docs, labels = judged
    model = quality_classifier.train(docs, labels.where(learnable()))
    found = quality_classifier.score(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    unseen = [r for r in found if r["doc_id"] < 300 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 != 0) for r in unseen]) >= 0.97
    again = quality_classifier.score(docs, quality_classifier.train(docs, labels.where(learnable()))).collect()
    assert sorted(found, key=repr) == sorted(again, key=repr)
    blank = quality_classifier.train(docs, labels.where("quality = 1"))
    assert {r["score"] for r in quality_classifier.score(docs, blank).collect()} == {0.5}
    assert quality_classifier.score(empty, model).count() == 0
    assert {r["score"] for r in quality_classifier.score(docs, quality_classifier.train(empty, labels)).collect()} == {0.5}


def test_pairwise_loss_prefers_the_labelled():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, len(quality_classifier.NAMES) + 2 * quality_classifier.HASHED)).astype(np.float32)
    y = (x[:, 2] + 0.3 * rng.normal(size=400) > 0.4).astype(float)
    model = quality_classifier.fit(x, y)
    z = quality_classifier._extended(x, model["mean"], model["spread"]) @ model["w"]
    pairs = rng.choice(np.flatnonzero(y == 1), 500), rng.choice(np.flatnonzero(y == 0), 500)
    assert (z[pairs[0]] > z[pairs[1]]).mean() > 0.95
    assert abs((z >= model["cut"]).mean() - y.mean()) < 0.01


def test_weights_are_the_least_loss():
    """Against plain gradient descent on the same pairs."""
    rng = np.random.default_rng(5)
    d = rng.normal(size=(300, 6)) + np.array([0.8, 0.0, -0.4, 0.1, 0.0, 0.3])
    w = [0.0] * 6
    for _ in range(4000):
        grad = [0.05 * c for c in w]
        for row in d:
            p = 1 / (1 + np.exp(sum(a * b for a, b in zip(row, w))))
            for k in range(6):
                grad[k] -= row[k] * p / len(d)
        w = [c - 0.5 * g for c, g in zip(w, grad)]
        if max(map(abs, grad)) < 1e-7:
            break
    assert quality_classifier.bradley_terry(d, 0.05) == pytest.approx(w, abs=1e-5)


def test_features_by_hand(monkeypatch):
    text = "Ab ab\nAb ab\n  12, x!"
    words = [w for w in text.lower().split()]
    want = Counter()
    for w in words:
        import xxhash
        want[xxhash.xxh3_64_intdigest(w.encode()) % quality_classifier.HASHED] += 1 / len(words)
    raw, grams = text.lower().encode(), Counter()
    for i in range(len(raw) - 2):
        code = (raw[i] | raw[i + 1] << 8 | raw[i + 2] << 16) * 2654435761 % (1 << 32)
        grams[code >> 25] += 1 / (len(raw) - 2)
    for size in (1 << 20, 4):
        monkeypatch.setattr(quality_classifier, "SLICE", size)
        found = quality_classifier.frequencies(text.encode())
        for k in range(quality_classifier.HASHED):
            assert found[k] ** 2 == pytest.approx(want[k]) and found[quality_classifier.HASHED + k] ** 2 == pytest.approx(grams[k])
    assert quality_classifier.shape(text.encode())[-1] == pytest.approx(1 / 3)
    assert not quality_classifier.features([None, b""]).any()


def measure_contract(rows):
    out = []
    for r in rows:
        t, w = r[1] or "", cases.words(r[1])
        lines = [x for x in t.split("\n") if cases.words(x)]
        mask = cases.repeated_mask(w, 8, cases.window_counts([w], 8))
        out.append((r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), sum(mask)))
    return out


def test_rules(docs, rows, judged, empty):
    own, table, _ = judged
    for found, many in ((quality_rules.measure(docs), rows), (quality_rules.measure(table), own)):
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        assert got(found.select(*names)) == sorted(measure_contract(many), key=repr)
    kept = {r["doc_id"]: r for r in quality_rules.judge(quality_rules.measure(table), min_rows=50).collect()}
    for d, n, _, _, _, rep in measure_contract(own):
        assert kept[d]["base_failed"] == (n < 20 or 100 * rep > 30 * n)
    assert not kept[900]["kept"] and not kept[903]["kept"]
    assert all(kept[k]["kept"] for k in range(300) if k % 4 and not kept[k]["base_failed"])
    assert quality_rules.judge(quality_rules.measure(empty)).count() == 0


def test_fences_reject_junk_in_bulk(spark):
    rng = np.random.default_rng(10)
    own = lambda: " ".join(rng.choice(cases.WORDS, 40))
    junk = " ".join(w + "##" for w in own().split())
    repeats = lambda: " ".join((w := [f"w{x}" for x in rng.integers(0, 10**6, 88)])[:9] + w)
    rows = [(k, junk if k % 3 == 0 else own(), "en", "third") for k in range(600)]
    rows += [(1000 + k, junk, "en", "all") for k in range(250)]
    rows += [(2000 + k, own(), "en", "good") for k in range(300)]
    rows += [(3000 + k, repeats() if k < 20 else own(), "en", "repeats") for k in range(199)]
    rows += [(4000 + k, " ".join("".join(rng.choice(list("日本語中文"), 25)) for _ in range(25)), "zh", "good") for k in range(250)]
    measured = quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).cache()
    found = {r["doc_id"]: r for r in quality_rules.judge(measured).collect()}
    assert not any(r["base_failed"] for r in found.values())
    bad = {k for k in found if k < 600 and k % 3 == 0 or 1000 <= k < 1250 or 3000 <= k < 3020}
    assert {k for k, r in found.items() if not r["kept"]} == bad
    small, large = ({r["doc_id"] for r in quality_rules.judge(measured, min_rows=n).where("kept").collect()} for n in (199, 200))
    assert small == large


def plain_fence(values, floor, spread=3.0):
    """The fence of a group by its sorted values."""
    ordered, some = sorted(values), sorted(v for v in values if v > 0)
    q = lambda xs, p: xs[max(0, int(np.ceil(p * len(xs))) - 1)]
    if q(ordered, 0.5) > 0:
        return q(ordered, 0.5) + max((1 + 2 * spread) * (q(ordered, 0.5) - q(ordered, 0.25)), floor)
    rare = floor * (1 + 2 * spread * len(some) / len(ordered))
    return min((1 + 2 * spread) * q(some, 0.25), rare) if some else rare


@pytest.fixture(scope="module")
def mixed(spark):
    """Rows of few, unlike groups: sketches of so few values are exact."""
    rng = np.random.default_rng(21)
    rows = []
    for g, (lang, source) in enumerate([("en", "a"), ("en", "b"), ("fr", "a"), (None, "b"), ("fr", None)]):
        for k in range(20 + 4 * g):
            own = [w.upper() if rng.random() < 0.03 * g else w for w in rng.choice(cases.WORDS, int(rng.integers(15, 60)))]
            own = [w + "#" if rng.random() < 0.04 * (g % 3) * (k % 4 == 0) else w for w in own]
            text = " ".join(own) + ("\n" + "same line\n" * int(rng.integers(0, 4 + g)) if k % 5 == 0 else "")
            if k % 7 == g:
                text += " " + " ".join(own[:10]) + " " + " ".join(own[:10])
            rows.append((1000 * g + k, text, lang, source))
    rows += [(9000 + k, " ".join(w + "$$" for w in rng.choice(cases.WORDS, 30)), "en", "a") for k in range(12)]
    return rows, quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).cache()


def test_fences_are_their_formula(mixed):
    rows, measured = mixed
    found = measured.collect()
    ratio = lambda r, n, d: r[n] / r[d] if r[d] else 0.0
    fences = quality_rules.fences(measured)
    for mark, keys in (("g", ["lang", "source"]), ("l", ["lang"]), ("a", [])):
        got_ = {tuple(f[f"{mark}_{k}"] for k in keys): f for f in fences[mark].collect()}
        groups = defaultdict(list)
        for r in found:
            groups[tuple(r[k] for k in keys)].append(r)
        assert got_.keys() == groups.keys()
        for key, own in groups.items():
            for name, (n, d, floor) in quality_rules.RATIOS.items():
                assert got_[key][f"{mark}_{name}"] == pytest.approx(plain_fence([ratio(r, n, d) for r in own], floor), rel=1e-9), (key, name)


def test_fences_differ_between_groups(mixed):
    _, measured = mixed
    rows = quality_rules.fences(measured)["g"].collect()
    for name in quality_rules.RATIOS:
        assert len({round(r[f"g_{name}"], 9) for r in rows}) >= 4, name


def test_verdicts_by_brute_force(mixed):
    rows, measured = mixed
    found = measured.collect()
    for min_rows in (1, 40, 1000):
        want = {}
        for r in found:
            failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
            inside = True
            for name, (n, d, floor) in quality_rules.RATIOS.items():
                value = lambda x, n=n, d=d: x[n] / x[d] if x[d] else 0.0
                every = [value(x) for x in found]
                lang = [value(x) for x in found if x["lang"] == r["lang"]]
                group = [value(x) for x in found if (x["lang"], x["source"]) == (r["lang"], r["source"])]
                top = plain_fence(every, floor)
                part = lambda xs: min(len(xs) / min_rows, 1.0)
                by_lang = part(lang) * plain_fence(lang, floor) + (1 - part(lang)) * top
                by_group = part(group) * plain_fence(group, floor) + (1 - part(group)) * by_lang
                tops = [by_group, by_lang] + [top] * (name not in quality_rules.OWN_LANGUAGE)
                inside &= value(r) <= min(tops) * (1 + 1e-12)
            want[r["doc_id"]] = (failed, inside and not failed)
        judged_ = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.judge(measured, min_rows=min_rows).collect()}
        assert judged_ == want
        assert not any(judged_[k][1] for k in range(9000, 9012))


# ---- pages -------------------------------------------------------------------

def page(k, body, extra="", close=True):
    return (f'<!DOCTYPE html><html><head><title>T{k}</title><style>p{{}}</style><script>var a="</p><p>no</p>";</script></head><body>'
            f'<header class="site-header"><p>Site name</p></header><nav><ul><li><a href="/">Home</a></li><li>More {k}</li></ul></nav>'
            f'<!-- <p>hidden</p> --><div class="ad-box">Buy {k}!</div>{extra}{body}'
            f'<aside>See also {k}</aside><form><label>Mail</label><input name="a>b"><button>Go</button></form>'
            f'<div id="comments"><p>first! {k}</p></div><div class="cookie-notice">We use cookies</div><footer>&copy; {k}</footer>'
            + ("</body></html>" if close else ""))


def test_extraction(spark, empty):
    rows = []
    for k in range(12):
        paras = "".join(f"<p>Para {i} of <b>page</b>&nbsp;{k} &lt;tag&gt;&amp;\n more<br>line" + ("</p>" if i % 2 else "") for i in range(1 + k % 4))
        rows.append((k, f"https://a.example.com/{k}", page(k, f"<article><h1>Title &eacute;{k}</h1>{paras}</article>", close=k % 3 > 0)))
    for k in range(12, 20):
        rows.append((k, f"http://B.example.com:80/{k}", page(k, f"<div class=\"text\"><p>Story {k}</p>" + "<p>again</p>" * (k % 3) + "</div>",
                                                            "<div>Our motto</div>" * (k % 2))))
    rows += [(30, None, "<p>x &amp; y"), (31, "nonsense", ""), (32, "http://c.example.com", None), (33, "http://c.example.com/2", "plain <text"),
             (0, rows[0][1], rows[0][2]),
             (40, "https://a.example.com/x", page(40, "<div><p>No article here</p></div>")),
             (41, "https://e.example.com/", page(41, '<div class="page-wrap"><header><p>Logo</p></header><div id="main-content"><h2>Head</h2>'
                                                     '<div class="post-body">Body<ul><li>one<li>two</ul></div><div class="related">more</div></div>'
                                                     '<div>Loose</div></div>')),
             (42, "https://e.example.com/2", '<main><header><h1>Kept</h1></header><p>A<script>x</script>B <span class="ad">C</span></p></main><p>D</p>'),
             (34, "http://d.example.com/", "<article>" + "<p>word</p>" * 3000)]
    pages = spark.createDataFrame([r + ("x", "y") for r in rows], "page_id long, url string, html string, host string, text string")
    wrappers = html_extraction.infer(pages).cache()
    found = html_extraction.extract(pages, wrappers).collect()
    texts = {r["page_id"]: r["text"] for r in found}
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found)
    for k in range(12):
        want = [f"Title é{k}"] + [f"Para {i} of page {k} <tag>& more line" for i in range(1 + k % 4)]
        assert texts[k] == "\n".join(want)
    for k in range(12, 20):
        assert texts[k] == "\n".join([f"Story {k}"] + ["again"] * (k % 3))
    assert texts[30] == "x & y" and texts[31] == texts[32] == "" and texts[33] == "plain <text"
    assert texts[34] == "\n".join(["word"] * 3000)
    assert texts[40] == "No article here" and texts[41] == "Head\nBody\none\ntwo" and texts[42] == "Kept\nAB"
    same = html_extraction.extract(pages, wrappers, max_wrapper_mb=-1)
    assert got(same) == got(html_extraction.extract(pages, wrappers))
    none = spark.createDataFrame([], pages.schema)
    assert html_extraction.extract(none, html_extraction.infer(none)).count() == 0


def test_expression_has_optional_and_repeated_parts():
    items = lambda page, n: [[g, list(map(html_extraction.mark, t)), False, n, False] for g, t in html_extraction.summary(page)]
    one = items("<h1>a</h1><p>x</p><p>y</p><div>same</div>", 3)
    two = items("<h1>b</h1><div>same</div><h2>new</h2>", 1)
    merged = html_extraction.align(one, two)
    assert [tuple(map(repr, x)) for x in merged] == [tuple(map(repr, x)) for x in [
        [["h1"], [], False, 4, True], [["p"], ["x", "y"], True, 3, False], [["div"], ["same"], False, 4, False], [["h2"], ["new"], True, 1, False]]]
    # A text that all pages have inside a group whose other texts differ.
    three = html_extraction.align(items("<p>x</p><p>z</p>", 1), items("<p>y</p><p>z</p><p>q</p>", 1))
    assert three == [[["p"], ["z"], False, 2, True]]
    assert html_extraction.fold(["dt", "dd", "dt", "dd", "p"]) == [("dt", "dd"), ("p",)]
    made = json.loads(json.dumps(html_extraction.wrapper(merged, 4, [0, 0, 0, 0])))
    assert made["items"] == [[["h1"], []], [["p"], ["x", "y"]], [["div"], ["same"]], [["h2"], []]] and made["trusted"] == [2, 1]
    assert all(t == [] for _, t in html_extraction.wrapper(merged, 40, [0, 0, 0, 0])["items"])
    assert html_extraction.wrapper(merged, 4, [10, 21, 10, 20])["trusted"] == [1]


def texts_of(spark, pages):
    """Texts by page number of pages of one host."""
    table = spark.createDataFrame([(k, f"https://copies.example.com/{k}", html) for k, html in pages], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html_extraction.extract(table, html_extraction.infer(table)).collect()}


def test_copies_are_no_template(spark):
    motto = "<div>Our motto is long enough to be hashed</div>"
    copy = "<nav>Menu {}</nav>" + motto + "<h2>Copied title</h2><p>A copied text, longer than its mark.</p><p>end</p>"
    pages = [(k, copy.format(k)) for k in range(6)]
    pages += [(k, f"{motto}<p>Story {k}</p>") for k in range(6, 12)]
    found = texts_of(spark, pages)
    assert all(found[k] == "Copied title\nA copied text, longer than its mark.\nend" for k in range(6))
    assert all(found[k] == f"Story {k}" for k in range(6, 12))


def test_template_texts_inside_articles(spark):
    promotion = "<p>Read our newsletter, it is free of charge.</p>"
    pages = [(k, f"<article><h1>Title {k}</h1><p>Text {k}</p>{promotion}<p>More {k}</p></article>") for k in range(8)]
    assert texts_of(spark, pages) == {k: f"Title {k}\nText {k}\nMore {k}" for k in range(8)}
    # A paragraph that only some articles share is theirs.
    pages = [(k, f"<article><p>Text {k}</p>{promotion if k < 5 else ''}</article>") for k in range(8)]
    assert texts_of(spark, pages)[2] == "Text 2\nRead our newsletter, it is free of charge."


def test_headings_over_content_stay(spark):
    pages = [(k, f'<div class="post"><h1>Title {k}</h1><h2>Summary</h2><p>text {k}</p><h3>Partners</h3><p>The same partners</p></div>')
             for k in range(8)]
    assert texts_of(spark, pages) == {k: f"Title {k}\nSummary\ntext {k}" for k in range(8)}


def test_names_only_go_first_where_they_hold_the_text(spark):
    body = "A long text about the matter of the page. " * 5
    pages = [(k, f'<div class="text"><p>{body}{k}</p></div><div class="story-teaser">teaser</div>') for k in range(6)]
    assert texts_of(spark, pages) == {k: f"{body}{k}" for k in range(6)}
    pages = [(k, f'<div class="text"><p>{body}{k}</p></div><div class="entry">short {k}</div>') for k in range(6)]
    assert texts_of(spark, pages) == {k: f"{body}{k}\nshort {k}" for k in range(6)}
    pages = [(k, f'<div class="text"><p>loose {k}</p></div><div class="entry">{body}{k}</div>') for k in range(6)]
    assert texts_of(spark, pages) == {k: f"{body}{k}" for k in range(6)}


def test_no_article_text_is_lost_without_article_tags(spark):
    """An independent reading: pages made from parts that are known to be content or not."""
    import random
    rng = random.Random(8)
    pages, want = [], {}
    for k in range(60):
        own = [f"Sentence {rng.randrange(10 ** 6)} of page {k}." for _ in range(rng.randint(1, 9))]
        parts = [f"<p>{t}</p>" if rng.random() < 0.7 else f"<ul><li>{t}</li></ul>" for t in own]
        pages.append((k, f'<nav>Home {k}</nav><div>Slogan of the site</div><div class="body{k % 2}">{"".join(parts)}</div><footer>Imprint</footer>'))
        want[k] = "\n".join(own)
    pages += [(100 + k, pages[3][1]) for k in range(40)]        # copies of one page
    want |= {100 + k: want[3] for k in range(40)}
    assert texts_of(spark, pages) == want


def test_expressions_merge_in_small_groups(spark, monkeypatch):
    pages = [(k, f"<div>Motto</div>{'<h2>Head %d</h2>' % k * (k % 3)}{'<p>Text %d</p>' % k * (1 + k % 4)}") for k in range(40)]
    whole = texts_of(spark, pages)
    monkeypatch.setattr(html_extraction, "MERGED", 2)
    assert texts_of(spark, pages) == whole
    assert all("Motto" not in t and f"Text {k}" in t for k, t in whole.items())


def test_layout_classes_are_no_junk(spark):
    marks = ['<body class="has-sidebar search-open"><p>{}</p>', '<body class="no-sidebar sidebar"><div><p>{}</p></div>',
             '<body><article class="post comments-open"><p>{}</p></article>', '<div class="content-with-sidebar"><p>{}</p></div>',
             '<html class="with-cookie-banner"><main class="main sidebar-right header"><p>{}</p></main>',
             '<body class="comments-closed"><div class="post type-post category-social tag-widget-5"><p>{}</p></div>']
    junk = '<div class="ad-box">no</div><div id="sidebar-left"><p>no</p></div><div class="site-header">no</div><p>yes <span class="ad">no</span></p>'
    assert texts_of(spark, enumerate(x.format(f"Text {k}") for k, x in enumerate(marks))) == {k: f"Text {k}" for k in range(len(marks))}
    assert texts_of(spark, [(0, junk), (1, '<div class="category-menu">no</div>')]) == {0: "yes", 1: ""}


# ---- pipeline ----------------------------------------------------------------

def test_pipeline_stages(spark, rows, tmp_dir):
    import test_dedup

    names = ["language_id", "line_dedup", "jaccard_join", "decontamination", "source_mixing"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names and corpus_pipeline.ORACLE_SQL is None
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    unique = [r for r in rows if r[0] is not None]
    cases.table(spark, unique).select(*cols).write.parquet(f"{tmp_dir}/documents.parquet")
    item = " ".join(normal(rows[11][1])[:12])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        step(spark, docs, tmp_dir).write.parquet(f"{tmp_dir}/{name}")
        docs = spark.read.parquet(f"{tmp_dir}/{name}")
        seen[name] = (before, docs.collect())
        if name != "source_mixing":
            assert docs.columns == cols
    before, after = seen["language_id"]
    assert {r["doc_id"] for r in after} <= {r[0] for r in before if r[1] and any(map(str.isalpha, r[1]))}
    _, guesses = plain_bayes(before, language_id.BUCKETS)
    sure = {d: lang != "und" and p >= 0.5 for d, lang, p in guesses if abs(p - 0.5) > 1e-3}
    assert len(sure) > 0.9 * len(before) and {r["doc_id"] for r in after} & sure.keys() == {d for d, keep in sure.items() if keep}
    before, after = seen["line_dedup"]
    want = [(d, t) for d, _, _, t in test_dedup.line_contract(before)]
    assert sorted(((r["doc_id"], r["text"]) for r in after), key=repr) == sorted(want, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = seen["jaccard_join"]
    assert len(after) == test_dedup.set_contract(before)[1]
    before, after = seen["decontamination"]
    want = [x[0] for x in hit_contract(before, [(1, item)]) if not x[5]]
    assert sorted(r["doc_id"] for r in after) == sorted(want) and len(after) < len(before)
    before, after = seen["source_mixing"]
    ids = {r[0] for r in before}
    assert after and all(set(r["doc_ids"]) <= ids and len(cases.words(r["text"])) == r["n_words"] for r in after)
    # Every block is a stretch of its documents' words, the same each time; a source's slots come near its target.
    own = {r[0]: cases.words(r[1]) for r in before}
    texts = {}
    for r in after:
        assert texts.setdefault((r["source"], r["block"]), r["text"]) == r["text"]
        assert 4 in r["doc_ids"] or f' {r["text"]} ' in f' {" ".join(w for d in r["doc_ids"] for w in own[d])} '
    size = Counter()
    for r in before:        # two documents have the id 4
        size[r[3]] += len(cases.words(r[1]))
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(size, key=NULLS_LAST))}
    goal, taken = mixing.targets(dict(size), weights), Counter()
    for r in after:
        taken[r["source"]] += r["n_words"]
    assert all(abs(taken[s] - goal[s]) <= 0.05 * goal[s] + 3 * mixing.BLOCK_WORDS for s in goal)
    assert corpus_pipeline.run(spark, tmp_dir).count() == len(after)


def test_registered():
    from tickvault.llm.queries import ORACLES, QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
