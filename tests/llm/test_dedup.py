"""Line, substring and byte dedup and the Jaccard join against brute force."""

import hashlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

from tickvault.llm import jaccard_join, line_dedup, repeat_sketch, substring_dedup, suffix_dedup
from tickvault.llm.common import leftmost_min, window_hashes
from tickvault.llm.components import components

sha = lambda b: hashlib.sha256(b).hexdigest()


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_windows_and_minima():
    rng = np.random.default_rng(0)
    items = rng.integers(0, 3, 400).astype(np.uint64)
    for size in (1, 5, 35):
        h = window_hashes(items, size)
        plain = [tuple(items[i:i + size]) for i in range(len(items) - size + 1)]
        assert len(set(plain)) == len(set(h.tolist())) == len(set(zip(plain, h.tolist())))
    values = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    for width in (1, 2, 18, 169):
        assert leftmost_min(values, width).tolist() == [i + int(np.argmin(values[i:i + width])) for i in range(301 - width)]


def line_contract(rows):
    holders = defaultdict(list)
    keys = {}
    for i, r in enumerate(rows):
        keys[i] = [cases.lower(x.strip(" \t\n\x0b\x0c\r")) for x in (r[1] or "").split("\n")]
        for k in {k for k in keys[i] if len(k) >= 20}:
            holders[k].append(r[0])
    keeper = {k: max((h for h in hs if h is not None), default=None) for k, hs in holders.items() if len(hs) >= 3}
    out = []
    for i, r in enumerate(rows):
        lines = (r[1] or "").split("\n")
        kept = [x for x, k in zip(lines, keys[i]) if k not in keeper or keeper[k] == r[0]]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_lines(docs, rows, empty):
    want = line_contract(rows)
    lists = line_dedup.find(docs)
    assert got(line_dedup.digests(docs, lists)) == sorted([(d, n, k, sha(t.encode())) for d, n, k, t in want], key=repr)
    assert any(k for _, _, k, _ in want)
    clean = line_dedup.dedup_lines(docs, lists)
    assert clean.columns == docs.columns
    texts = [(d, t if r[1] is not None else None) for (d, _, _, t), r in zip(want, rows)]
    assert got(clean.select("doc_id", "text")) == sorted(texts, key=repr)
    assert line_dedup.digests(empty, line_dedup.find(empty)).count() == 0


def test_lines_without_filters(docs, rows):
    dups = line_dedup.repeated(line_dedup.references(docs)).cache()
    filters = line_dedup.build_filters(dups, 3)
    one = got(line_dedup.digests(docs, line_dedup.drop_lists(docs, dups, filters, 3)))
    assert one == got(line_dedup.digests(docs, line_dedup.drop_lists(docs, dups, filters, 3, max_filter_mb=-1)))
    assert one == got(line_dedup.digests(docs, line_dedup.find(docs)))


def test_cuckoo_filter():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(-2 ** 63, 2 ** 63 - 1, 3000))
    made = line_dedup.CuckooFilter.build(keys)
    assert made.contains(keys).all()
    assert made.contains(rng.integers(-2 ** 63, 2 ** 63 - 1, 20000)).mean() < 0.01
    for k in keys[:1500]:
        made.delete(int(k))
    assert made.contains(keys[1500:]).all() and made.contains(keys[:1500]).mean() < 0.02


def members(store, dups):
    """Every key to drop is in its shard's filter, and nothing else is."""
    filters = line_dedup.load_filters(store.filters.collect())
    assert all(filters[int(h % store.shards)].contains(np.array([h]))[0] for h in np.array([r[0] for r in dups], np.int64))
    assert sum(int((f.slots > 0).sum()) for f in filters.values()) == len(dups)


def test_line_store_is_reversible(spark, docs, tmp_dir):
    store = line_dedup.LineStore(spark, tmp_dir, shard_keys=30)
    first, second = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    store.insert("one", first)
    assert store.shards > 2
    before = got(store.dups())
    lists = got(line_dedup.digests(first, store.drop_lists(first)))
    assert lists == got(line_dedup.digests(first, line_dedup.find(first)))
    store.insert("two", second)
    both = docs.where("doc_id is not null")
    assert got(line_dedup.digests(both, store.drop_lists(both))) == got(line_dedup.digests(both, line_dedup.find(both)))
    members(store, got(store.dups()))
    assert got(store.dups()) != before and len(got(store.dups())) >= len(before)
    again = line_dedup.LineStore(spark, tmp_dir, shard_keys=30)         # opened anew
    assert got(again.dups()) == got(store.dups())
    again.delete("two-out", second)
    assert got(again.dups()) == before
    assert got(line_dedup.digests(first, again.drop_lists(first))) == lists
    members(again, before)


def test_line_store_names_and_repeats(spark, tmp_dir):
    line = "a line that is long enough to count"
    table = lambda ids: spark.createDataFrame([(k, f"{line}\nown line of document number {k}") for k in ids], "doc_id long, text string")
    total = lambda s: s.refs().agg({"n": "sum"}).first()[0] or 0
    holders = lambda s: {r["n_docs"] for r in s.dups().collect()}
    store = line_dedup.LineStore(spark, tmp_dir)
    store.insert("one", table(range(6)))
    assert total(store) == 12
    store.delete("one", table([0]))                 # a deletion may have an insertion's name
    assert total(store) == 10 and holders(store) == {5}
    store.delete("one", table([0]))
    store.delete("other", table([0]))               # gone already
    store.insert("more", table([0]))
    assert total(store) == 12 and holders(store) == {6}
    store.insert("more", table([0, 7]))             # replaces the batch
    assert total(store) == 14 and holders(store) == {7}
    store = line_dedup.LineStore(spark, tmp_dir)
    assert total(store) == 14
    store.delete("all", table(range(8)))
    assert total(store) == 0 and store.dups().count() == 0
    members(store, [])
    store.insert("late", table(range(20, 24)))
    assert holders(store) == {4}
    members(store, got(store.dups()))


def test_a_full_filter_is_built_anew(spark, tmp_dir):
    store = line_dedup.LineStore(spark, tmp_dir)
    lines = [f"line number {i} of a long list" for i in range(400)]
    rows = [(k, "\n".join(lines[:20 if k < 3 else 400])) for k in range(6)]
    table = lambda own: spark.createDataFrame(own, "doc_id long, text string")
    store.insert("few", table(rows[:3]))
    members(store, got(store.dups()))
    store.insert("many", table(rows[3:]))
    assert store.dups().count() == 400
    members(store, got(store.dups()))


def test_underscore_columns_stay(spark):
    docs = spark.createDataFrame([(1, "one two three four five six", "x", 7, "en"), (2, "one two three four five six", "y", 8, "fr"),
                                  (2, "one two three four five six", "y", 8, "de"), (3, "quite another text of five words or more", "z", 9, "en")],
                                 "doc_id long, text string, _row_key string, _stays long, _own0 string")
    for _ in range(2):
        kept = jaccard_join.keep_one(docs.repartition(3))
        assert kept.columns == docs.columns
        assert got(kept) == [(1, "one two three four five six", "x", 7, "en"), (3, "quite another text of five words or more", "z", 9, "en")]
    twins = docs.where("doc_id = 2")
    assert got(jaccard_join.keep_one(twins)) == [(2, "one two three four five six", "y", 8, "de")]


def test_words_cut(docs, rows, empty):
    own = [cases.words(r[1]) for r in rows]
    counts = cases.window_counts(own, 35)
    want = []
    for r, w in zip(rows, own):
        mask = cases.repeated_mask(w, 35, counts)
        want.append((r[0], len(w), sum(mask), sha(" ".join(x for x, m in zip(w, mask) if not m).encode())))
    found = substring_dedup.RepeatedWindows(docs)
    assert got(substring_dedup.digests(found)) == sorted(want, key=repr)
    assert 0 < sum(n for _, _, n, _ in want) < sum(map(len, own))
    assert substring_dedup.cleaned(found).count() == len(rows)
    assert substring_dedup.digests(substring_dedup.RepeatedWindows(empty)).count() == 0


def test_full_sketch_loses_nothing(docs, monkeypatch):
    want = got(substring_dedup.digests(substring_dedup.RepeatedWindows(docs)))
    monkeypatch.setattr(repeat_sketch, "slots_for", lambda *_: 64)
    assert got(substring_dedup.digests(substring_dedup.RepeatedWindows(docs))) == want


def byte_contract(rows):
    own = [(r[1] or "").encode() for r in rows]
    counts = Counter(x[i:i + 200] for x in own for i in range(len(x) - 199))
    out = []
    for r, x in zip(rows, own):
        mask = np.zeros(len(x), bool)
        for i in range(len(x) - 199):
            if counts[x[i:i + 200]] > 1:
                mask[i:i + 200] = True
        spans = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
        out.append((r[0], len(x), int(mask.sum()), spans, sha(bytes(np.frombuffer(x, np.uint8)[~mask]))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_BYTES, 0])
def test_bytes_cut(docs, rows, empty, hot):
    want = byte_contract(rows)
    assert got(suffix_dedup.digests(suffix_dedup.RepeatedBytes(docs, hot_bytes=hot))) == want
    assert 0 < sum(x[2] for x in want) < sum(x[1] for x in want)
    if hot:
        assert suffix_dedup.digests(suffix_dedup.RepeatedBytes(empty)).count() == 0


def test_slices_do_not_matter(docs, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 150)
    assert got(suffix_dedup.digests(suffix_dedup.RepeatedBytes(docs))) == byte_contract(rows)


def test_merged_transforms():
    rng = np.random.default_rng(1)
    base = bytes(rng.integers(97, 100, 1200).astype(np.uint8))
    contexts = [b"\x00" * 260, b"\x00" * 200, b"ab" * 150, b"x" * 200]
    for _ in range(80):
        at = int(rng.integers(0, 800))
        one = bytearray(base[at:at + int(rng.integers(200, 380))])
        if rng.random() < 0.7:
            one[int(rng.integers(0, len(one)))] = int(rng.integers(0, 256))
        contexts.append(bytes(one))
    counts = Counter(c[i:i + 200] for c in contexts for i in range(len(c) - 199))
    for c, mask in zip(contexts, suffix_dedup.repeated_starts(contexts)):
        assert mask.tolist() == [counts[c[i:i + 200]] > 1 for i in range(len(c) - 199)]


def set_contract(rows):
    sets = []
    for r in rows:
        w = cases.words(cases.lower(r[1] or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[root(i)].append(r[0])
    return [(r[0], len(s), min((x for x in least[root(i)] if x is not None), default=None))
            for i, (r, s) in enumerate(zip(rows, sets))], len(least)


def test_jaccard_components(docs, rows, empty):
    want, groups = set_contract(rows)
    found = jaccard_join.join(docs).select("doc_id", "n_shingles", "component_id")
    assert got(found) == sorted(want, key=repr)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == groups
    assert jaccard_join.join(empty).count() == 0 and jaccard_join.keep_one(empty).count() == 0


def test_chain_of_near_copies_and_small_blocks(spark, monkeypatch):
    """A chain whose ends aren't alike, a star and loose documents, with trees of four classes."""
    monkeypatch.setattr(jaccard_join, "TREE_ROWS", 4)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(60):
        rows.append((k, " ".join(base[:k * 3] + [f"n{k}x{i}" for i in range(3)] + base[k * 3 + 3:]) if k < 30 else
                     " ".join(base[k:k + 120] + [f"t{k % 7}"] * 4)))
    rows += [(100 + k, " ".join(f"u{k}v{i}" for i in range(60)) + " " + " ".join(base[:6])) for k in range(20)]
    want, _ = set_contract(rows)
    assert got(jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
               .select("doc_id", "n_shingles", "component_id")) == sorted(want, key=repr)


def test_count_tree_never_loses():
    rng = np.random.default_rng(2)
    points = rng.poisson(3, (300, jaccard_join.DIMS)).astype(np.uint8)
    points[5, 3] = points[12, 3] = points[14, 9] = jaccard_join.FULL
    points[100:140] = points[100] + rng.integers(0, 2, (40, jaccard_join.DIMS)).astype(np.uint8)
    sizes = points.astype(np.int64).sum(axis=1)
    reach = sizes - rng.integers(0, 60, 300)
    tree = jaccard_join.CountTree(points, sizes, reach)
    found = 0
    for i in range(300):
        bound = np.minimum(points, points[i]).astype(np.int64).sum(axis=1)
        full = (points == 255).any(axis=1) & (points[i] == 255).any()
        want = ((7 * bound >= 3 * (sizes + sizes[i])) | full) & (4 * sizes >= 3 * sizes[i]) & (3 * sizes <= 4 * sizes[i])
        want &= 7 * np.minimum(reach, reach[i]) >= 3 * (sizes + sizes[i])
        assert sorted(tree.near(points[i], sizes[i], reach[i])) == np.flatnonzero(want).tolist()
        found += want.sum()
    assert found > 1000


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(400, 460)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    want = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in found} == want and len(found) == len(want)
