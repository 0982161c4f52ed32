import numpy as np

import cases
from tickvault.llm import jaccard_join, partners, repeat_sketch


def linked(a, b):
    both = len(a & b)
    return 100 * both >= 75 * len(a | b)


def test_what_is_sent_never_hides_a_partner():
    rng = np.random.default_rng(5)
    for n in [*range(1, 40)] * 40:
        own = {int(x) for x in rng.integers(0, 1 << 40, n)}
        other = {x for x in own if rng.random() > rng.choice([0, 0.1, 0.2])} | {int(x) for x in rng.integers(0, 1 << 40, rng.integers(0, 1 + n // 4))}
        if other and linked(own, other):
            a, b = (set(partners.sent(np.array(sorted(s)))) for s in (own, other))
            assert 2 * len(a & b) >= max(len(own), len(other))


def passing(spark, docs, monkeypatch, **sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(partners, name, value)
    return {r["doc_id"] for r in jaccard_join.shingle_sets(docs)[0].where("class IS NOT NULL").collect()}


def test_unlike_documents_are_dropped_whatever_the_sketch_holds(spark, monkeypatch):
    """A sketch of a bounded size, once full, let every document of a large corpus pass: all its shingles
    were then stored and shuffled."""
    rng = np.random.default_rng(7)
    words = [f"w{k}" for k in range(5000)]
    texts = [" ".join(rng.choice(words, 300)) for _ in range(300)]
    near = texts[:20] + [f"{t} more" for t in texts[:10]] + [texts[10].upper(), "one two", "ONE two"]
    docs = spark.createDataFrame([*enumerate(texts + near[20:])], "doc_id long, text string").repartition(3).cache()
    monkeypatch.setattr(repeat_sketch, "MAX_SLOTS", 1 << 14)
    monkeypatch.setattr(repeat_sketch, "MIN_SLOTS", 1 << 14)
    want = {*range(11), *range(300, 313)}
    for sizes in ({}, {"FLUSH": 3000, "MIN_SHARDS": 4}, {"UNKNOWN": 0}, {"BATCH_SETS": 600}):
        assert passing(spark, docs, monkeypatch, **sizes) == want


def test_no_linked_document_is_dropped(spark, docs, rows):
    sets = [(r[0], {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
            for r in rows for w in [cases.words(cases.lower(r[1] or ""))]]
    want = {a for k, (a, x) in enumerate(sets) for j, (_, y) in enumerate(sets) if j != k and x and y and linked(x, y)}
    found = {r["doc_id"] for r in jaccard_join.shingle_sets(docs)[0].where("class IS NOT NULL").collect()}
    assert want <= found
