"""The pipeline's near-copy stage against brute force."""

import numpy as np

import corpus_pipeline
from shoalspark.llm import jaccard, simhash


def _sets(texts):
    words = [(t or "").lower().split() for t in texts]
    return [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]


def _components(texts):
    sets, label = _sets(texts), list(range(len(texts)))
    pairs = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if (a == b) or len(a & b) >= 0.8 * len(a | b)]
    moved = True
    while moved:
        moved = False
        for i, j in pairs:
            low = min(label[i], label[j])
            moved |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return label


def _texts():
    """Copies of texts with one to ten words of 120 changed: similarities on both sides of 0.8, and a crowd of near copies."""
    rng = np.random.default_rng(3)
    texts = []
    for changed in [1, 2, 3, 4, 5, 10] * 8:
        one = [f"w{v}" for v in rng.integers(0, 5000, 120)]
        other = list(one)
        for at in rng.choice(120, changed, replace=False):
            other[at] = f"x{rng.integers(0, 5000)}"
        texts += [" ".join(one), " ".join(other)]
    crowd = [f"c{v}" for v in range(150)]
    texts += [" ".join([*crowd[:k], f"y{k}", *crowd[k + 1 :]]) for k in range(100)]
    return [*texts, "few words", "Few  words", "other words", "", None]


def test_stage_keeps_one_of_each_component(spark):
    texts = _texts()
    docs = spark.createDataFrame([(i, t, i % 3) for i, t in enumerate(texts)], "doc_id long, text string, other int")
    expected = sorted(set(_components(texts)))
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == expected and all(r.text == texts[r.doc_id] for r in kept)
    rows = {r.doc_id: r.root for r in jaccard.near_duplicates(docs, group_bytes=20_000).collect()}
    ours = [rows[i] for i in range(len(texts))]
    assert [ours.index(r) for r in ours] == _components(texts)


def test_rows_that_share_an_id_are_told_apart(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    docs = spark.createDataFrame([(1, b), (2, a), (2, b), (2, "something else altogether"), (None, a), (None, "alone without an id"), (None, "alone without an id")], "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(kept, key=str) == sorted([(1, b), (2, a), (2, "something else altogether"), (None, "alone without an id")], key=str)


def test_simhash_trees_find_what_lies_within_their_radius(spark):
    rng = np.random.default_rng(5)
    texts = []
    for k in range(60):
        one = [f"w{v}" for v in rng.integers(0, 5000, 400)]
        texts += [" ".join(one), " ".join([*one[:k], f"x{k}", *one[k + 1 :]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    fps = [simhash.voted(jaccard.shingles(t)) for t in texts]
    within = [bin((a ^ b) & (1 << 64) - 1).count("1") <= simhash.RADIUS for a, b in zip(fps[::2], fps[1::2], strict=True)]
    roots = {r.doc_id: r.root for r in jaccard.near_duplicates(docs, bands=0).collect()}
    assert sum(within) > 10 and [roots[2 * k] == roots[2 * k + 1] for k in range(60)] == within
    assert len(set(roots.values())) == len(texts) - sum(within)
    roots = {r.doc_id: r.root for r in jaccard.near_duplicates(docs).collect()}
    assert len(set(roots.values())) == 60
