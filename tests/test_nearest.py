"""The nearest other point against brute force."""

import numpy as np

import __spark_entry__ as entry_module


def test_every_order_is_asked_and_offered(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey").collect()
    points = [(r[0], r[0] * 7919 % 10007, r[1] * 104729 % 10009) for r in rows]
    expected = {i: min(((x - u) ** 2 + (y - v) ** 2, j) for j, u, v in points if j != i) for i, x, y in points}
    got = {r.id: r for r in entry_module.queries()["nearest_other_within"](spark, sf).collect()}
    assert got.keys() == expected.keys()
    for i, (d2, j) in expected.items():
        assert (got[i].near, got[i].distance) == ((j, round(d2**0.5, 6)) if d2 <= 100**2 else (None, None))


def test_every_vector_is_asked_for_its_neighbours(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, labels, at = np.array([r.vec_id for r in rows]), np.array([r.label for r in rows]), np.array([r.embedding[:3] for r in rows], float)
    got = {r.vec_id: r.estimate for r in entry_module.queries()["knn_inverse_distance"](spark, sf).collect()}
    expected = {}
    for i, label, place in zip(ids, labels, at, strict=True):
        others = np.flatnonzero((labels == label) & (ids != i))
        d = np.sqrt(((at[others] - place) ** 2).sum(1))
        near = np.lexsort((ids[others], d))[:5]
        w = 1 / (d[near] + 1e-6)
        if len(near):
            expected[i] = (at[others[near], 0] * w).sum() / w.sum()
    assert got.keys() == expected.keys() and len(got) > 100
    assert all(abs(got[i] - e) < 2e-6 for i, e in expected.items())
