"""Quantiles of groups, nearest neighbours and nearest sites against plain Python."""

import random

import numpy as np

from shoalspark.operators import neighbours as N
from shoalspark.operators import selection as Q


def test_quantiles_of_a_hot_group_are_exact(spark):
    draw = random.Random(6)
    rows = [("hot", draw.choice([draw.gauss(0, 1), 7.0, 7.0, draw.uniform(0, 1e9)])) for _ in range(5000)]
    rows += [(g, float(draw.randrange(40))) for g in ("a", "b", None) for _ in range(draw.randrange(1, 60))] + [("nulls", None), ("nan", float("nan")), ("one", 3.0), ("same", 2.0)] + [("same", 2.0)] * 500
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    shares = [0.0, 0.1, 0.5, 0.73, 1.0]
    got = {(r["g"], r["share"]): r["value"] for r in Q.group_quantiles(df, ["g"], "v", shares, buckets=8, gathered=10).collect()}
    groups = {}
    for g, v in rows:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    assert set(got) == {(g, s) for g in groups for s in shares}
    for (g, s), v in got.items():
        assert np.isclose(v, np.quantile(groups[g], s), rtol=1e-12, atol=1e-9), (g, s)
    assert Q.group_quantiles(df, [], "v", [0.5], buckets=16, gathered=5).collect()[0]["value"] == np.median([v for own in groups.values() for v in own])
    assert Q.group_medians(df.limit(0), ["g"], "v").count() == 0


def plain(queries, points, k, others=True):
    made = set()
    for g, q, *f in queries:
        near = sorted((sum((a - b) ** 2 for a, b in zip(f, p[2:], strict=True)), p[1]) for p in points if p[0] == g and (not others or p[1] != q))
        made |= {(g, q, p, n) for n, (_, p) in enumerate(near[:k], 1)}
    return made


def test_neighbours_over_a_partition_equal_all_pairs(spark):
    draw = random.Random(7)
    points = [("hot", i, *(float(draw.randrange(6)) if i % 3 else draw.gauss(0, 1) for _ in range(3))) for i in range(700)]
    points += [("same", 10_000 + i, 1.0, 1.0, 1.0) for i in range(90)] + [("few", 20_000 + i, float(i), 0.0, 0.0) for i in range(3)]
    queries = [p for p in points if p[1] % 5 == 0] + [("none", 5, 0.0, 0.0, 0.0)]
    p = spark.createDataFrame([*points, ("hot", 900, None, 1.0, 1.0), (None, 901, 1.0, 1.0, 1.0)], "g string, p_id long, a double, b double, c double").repartition(4)
    q = spark.createDataFrame(queries, "g string, q_id long, a double, b double, c double")
    for leaf_rows in (10, 10_000):
        got = {(r["g"], r["q_id"], r["p_id"], r["n"]) for r in N.nearest_rows(q, p, 4, ["g"], ["a", "b", "c"], leaf_rows=leaf_rows).collect()}
        assert got == plain(queries, points, 4), leaf_rows


def test_sites_nearest_to_cells_and_their_ends(spark):
    draw = random.Random(8)
    sites = [(i, float(draw.randrange(300)), float(draw.randrange(300))) for i in range(60)] + [(99, 0.0, 0.0), (98, 0.0, 0.0), (97, 150.0, 0.0), (96, 300.0, 0.0), (95, 0.0, 300.0), (94, 300.0, 300.0)]
    s = spark.createDataFrame(sites, "site_id long, x double, y double").repartition(3)
    cells = spark.createDataFrame([(r, c) for r in range(-3, 30) for c in range(-2, 30)], "row int, col int")
    border = {i for i, x, y in sites if x in (0, 300) or y in (0, 300)}
    assert {r["site_id"] for r in N.hull_sites(s).collect()} == border
    expected = {}
    for r in range(-3, 30):
        for c in range(-2, 30):
            expected[r, c] = min((((c + 0.5) * 10 - x) ** 2 + ((r + 0.5) * 10 - y) ** 2, i) for i, x, y in sites)[1]
    for ended in (False, True):
        got = {(r["row"], r["col"]): r["site_id"] for r in N.nearest_site(cells, s, 10.0, ended, leaf_rows=8).collect()}
        assert got == {k: v for k, v in expected.items() if not ended or v not in border}
