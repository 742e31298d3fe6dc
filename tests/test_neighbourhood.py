"""Sums over neighbourhoods and quantiles against brute force, with crowded tiles."""

import numpy as np

from shoalspark.operators import grid as G
from shoalspark.operators import spatial as P
from shoalspark.operators.lineage import cut


def test_crowded_tiles_are_searched_in_blocks(spark):
    rng = np.random.default_rng(5)
    x = np.r_[rng.uniform(-50, 50, 300), np.full(60, 7.0), [25.0, 20.0]]
    y = np.r_[rng.uniform(-50, 50, 300), np.full(60, -3.0), [0.0, 0.0]]
    points = spark.createDataFrame([(i, float(a), float(b), i % 9) for i, (a, b) in enumerate(zip(x, y, strict=True))] + [(999, None, 1.0, 1)], "id long, x double, y double, weight long")
    near = (x[:, None] - x) ** 2 + (y[:, None] - y) ** 2 <= 25
    expected = {i: (int(near[i].sum()), int((np.arange(len(x)) % 9)[near[i]].sum())) for i in range(len(x))}
    for block in (20_000, 25):
        got = {r.id: (r.n, r.total) for r in P.neighbourhood(points, 5.0, block_rows=block).collect()}
        assert got == expected
    assert P.neighbourhood(points.limit(0), 5.0).count() == 0


def test_quantiles(spark):
    z = np.random.default_rng(6).integers(0, 40, 501) / 4
    cells = spark.createDataFrame([(i, 0, float(v)) for i, v in enumerate(z)] + [(900, 0, None)], "row int, col int, z double")
    got = {r.share: r.value for r in G.quantiles(cells, [0.0, 0.15, 0.5, 0.99, 1.0], cut).collect()}
    assert all(abs(v - np.quantile(z, s)) < 1e-9 for s, v in got.items()) and len(got) == 5
    assert G.quantiles(cells.limit(0), [0.5], cut).count() == 0
