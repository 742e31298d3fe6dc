"""Joins of crowded tiles against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoalspark.operators import kernels as K
from shoalspark.operators import lidar as L
from shoalspark.operators import overlay as O
from shoalspark.operators import polygons as Y
from shoalspark.operators import spatial as P

RING = "array<struct<x:double,y:double>>"


def _rows(spark, rings, ident):
    return spark.createDataFrame([(i, [{"x": float(x), "y": float(y)} for x, y in r]) for i, r in enumerate(rings)], f"{ident} int, ring {RING}")


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_crowded_tiles_are_dealt_to_blocks(spark, block_rows):
    rng = np.random.default_rng(block_rows)
    rings = [(c + rng.uniform(0, 6, (3, 2))).round() for c in rng.uniform(0, 20, (40, 2))]
    boxes = [[(x, y), (x + 3, y), (x + 3, y + 2), (x, y + 2)] for x, y in rng.integers(0, 20, (30, 2))]
    points = [(i, float(x), float(y), f"p{i}") for i, (x, y) in enumerate(rng.integers(0, 20, (60, 2)) + 0.25)] + [(99, None, 1.0, None)]
    p = spark.createDataFrame(points, "id int, x double, y double, name string")
    some, a = _rows(spark, rings, "poly_id"), _rows(spark, boxes, "a_id")
    plain = p.crossJoin(some).where(Y.holds(F.col("ring"), F.col("x"), F.col("y"))).select("id", "x", "y", "name", "poly_id")
    wanted = sorted(map(tuple, plain.collect()))
    got = Y.within(p, some, 10.0, block_rows)
    assert got.columns == plain.columns and sorted(map(tuple, got.collect())) == wanted and wanted
    assert sorted(r.id for r in Y.clip(p, some, 10.0, block_rows).collect()) == sorted({w[0] for w in wanted})
    b = some.withColumnRenamed("poly_id", "b_id")
    meet = sorted(map(tuple, a.crossJoin(b.withColumnRenamed("ring", "r")).where(Y.touch(F.col("ring"), F.col("r"))).select("a_id", "b_id").collect()))
    assert sorted(map(tuple, Y.intersecting(a, b, 10.0, block_rows).collect())) == meet and meet


def test_near_points_of_crowded_places(spark):
    rng = np.random.default_rng(5)
    x, y = np.concatenate([rng.integers(0, 40, (300, 2)), rng.uniform(7, 8, (300, 2)), np.full((40, 2), 9.0)]).astype(float).T
    weight, ids = rng.integers(-5, 9, len(x)), rng.permutation(len(x)) - 50
    d2 = (x[:, None] - x) ** 2 + (y[:, None] - y) ** 2
    n, total = K.sums_near(x, y, x, y, weight, 3.0, 1000)
    assert (n == (d2 <= 9).sum(1)).all() and (total == ((d2 <= 9) * weight).sum(1)).all()
    table = spark.createDataFrame([(int(i), float(a), float(b)) for i, a, b in zip(ids, x, y, strict=True)], "a_id int, x double, y double")
    for others in (False, True):
        allowed = np.where((d2 <= 9) & ~(others & np.eye(len(x), dtype=bool)), d2, np.inf)
        wanted = {int(i): None if np.isinf(row.min()) else int(ids[row == row.min()].min()) for i, row in zip(ids, allowed, strict=True)}
        assert {r.a_id: r.b_id for r in P.nearest(table, table.withColumnRenamed("a_id", "b_id"), 3.0, others, block_rows=100).collect()} == wanted


def test_band_means_of_equal_and_many_places(spark):
    rng = np.random.default_rng(8)
    targets, curve = rng.integers(-40, 90, 80) / 4, [(float(x) / 4, None if k % 9 == 0 else float(k)) for k, x in enumerate(rng.integers(-40, 90, 200))]
    t = spark.createDataFrame([(i, float(x)) for i, x in enumerate([*targets, 1e6])], "t_id int, x double")
    wanted = {}
    for i, x in enumerate(targets):
        near = [v for c, v in curve if abs(x - c) <= 2.0]
        known = [v for v in near if v is not None]
        if near:
            wanted[i] = (sum(known) / len(known) if known else None, len(near))
    got = {r.t_id: (r["mean"], r["n"]) for r in P.band_mean(t, spark.createDataFrame(curve, "x double, value double"), 2.0, block_rows=10).collect()}
    assert got == {i: (m if m is None else pytest.approx(m), n) for i, (m, n) in wanted.items()}


def test_time_frames_with_and_without_a_parser(spark):
    body = "<description>a{0}</description><start-date-time> 2001 </start-date-time>"
    docs = [f"<x><time-frame>{body.format('')}</time-frame></x>", f"<x><time-frame id='1'>{body.format(' &amp; b')}</time-frame></x>", "<x><time-frame><more><description>c</description></more></time-frame></x>", "<x><time-frame></time-frame></x>"]
    got = spark.createDataFrame([(d,) for d in docs], "x string").select(L.time_frames(F.col("x"), F.lit("none")).alias("t")).collect()
    assert [tuple(r.t[0]) for r in got] == [("a", " 2001 ", None), ("a & b", " 2001 ", None), ("none", None, None), ("none", None, None)]


def test_shared_areas_are_those_of_the_overlay(spark):
    rng = np.random.default_rng(4)
    star = lambda n: [(5 + r * np.cos(t), 5 + r * np.sin(t)) for r, t in zip(rng.uniform(1, 6, n), np.sort(rng.uniform(0, 6.28, n)), strict=True)]
    box = [(1, 1), (6, 1), (6, 4), (1, 4)]
    some, more = [star(n) for n in (3, 5, 9)] + [box], [star(n) for n in (4, 7)] + [box]
    a, b = _rows(spark, some, "a_id"), _rows(spark, more, "b_id")
    got = {(r.a_id, r.b_id): (r.shared, r.rest) for r in O.shared_areas(a, b, 4.0, block_rows=2).collect()}
    arrays = lambda rings: [np.array(r, float) for r in rings]
    for i, p in enumerate(arrays(some)):
        for j, q in enumerate(arrays(more)):
            both, rest = (O.area(O.pieces([p], [q], rule)) for rule in ("intersection", "difference"))
            assert got.get((i, j), (0.0, rest)) == (pytest.approx(both, abs=1e-9), pytest.approx(rest, abs=1e-9))
    assert got[3, 2] == (15.0, 0.0)


def test_a_crowded_tile_is_not_copied_over_and_over(spark, monkeypatch):
    rng = np.random.default_rng(3)
    places, corners = rng.random((3000, 2)) * 10, rng.random((1000, 2)) * 8
    p = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(places)], "id long, x double, y double").repartition(3)
    rings = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(corners)], "poly_id long, u double, v double")
    boxes = rings.select("poly_id", Y.rectangle(F.col("u"), F.col("v"), F.col("u") + 1, F.col("v") + 1).alias("ring"))
    sent, dealt = [], Y._dealt
    monkeypatch.setattr(Y, "_dealt", lambda *a: sent.append(dealt(*a)) or sent[-1])
    got = [tuple(r) for r in Y.within(p, boxes, 10.0, 50).select("id", "poly_id").collect()]
    inside = (places[:, None] > corners[None]).all(2) & (places[:, None] < corners[None] + 1).all(2)
    assert sorted(got) == list(zip(*(k.tolist() for k in np.nonzero(inside)), strict=True))
    assert len(sent) == 2 and sum(df.count() for df in sent) <= 2 * (3000 + 1000)
