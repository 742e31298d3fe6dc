"""Overlay of polygons against cells of a fine grid and rectangles."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoalspark.operators import overlay as O
from shoalspark.operators import polygons as Y


def inside(rings, x, y):
    hit = np.zeros(np.shape(x), bool)
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, np.roll(r, -1, 0), strict=True):
            if y1 != y2:
                hit ^= ((y1 > y) != (y2 > y)) & (x < x1 + (x2 - x1) * (y - y1) / (y2 - y1))
    return hit


def shape(draw, n):
    angles = np.sort([draw.uniform(0, 2 * np.pi) for _ in range(n)])
    radius = np.array([draw.uniform(2, 9) for _ in range(n)])
    return np.stack([10 + draw.uniform(-3, 3) + radius * np.cos(angles), 10 + draw.uniform(-3, 3) + radius * np.sin(angles)], 1)


@pytest.mark.parametrize("rule", O.RULES)
def test_pieces_cover_the_cells_of_the_rule(rule):
    draw = random.Random(10)
    x, y = np.meshgrid((np.arange(400) + 0.5) / 20, (np.arange(400) + 0.5) / 20)
    x, y = x + 1e-4, y + 1e-4
    for n in (3, 5, 9, 14):
        a, b = [shape(draw, n), shape(draw, n) / 3 + 7], [shape(draw, n + 1)]
        made = O.pieces(a, b, rule)
        want = np.vectorize(O.RULES[rule])(inside(a, x, y), inside(b, x, y))
        got = sum((inside([p], x, y).astype(int) for p in made), np.zeros(x.shape, int))
        assert got.max() <= 1 and (got == want).mean() > 0.9999
        assert abs(O.area(made) - want.sum() / 400) < 0.6
    both = {r: O.area(O.pieces(a, b, r)) for r in O.RULES}
    own = [O.area(O.pieces(p, [], "union")) for p in (a, b)]
    assert abs(both["union"] + both["intersection"] - sum(own)) < 1e-9 and abs(both["difference"] + both["intersection"] - own[0]) < 1e-9


def test_pairs_of_tables_and_those_that_touch(spark):
    boxes = lambda rows, i: spark.createDataFrame(rows, f"{i} int, x0 double, y0 double, x1 double, y1 double").select(i, Y.rectangle(*map(F.col, ("x0", "y0", "x1", "y1"))).alias("ring"))
    left = boxes([(1, 0.0, 0.0, 10.0, 10.0), (2, 20.0, 0.0, 30.0, 10.0)], "a_id")
    right = boxes([(5, 5.0, 5.0, 25.0, 15.0), (6, 10.0, 0.0, 12.0, 3.0), (7, 2.0, 2.0, 3.0, 4.0)], "b_id")
    got = {(r["a_id"], r["b_id"]): r["area"] for r in O.overlay(left, right, 7.0).collect()}
    assert got == {(1, 5): 25.0, (2, 5): 25.0, (1, 7): 2.0}
    less = {(r["a_id"], r["b_id"]): (r["area"], len(r["pieces"])) for r in O.overlay(left, right, 7.0, "difference").collect()}
    assert less[1, 7] == (98.0, 4) and less[1, 6][0] == 100.0


def test_weaker_winds_keep_what_stronger_ones_leave(spark):
    rows = [("a", 64, 2.0, 2.0, 4.0), ("a", 34, 0.0, 0.0, 10.0), ("a", 50, 1.0, 1.0, 6.0), ("a", 34, 8.0, 0.0, 10.0), ("b", 34, 0.0, 0.0, 1.0), ("a", 20, 3.0, 3.0, 2.0)]
    df = spark.createDataFrame(rows, "storm string, wind int, x double, y double, w double").withColumn("ring", Y.rectangle(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("w")))
    for size in (3.0, 100.0):
        parts = O.outer_parts(df, ["storm"], "wind", size).groupBy("storm", "wind").agg(F.sum("area").alias("area"))
        got = {(r["storm"], r["wind"]): r["area"] for r in parts.collect()}
        assert got == pytest.approx({("a", 64): 16.0, ("a", 50): 20.0, ("a", 34): 180.0 - 36.0, ("b", 34): 1.0})
