"""Labels, holes and outlines of cells against plain flood fills; wide means and convergence on hand-made surfaces."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shoalspark.operators import grid as G
from shoalspark.operators import holes as H
from shoalspark.operators import regions as R


def picture(seed, rows=40, cols=37, share=0.55):
    draw = random.Random(seed)
    return {(r, c) for r in range(-5, rows) for c in range(-3, cols) if draw.random() < share}


def flood(cells):
    of, left = {}, set(cells)
    for start in sorted(cells):
        if start not in left:
            continue
        todo = [start]
        left.discard(start)
        while todo:
            r, c = todo.pop()
            of[r, c] = start
            for n in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if n in left:
                    left.discard(n)
                    todo.append(n)
    return of


@pytest.mark.parametrize("block", [7, 512])
def test_labels_equal_a_flood_fill(spark, block):
    cells = picture(1)
    df = spark.createDataFrame([*cells, *list(cells)[:9]], "row int, col int").repartition(3)
    assert {(r["row"], r["col"]): tuple(r["region"]) for r in R.labelled(df, block).collect()} == flood(cells)
    assert R.labelled(df.limit(0), block).count() == 0


@pytest.mark.parametrize("block", [6, 512])
def test_holes_equal_those_of_runs(spark, block):
    cells = picture(2, share=0.6)
    df = spark.createDataFrame([(r, c, 1.0) for r, c in cells] + [(100, 100, None)], "row int, col int, z double").repartition(3)
    lo_r, hi_r, lo_c, hi_c = (f(x[k] for x in cells) for k in (0, 1) for f in (min, max))
    free = {(r, c) for r in range(lo_r - 1, hi_r + 2) for c in range(lo_c - 1, hi_c + 2)} - cells
    outside = flood(free)[lo_r - 1, lo_c - 1]
    expected = {k for k, v in flood(free).items() if v != outside}
    assert {(r["row"], r["col"]) for r in R.enclosed_holes(df, block).collect()} == expected
    if block == 512:
        assert {(r["row"], r["col"]) for r in H.enclosed(df, R.cut).collect()} == expected
    assert R.enclosed_holes(df.limit(0), block).count() == 0


def test_outlines_close_and_have_the_cells_area(spark):
    cells = {("a", r, c) for r, c in picture(3, 12, 11)} | {("b", r, c) for r in range(10, 15) for c in range(5, 9)} - {("b", 12, 6)} | {("c", 0, 0), ("c", 1, 1)}
    df = spark.createDataFrame(list(cells), "mask string, row int, col int").repartition(3)
    rings = {}
    for r in R.outlines(df, ("mask",)).withColumn("area", R.signed_area(F.col("ring"))).collect():
        rings.setdefault(r["mask"], []).append((r["area"], [(p["x"], p["y"]) for p in r["ring"]]))
    for mask in "abc":
        assert sum(a for a, _ in rings[mask]) == sum(m == mask for m, *_ in cells)
        for _, ring in rings[mask]:
            assert all((x1 == x2) != (y1 == y2) for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True))
            assert len(ring) % 2 == 0
        own = {(r, c) for m, r, c in cells if m == mask}
        for r in range(-6, 15):  # crossings of a ray from each centre
            for c in range(-4, 14):
                crossed = sum((y1 > r + 0.5) != (y2 > r + 0.5) and x1 > c + 0.5 for _, ring in rings[mask] for (x1, y1), (_, y2) in zip(ring, ring[1:] + ring[:1], strict=True))
                assert crossed % 2 == ((r, c) in own)
    assert sorted(a for a, _ in rings["b"]) == [-1.0, 20.0]
    assert sorted(a for a, _ in rings["c"]) == [1.0, 1.0] or sorted(a for a, _ in rings["c"]) == [2.0]
    assert R.outlines(df.limit(0)).count() == 0


def test_wide_means_equal_scattered_ones(spark):
    draw = random.Random(4)
    cells = [(r, c, draw.uniform(-5, 5) if draw.random() < 0.4 else None) for r in range(-20, 30) for c in range(-15, 33)]
    df = spark.createDataFrame(cells, "row int, col int, z double").repartition(3)
    for half, block in ((1, 4), (9, 8), (60, 16)):
        got = {(r["row"], r["col"]): r["mean"] for r in G.box_mean_blocks(df, half, block).collect()}
        want = {}
        some = [(r, c, z) for r, c, z in cells if z is not None]
        for r, c, _ in cells:
            near = [z for i, j, z in some if abs(i - r) <= half and abs(j - c) <= half]
            if near:
                want[r, c] = sum(near) / len(near)
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want), half


def test_convergence_of_cone_and_plane(spark):
    cone = spark.createDataFrame([(r, c, math.hypot(r, c)) for r in range(-6, 7) for c in range(-6, 7)], "row int, col int, z double")
    at = {(r["row"], r["col"]): r["index"] for r in G.convergence_index(cone).collect()}
    assert at[0, 0] < -85  # all neighbours of the tip fall to it
    flipped = {(r["row"], r["col"]): r["index"] for r in G.convergence_index(cone.withColumn("z", -F.col("z"))).collect()}
    assert flipped[0, 0] > 85 and abs(flipped[3, 2] + at[3, 2]) < 1e-9
    plane = spark.createDataFrame([(r, c, 2.0 * r + c) for r in range(6) for c in range(6)], "row int, col int, z double")
    assert all(abs(r["index"]) < 1e-9 for r in G.convergence_index(plane).where("row between 1 and 4 and col between 1 and 4").collect())
    level = spark.createDataFrame([(r, c, 1.0) for r in range(3) for c in range(3)], "row int, col int, z double")
    assert G.convergence_index(level).count() == 0
