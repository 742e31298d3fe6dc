"""Well-known binary and its files, inner points, summary grids with hazards, and samples."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoalspark.operators import samples as A
from shoalspark.operators import summarygrid as S
from shoalspark.operators.polygons import rectangle
from shoalspark.sources import features as W

SQUARE, HOLE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0)]


def test_binary_round_trip_in_both_orders():
    for kind, parts in (("point", [[(1.5, -2.0)]]), ("point", []), ("line", [[(0.0, 0.0), (1.0, 2.0), (3.0, 4.0)]]), ("polygon", [SQUARE, HOLE]), ("polygon", [])):
        data = W.encode(kind, [np.array(p) for p in parts])
        got = W.decode(data)
        assert got[0] == kind and [p.tolist() for p in got[1]] == [[list(x) for x in p] for p in parts]
    assert W.encode("point", [np.array([(1.0, 2.0)])]) == struct.pack("<BIdd", 1, 1, 1.0, 2.0)
    assert W.decode(struct.pack(">BIIdddd", 0, 2, 2, 1.0, 2.0, 3.0, 4.0))[1][0].tolist() == [[1.0, 2.0], [3.0, 4.0]]


def test_files_out_of_the_box_are_left_out(spark, tmp_path):
    draw = random.Random(9)
    rows = []
    for i in range(400):
        x, y = draw.uniform(-180, 180), draw.uniform(-90, 90)
        rows.append((i, "polygon", [[{"x": x + a, "y": y + b} for a, b in SQUARE]]))
    rows += [(900, "point", []), (901, "point", [[{"x": 0.5, "y": 0.5}]])]
    df = spark.createDataFrame(rows, f"id long, kind string, parts {W.PARTS}")
    W.write_features(df, f"{tmp_path}/f", 16)
    every = {r["id"]: (r["kind"], [[(p["x"], p["y"]) for p in part] for part in r["parts"]]) for r in W.read_features(spark, f"{tmp_path}/f").collect()}
    assert every == {i: (k, [[(p["x"], p["y"]) for p in part] for part in parts]) for i, k, parts in rows}
    box = (-20.0, -20.0, 20.0, 20.0)
    expected = {i for i, _, parts in rows if parts and min(p["x"] for p in parts[0]) <= 20 and max(p["x"] for p in parts[0]) >= -20 and min(p["y"] for p in parts[0]) <= 20 and max(p["y"] for p in parts[0]) >= -20}
    assert {r["id"] for r in W.read_features(spark, f"{tmp_path}/f", box).collect()} == expected
    assert 0 < len(W.files_within(spark, f"{tmp_path}/f", box)) <= 10 < len(W.files_within(spark, f"{tmp_path}/f"))
    assert W.read_features(spark, f"{tmp_path}/f", (500.0, 0.0, 501.0, 1.0)).count() == 0


def test_inner_points_are_inside(spark):
    crescent = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 9), (9, 9), (9, 1), (0, 1)]
    comb = [(0, 0), (9, 0), (9, 8), (8, 8), (8, 1), (5, 1), (5, 8), (4, 8), (4, 1), (1, 1), (1, 8), (0, 8)]
    shapes = [[crescent], [comb], [SQUARE, HOLE], [[(0, 0), (5, 1), (1, 5)]], [[(0, 0), (4, 0), (2, 0)]]]
    df = spark.createDataFrame([(i, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in s]) for i, s in enumerate(shapes)], f"id int, parts {W.PARTS}")
    got = {r["id"]: r["p"] for r in df.select("id", W.inner_point(F.col("parts")).alias("p")).collect()}
    assert got[4] is None
    for i, shape in enumerate(shapes[:4]):
        x, y = got[i]["x"], got[i]["y"]
        crossed = sum((y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1) for ring in shape for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True))
        assert crossed % 2 == 1, i


@pytest.mark.parametrize("merged", [False, True])
def test_grid_of_a_mask_and_its_hazards(spark, merged):
    mask = spark.createDataFrame([(0, 0, 1), (0, 4, 1), (0, 7, 1), (6, 1, 1), (11, 11, 1), (3, 3, 0), (3, 4, None), (-1, 0, 1)], "row int, col int, z int")
    grid = {(r["row"], r["col"]): r["grid_id"] for r in S.summary_grid(mask, 100.0, 500.0, "ER_3", merged).collect()}
    assert set(grid) == {(-1, 0), (0, 0), (0, 1), (1, 0), (2, 2)}
    assert len(set(grid.values())) == (2 if merged else 5) and grid[-1, 0] == "ER_3_grid_1"
    shapes = [(1, S.point(F.lit(10.0), F.lit(10.0))), (2, S.point(F.lit(500.0), F.lit(20.0))), (3, rectangle(F.lit(-50.0), F.lit(480.0), F.lit(1200.0), F.lit(520.0))), (4, S.point(F.lit(5000.0), F.lit(0.0))), (5, S.point(F.lit(1000.0), F.lit(1000.0)))]
    hazards = None
    for i, ring in shapes:
        one = spark.range(1).select(F.lit(i).alias("hazard_id"), ring.alias("ring"), F.lit("WRECKS").alias("object_group"), F.lit("01_known_hazard").alias("methodology_group"), F.lit(float(i)).alias("hazard_score"), F.lit(1.0).alias("known_score"), F.lit(0.0).alias("reported_score"))
        hazards = one if hazards is None else hazards.unionByName(one)
    got = {r["grid_id"]: (r["total_hazard_count"], r["wreck_count"], r["hazard_score"]) for r in S.hazards_of_mask(mask, 100.0, hazards, 500.0, "ER_3", merged).collect()}
    if merged:
        assert got == {grid[0, 0]: (3, 3, 3.0), grid[2, 2]: (1, 1, 5.0)}
    else:
        assert got == {grid[-1, 0]: (0, 0, 0.0), grid[0, 0]: (3, 3, 3.0), grid[0, 1]: (2, 2, 3.0), grid[1, 0]: (1, 1, 3.0), grid[2, 2]: (1, 1, 5.0)}
    area = S.summary_grid(mask, 100.0)
    assert sorted(r["hazard_id"] for r in S.within_area(hazards, area, 500.0).collect()) == [1, 2, 3, 5]


def test_samples_repeat_and_every_tenth_row(spark):
    df = spark.range(5000).withColumn("k", F.col("id") % 50)
    one = {r["id"] for r in A.seeded_sample(df, ["id"], 0.2).collect()}
    assert one == {r["id"] for r in A.seeded_sample(df.repartition(7), ["id"], 0.2).collect()} and 900 < len(one) < 1100
    assert one != {r["id"] for r in A.seeded_sample(df, ["id"], 0.2, seed=1).collect()}
    assert A.seeded_sample(df, ["k"], 0.5).count() % 100 == 0
    assert sorted(r["id"] for r in A.every_nth(df.repartition(6).orderBy("k"), ["id"], 10).collect()) == list(range(0, 5000, 10))
    assert A.every_nth(df.limit(0), ["id"], 10).count() == 0
