"""Rules of scores and names with values of the reference, and polygons against brute force."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoalspark.functions import scores as S
from shoalspark.functions import texts as X
from shoalspark.operators import files as L
from shoalspark.operators import grid as G
from shoalspark.operators import hazards as H
from shoalspark.operators import modeltable as M
from shoalspark.operators import polygons as Y
from shoalspark.sources import readers


def one(spark, *columns):
    return list(spark.range(1).select(*columns).first())


def test_missing_parts_of_scores(spark):
    null, v = F.lit(None).cast("double"), lambda x: F.lit(x)
    got = one(spark, S.present(v(100.0), v(0.1), null), S.present(v(100.0), v(0.1), v(-5)), S.present(v(100.0), v(0.01), v(500)), S.present(v(500.0), v(0.0), v(1)))
    assert got == [None, None, pytest.approx(100 * math.exp(-2)), 110]
    got = one(spark, S.desired(v(-1.0), v(1.0), v(0.1)), S.desired(null, v(25.0), v(0.1)), S.desired(v(0.5), v(99.0), v(2.0)), S.desired(v(-1.0), null, v(0.1)), S.desired(v(5.0), v(5.0), null))
    assert got == [100, 30, 100, None, None]
    no = F.lit(False)
    assert one(spark, S.supersession(v(80.0), null, interpolated=no), S.supersession(v(80.0), v(60.0), interpolated=F.lit(True))) == [None, 59.99]
    assert one(spark, S.feature(F.lit(True), F.lit(True), no), S.feature(F.lit(True), F.lit(True), F.lit(True)), S.feature(F.lit(True), no, no), S.coverage(F.lit(True), F.lit(True)), S.coverage(no, no)) == [100, 110, 60, 110, 60]
    zeros = S.radii(F.lit(40), [F.lit(0)] * 4, 34, 100)
    some = S.radii(F.lit(40), [F.lit(0), F.lit(5), F.lit(-999), null], 34, 100)
    assert one(spark, *zeros, *some, S.outer_radius(v(100.0)), S.outer_radius(null)) == [100, 100, 100, 100, 0, 5, None, None, 150, 0]


def test_bins_that_do_not_apply_leave_the_sum(spark):
    made = lambda *a: one(spark, *S.change_bins(*[F.lit(x).cast("double") for x in a]).values())
    assert made(-10, 2014, 1, 0.05, 25, 3) == [pytest.approx((4 + 3 + 2) * 0.022 / 3), 5, 4, 3, pytest.approx(0.5)]
    assert made(-30, 2014, 1, 0.05, 25, None) == [pytest.approx(4 * 0.022 / 3), 5, None, 1, None]
    assert made(-50, 2014, 1, 0.05, 25, None)[0] == 0 and made(-10, 2014, 0, 1, 25, 3)[1:3] == [None, None]
    assert made(None, 2014, 1, 1, 1, 1) == [None] * 5 == made(-10, None, 1, 1, 1, 1)


@pytest.mark.parametrize(
    ("text", "year"), [("H1203419 chart", None), ("survey of 1745", 1745), ("about 1987.8", 1988), ("1986.5", 1986), ("n/a", None), ("Unknown", None), ("", None), (None, None), ("x1999", None), ("(2001) and 1990", 2001)]
)
def test_years_stand_alone(spark, text, year):
    (got,) = one(spark, X.any_date(F.lit(text).cast("string")))
    assert got == (year and datetime.date(year, 1, 1))


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("bluetopo_bathy_20220101", "bt.bathy_2022_filled"), ("BlueTopo_bathy_2022", "bt.bathy_2022_filled"), ("bathy_2004", "bathy_2004_filled"), ("bathy_2004_filled", "bathy_2004_filled"), ("bathy_slope_2010", "slope_2010"),
        ("1998_2004_tsm_mean", "tsm_mean_1998_2004"), ("combined12_flowdir_2015", "flowdir_2015"), ("any_Survey_End_Date_x", "survey_end_date"), ("grain_size_layer", "grain_size_layer"), ("BH4_2010_T1", "BH4_2010"), ("bt.bpi_2010", "bt.bpi_2010"), ("2012", "2012"),
    ],
)
def test_column_names(spark, name, expected):
    assert one(spark, X.standard_name(F.lit(name), "T1")) == [expected]


def test_long_pairs(spark):
    wide = spark.createDataFrame([(1.0, 2.0, 7, 5.0, 6.0, 90.0, 0.5, 3, 9.0)] * 2, "X double, Y double, FID int, bathy_2004 double, bathy_2006 double, flowdir_2006 double, `2004_2006_tsm_mean` double, grain_size int, `1998_2004_hurr_strength_mean` double")
    made = M.long_pairs(M.standardised(wide), [(1998, 2001), (2004, 2006)])
    assert list(made) == [(2004, 2006)]
    (rows,) = made.values()
    assert rows.columns == ["X", "Y", "FID", "year_ti", "year_t", "bathy_ti", "bathy_t", "flowdir_cos_t", "flowdir_sin_t", "delta_bathy", "tsm_mean_2004_2006", "grain_size_layer"]
    assert list(rows.collect()[0])[:7] == [1.0, 2.0, 7, 2004, 2006, 5.0, 6.0] and rows.count() == 1 and rows.first().delta_bathy == 1.0
    assert M.column_years(["bathy_2004_filled", "slope_2006", "x", "tsm_1998_2004"]) == [("bathy_2004_filled", 2004, "bathy"), ("slope_2006", 2006, "slope")]
    assert M.known_columns(wide, ["Y", "no", "X"]).columns == ["Y", "X"]


def test_hazards_without_columns_and_cells_without_hazards(spark):
    rows = H.classified(spark.createDataFrame([("WRECKS", None), ("WRECKS", "12"), ("WRECKS", "4"), ("LIGHTS", "4")], "object_group string, QUAPOS string")).collect()
    assert [(r.methodology_group, r.hazard_weight, r.quapos_label) for r in rows] == [("01_known_hazard", 1, None), ("other", 0, None), ("02_unverified_reported_error", 3, "approximate"), ("other", 0, "approximate")]
    grid = spark.createDataFrame([(1,), (2,)], "grid_id long")
    empty = spark.createDataFrame([], "grid_id long, hazard_id long, object_group string, methodology_group string, hazard_score double, known_score double, reported_score double")
    assert sorted(map(tuple, H.grid_summary(grid, empty).collect())) == [(i, *[0] * 10) for i in (1, 2)]
    summary = spark.createDataFrame([(1, 3.0), (2, 0.0)], "grid_id long, score double")
    cells = spark.createDataFrame([(0, 0, 1, 1), (0, 1, 1, 0), (0, 2, 2, 1)], "row int, col int, grid_id long, mask int")
    assert [tuple(r) for r in H.burned(summary, cells, "score").collect()] == [(0, 0, 3.0)]


def test_sediment_rows(spark, tmp_path):
    lines = ["Latitude,Longitude,Gravel,Sand,Mud,Clay,Grainsze", "1,1,-99,0,-99,0,1", "2,2,-99,5,-99,0,1", "3,3,1,1,1,1,-99", "4,4,,0,0,0,", "5,5,0,0,0,0,2"]
    (tmp_path / "s.csv").write_text("\n".join(lines))
    assert sorted(r.Latitude for r in readers.sediment_csv(spark, str(tmp_path / "s.csv")).collect()) == [2, 4]


def _inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        odd ^= (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return odd


def _apart(p, q):
    """Whether a side of either of two convex polygons parts them."""
    for ring in (p, q):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            nx, ny = y2 - y1, x1 - x2
            a, b = ([x * nx + y * ny for x, y in r] for r in (p, q))
            if max(a) < min(b) or max(b) < min(a):
                return True
    return False


def _triangles(seed, n, reach):
    rng = np.random.default_rng(seed)
    return [[(float(x + a), float(y + b)) for a, b in rng.uniform(0, reach, (3, 2))] for x, y in rng.uniform(0, 100, (n, 2))]


def test_polygons_against_brute_force(spark):
    a, b = _triangles(1, 80, 30), _triangles(2, 60, 12)
    table = lambda rings, ident: spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in r]) for i, r in enumerate(rings)], f"{ident} int, ring array<struct<x:double,y:double>>")
    meet = {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if not _apart(p, q)}
    got = [tuple(r) for r in Y.intersecting(table(a, "a_id"), table(b, "b_id"), 9.0).collect()]
    assert len(got) == len(set(got)) and set(got) == meet and 50 < len(meet) < len(a) * len(b)
    assert {r.a_id for r in Y.intersect_join(table(a, "a_id"), table(b, "b_id"), 9.0, "left_semi").collect()} == {i for i, _ in meet}
    rng = np.random.default_rng(3)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 130, (300, 2)))]
    p = spark.createDataFrame([*points, (999, None, 1.0)], "id int, x double, y double")
    held = {(i, k) for i, x, y in points for k, r in enumerate(a) if _inside(r, x, y)}
    assert {(r.id, r.poly_id) for r in Y.within(p, table(a, "poly_id"), 9.0).collect()} == held
    assert sorted(r.id for r in Y.clip(p, table(a, "poly_id"), 9.0).collect()) == sorted({i for i, _ in held})
    assert Y.within(p.limit(0), table(a, "poly_id"), 9.0).count() == 0 == Y.intersecting(table(a, "a_id").limit(0), table(b, "b_id"), 9.0).count()


def test_one_polygon_within_another_touches_it(spark):
    box = lambda i, lo, hi: (i, [{"x": x, "y": y} for x, y in ((lo, lo), (hi, lo), (hi, hi), (lo, hi))])
    outer = spark.createDataFrame([box(1, 0.0, 100.0)], "a_id int, ring array<struct<x:double,y:double>>")
    inner = spark.createDataFrame([box(1, 40.0, 41.0), box(2, 100.0, 120.0), box(3, 101.0, 102.0)], "b_id int, ring array<struct<x:double,y:double>>")
    assert sorted(r.b_id for r in Y.intersecting(outer, inner, 10.0).collect()) == [1, 2]
    burnt = Y.burn(outer.selectExpr("a_id poly_id", "ring", "5 value"), 10.0).collect()
    assert len(burnt) == 100 and {r.z for r in burnt} == {5}


def test_swaths_are_hulls_only_of_quarters_that_lie_apart(spark):
    rows = [("a", "ne", 34, 1, 0.0, 0.0, 10.0), ("a", "ne", 34, 2, 50.0, 0.0, 10.0), ("b", "sw", 34, 1, 0.0, 0.0, 10.0), ("b", "sw", 50, 1, 0.0, 0.0, 0.0), ("c", "ne", 34, 1, 0.0, 0.0, 10.0), ("c", "ne", 34, 2, 3.0, 2.0, 10.0), ("d", "nw", 34, 1, 0.0, 0.0, 10.0), ("d", "nw", 34, 2, 10.0, 0.0, 10.0)]
    fixes = spark.createDataFrame(rows, "storm string, quadrant string, wind int, order int, x double, y double, radius double")
    made = {}
    for r in Y.swaths(fixes).withColumn("area", Y.area(F.col("ring"))).collect():
        made.setdefault(r.storm, []).append(r)
    quarter = 4.5 * 100 * math.sin(math.pi / 18)
    areas = {s: sorted(r.area for r in own) for s, own in made.items()}
    assert areas["a"] == pytest.approx([quarter, quarter, 50 * 10 + quarter])
    assert areas["b"] == pytest.approx([quarter]) and areas["c"] == pytest.approx([quarter, quarter])  # c's overlap: their union is no hull
    assert areas["d"] == pytest.approx([quarter, quarter, 10 * 10 + quarter])  # d's touch at a point
    assert {(round(p.x), round(p.y)) for p in made["b"][0].ring} >= {(0, 0), (-10, 0), (0, -10)}


def test_one_file_and_its_rules(spark):
    files = spark.createDataFrame([("/a/Bathy_mosaic.tif",), ("/a/slope.tif",), ("/a/slope2.tif",)], "path string")
    assert L.only_one(files, "bathy.*mosaic") == "/a/Bathy_mosaic.tif"
    for bad in ("slope", "tide"):
        with pytest.raises(ValueError, match="one file"):
            L.only_one(files, bad)


def test_smoothing_reaches_out(spark):
    cells = spark.createDataFrame([(5, 5, 3.0), (5, 6, 5.0), (0, 0, None), (8, 8, None)], "row int, col int, z double")
    got = {(r.row, r.col): r.z for r in G.smoothed(cells, 1000.0, 500.0).collect()}
    assert got[5, 5] == 4.0 and got[3, 3] == 3.0 and (0, 0) not in got and got[7, 8] == 5.0 and max(got) == (7, 8)
