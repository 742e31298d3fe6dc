"""Edges of bins and scores, and operators that SQL does not reach."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoalspark.functions import scores as S
from shoalspark.functions import texts as X
from shoalspark.operators import grid as G
from shoalspark.operators import holes as H
from shoalspark.operators import models as M
from shoalspark.operators import spatial as P
from shoalspark.operators import tabular as T
from shoalspark.operators import terrain as R
from shoalspark.operators.lineage import cut
from shoalspark.sources import readers
from shoalspark.streaming import increments


def values(spark, expr, rows, kind="double"):
    return [r[0] for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}").orderBy("i").select(expr(F.col("x"))).collect()]


@pytest.mark.parametrize(
    ("rule", "given", "expected"),
    [
        (S.bin_storms, [0, 0.1, 4, 10, 10.5, 20, 21, None], [1, 2, 2, 3, 4, 4, 5, None]),
        (S.bin_tide, [0.09, 0.1, 0.2, 0.5, 1.0, None], [1, 2, 3, 4, 5, None]),
        (S.bin_debris, [0, 1, 5, 10, 11], [1, 2, 3, 4, 5]),
        (S.clean_year, [1.0, 1995.0, 199507.0, 19950731.0, 1700.0, 2999.0, None], [None, 1995, 1995, 1995, None, None, None]),
        (S.catzoc, [81, 80, 60, 40, 20, None], [1, 2, 3, 4, 5, None]),
        (lambda x: S.bin_depth(x, 20, 50), [1.9, 2, 20, 21, 50, 51], [100, 80, 80, 30, 30, 10]),
    ],
)
def test_bins(spark, rule, given, expected):
    assert values(spark, rule, [None if g is None else float(g) for g in given]) == expected


def test_missing_values_and_decay(spark):
    assert values(spark, S.clean, [float("nan"), -9999.0, 3.0]) == [None, None, 3.0]
    assert values(spark, lambda x: S.decay(x, F.lit(365)), [1.0, 100.0]) == [None, pytest.approx(100 * np.exp(-0.022))]


def test_dates_and_texts(spark):
    d = datetime.date
    got = values(spark, X.any_date, ["2001-02-03", "2001/02/03", "2001-02", "20010203", "2001", "about 1987", "none", None], "string")
    assert got == [d(2001, 2, 3), d(2001, 2, 3), d(2001, 2, 1), d(2001, 2, 3), d(2001, 1, 1), d(1987, 1, 1), None, None]
    assert values(spark, X.coordinate, ["28.0N", "94.8W", "x"], "string") == [28.0, -94.8, None]
    assert values(spark, X.garbage, ["abc", "a#$%", "", None], "string") == [False, True, False, False]


def test_wide_position_index_equals_scatter(spark):
    rng = np.random.default_rng(1)
    cells = spark.createDataFrame([(i, j, float(rng.random())) for i in range(20) for j in range(25) if rng.random() < 0.9], "row int, col int, z double")
    a = {(r.row, r.col): r.bpi for r in G.position_index(cells, 2, 5).collect()}
    b = {(r.row, r.col): r.bpi for r in G.position_index_blocks(cells, 2, 5, block=8).collect()}
    assert a.keys() == b.keys() and all(b[k] == pytest.approx(v, abs=1e-9) for k, v in a.items())


def test_pit_in_constant_plane(spark):
    cells = spark.createDataFrame([(i, j, 5.0) for i in range(5) for j in range(5) if (i, j) != (2, 2)] + [(2, 2, None)], "row int, col int, z double")
    assert {r.z for r in G.focal_fill(cells, 1, 1).collect()} == {5.0}
    assert {r.slope for r in G.slope(cells, 1.0).collect()} == {0.0}


def test_median_repair_of_nulls(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None)], "g string, w double")
    assert sorted((r.g, r.w or 0, r.corrected) for r in T.repaired_by_median(rows, "g", "w", ~X.out_of_range(F.col("w"), 10)).collect()) == [("a", 1.0, False), ("a", 2.0, True), ("a", 3.0, False), ("b", 0, False)]


def test_storm_log(spark):
    lines = ["AL011851, UNNAMED, 2,", "18510625, 0000, , HU, 28.0N, 94.8W, 80", "18510625, 0600, , HU, 28.0N, 95.4W, 80", "AL021851, TWO, 1,", "18510705, 1200, , HU, 22.2N, 97.6W, 80"]
    rows = readers.storm_log(spark.createDataFrame([("f", i, s) for i, s in enumerate(lines)], "file string, line int, value string")).orderBy("line").collect()
    assert [r.fields[:4] for r in rows] == [["AL011851", "UNNAMED", "2", "18510625"]] * 2 + [["AL021851", "TWO", "1", "18510705"]]


def test_feature_links(spark):
    rows = spark.createDataFrame([('{"id":"a","ExternalProviderLink":[{"label":"Other","link":"x"},{"label":"Metadata","link":"y"},{"label":"ISO metadata","link":"z"}]}',), ('{"id":"b"}',)], "value string")
    assert {r.id: r.link for r in readers.feature_links(rows).collect()} == {"a": "y", "b": None}


def test_trees_beat_the_mean_and_features_are_chosen(spark):
    rng = np.random.default_rng(0)
    rows = spark.createDataFrame([(float(a), float(b), float(3 * a + 0.1 * rng.random())) for a, b in rng.random((300, 2))], "a double, b double, y double")
    model = M.boosted(rows, ["a", "b"], "y", rounds=5)
    r2 = M.metrics(model.transform(rows).withColumn("g", F.lit(1)), "g", "y", "prediction").first().r2
    assert r2 > 0.7
    assert M.selected_features(rows, ["a", "b"], "y", rounds=2)["a"] == "Confirmed"


def test_rows_of_a_fit_are_dealt_to_more_tasks_as_they_grow(spark):
    rows = spark.range(0, 1000, 1, 2)
    parts = M.dealt(rows, 100).rdd.glom().map(len).collect()
    assert len(parts) == 10 and sum(parts) == 1000 and max(parts) <= 150
    assert M.dealt(rows, 500).rdd.getNumPartitions() == 2 and M.dealt(rows.limit(0)).count() == 0


def test_stream_of_new_cells(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in (1, 2):
        spark.createDataFrame([(k, 1.0)], "row int, z double").write.mode("append").parquet(source)
        increments.process_new(increments.new_cells(spark, source, "row int, z double"), lambda b: b.withColumn("z", F.col("z") * 2), out, str(tmp_path / "check"))
    assert sorted((r.row, r.z) for r in spark.read.parquet(out).collect()) == [(1, 2.0), (2, 2.0)]


def test_flow_gathers_in_pits(spark):
    cells = spark.createDataFrame([(0, j, float(abs(j - 37))) for j in range(60)] + [(5, 5, None), (9, 9, 1.0)], "row int, col int, z double")
    found = {(r.row, r.col): r.cells for r in R.flow_accumulation(R.flow_direction(cells), cut).collect()}
    assert found[0, 37] == 60 and found[0, 36] == 37 and found[0, 59] == 1 and found[9, 9] == 1 and (5, 5) not in found
    assert R.flow_accumulation(R.flow_direction(cells.limit(0)), cut).count() == 0


def test_curvature_of_a_bowl(spark):
    cells = spark.createDataFrame([(i, j, float((i - 3) ** 2 + (j - 3) ** 2)) for i in range(7) for j in range(7)], "row int, col int, z double")
    rows = R.curvature(cells, 1.0).collect()
    assert len(rows) == 25 and {round(r.total, 9) for r in rows} == {-4.0}
    assert {(r.row, r.col): r.profile for r in rows}[3, 3] == 0.0


def test_aspect_of_planes(spark):
    plane = lambda f: spark.createDataFrame([(i, j, float(f(i, j))) for i in range(3) for j in range(3)], "row int, col int, z double")
    faces = [R.aspect(plane(f), 2.0).first().aspect for f in (lambda i, j: i, lambda i, j: -j, lambda i, j: -i, lambda i, j: j, lambda i, j: 4)]
    assert faces == [pytest.approx(0), pytest.approx(90), pytest.approx(180), pytest.approx(270), -1.0]


def test_bilinear_keeps_a_plane(spark):
    coarse = spark.createDataFrame([(i, j, float(3 * i + j)) for i in range(4) for j in range(4)], "row int, col int, z double")
    targets = spark.createDataFrame([(i, j) for i in range(16) for j in range(16)], "row int, col int")
    got = {(r.row, r.col): r.z for r in R.bilinear(coarse, targets, 4).collect()}
    assert len(got) == 256 and got[5, 6] == pytest.approx(3 * (5.5 / 4 - 0.5) + 6.5 / 4 - 0.5)


def test_boxes_meet_once(spark):
    schema = "id int, x0 double, y0 double, x1 double, y1 double"
    a = spark.createDataFrame([(1, 0.0, 0.0, 100.0, 100.0), (2, -7.0, -7.0, -5.0, -5.0), (3, 10.0, 10.0, 10.0, 10.0)], schema).withColumnRenamed("id", "a_id")
    b = spark.createDataFrame([(8, 10.0, 10.0, 55.0, 55.0), (9, -5.0, -5.0, -1.0, -1.0), (7, 500.0, 0.0, 600.0, 1.0)], schema).withColumnRenamed("id", "b_id")
    assert sorted(map(tuple, P.box_pairs(a, b, 10.0).collect())) == [(1, 8), (2, 9), (3, 8)]


def test_numbers_in_a_base_and_dates_of_a_text(spark):
    assert values(spark, lambda x: X.in_base(x, "0123456789", 3), [0, 7, 1234567890123, 2**63 - 1], "long") == ["000", "007", "1234567890123", str(2**63 - 1)]
    assert values(spark, X.dates_in, ["2001-05, 1999-12 and 2001-05", "1999 or 1850", "none", None], "string") == [["1999-12", "2001-05"], ["1850", "1999"], [], None]


def test_holes_that_wind_and_leak(spark):
    picture = ["#########", "#..#....#", "#.##.##.#", "#.....#.#", "####.##.#", "...#.#..#", "##.###.##", "#..#.#..#", "####.####"]
    closed = {(i, j) for i, line in enumerate(picture) for j, c in enumerate(line) if c == "." and (i, j) not in {(5, 0), (5, 1), (5, 2), (6, 2), (7, 1), (7, 2), (7, 4), (8, 4)}}
    cells = spark.createDataFrame([(i, j, 1.0 if c == "#" else None) for i, line in enumerate(picture) for j, c in enumerate(line)], "row int, col int, z double")
    assert {(r.row, r.col) for r in H.enclosed(cells, cut).collect()} == closed
    assert H.enclosed(cells.limit(0), cut).count() == 0
