"""Classes of risk and lidar selection on hand-made rows."""

from pyspark.sql import functions as F

from shoalspark.operators import lidar as L
from shoalspark.operators import models as M
from shoalspark.operators import riskclasses as R


def test_circles_are_nested_and_even():
    sizes = {w: len(R.circle(w)) for w in R.CIRCLES}
    assert sizes == {w: sum(rows) for w, rows in R.CIRCLES.items()}
    for a, b in ((3, 5), (5, 9), (9, 17), (17, 31)):
        assert R.circle(a) < R.circle(b)
    assert all((-i, -j) in R.circle(w) for w in R.CIRCLES for i, j in R.circle(w))


def test_density_and_distance_of_one_place(spark):
    points = spark.createDataFrame([(10, 10), (10, 10), (None, 3)], "row int, col int").dropna()
    grid = spark.range(400).select(F.floor(F.col("id") / 20).cast("int").alias("row"), (F.col("id") % 20).cast("int").alias("col"))
    got = {(r["row"], r["col"]): r["class"] for r in R.groundings(grid, points).collect()}
    assert len(got) == 400
    # Two reports within a circle of 17 make class 4; next to them the distance makes 5; far away there is nothing.
    assert [got[10, 10], got[11, 10], got[11, 11], got[10, 18], got[10, 19], got[0, 0]] == [5, 5, 4, 4, 1, 1]
    none = R.groundings(grid, points.limit(0)).agg(F.max("class")).first()[0]
    assert none == 1


def test_classes_at_their_limits(spark):
    rows = spark.createDataFrame([(138900.0, -1, 0.1, 4.0, 2), (138901.0, -1, 0.0, 4.1, 4), (1111001.0, 5, 100.1, 20.0, 5), (0.0, None, -1.0, 101.0, 0), (None, 2, None, None, None)], "m double, l int, v double, d double, n int")
    got = rows.select(R.rescue_class(F.col("m"), F.col("l")), R.current_class(F.col("v")), R.depth_class(F.col("d")), R.density_class(F.col("n")), R.boaters_class(F.col("n") * 25), R.complexity(F.col("d"), 20.0, F.col("l"))).collect()
    assert [tuple(r) for r in got] == [(0, 1, 3, 4, 4, 1), (1, 1, 4, 4, 4, 1), (5, None, 4, 5, 5, 5), (0, None, 1, 1, 1, 100), (0, None, None, None, None, 2)]


def test_names_of_lidar_files(spark):
    names = ["FL_2015_USACE_ncmp_8888_resampled.tif", "GA_2010_Topo_77_RESAMPLED.TIF", "x_1999.tif", "plain", ""]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(*[c.alias(k) for k, c in L.name_parts(F.col("n")).items()]).collect()
    assert [tuple(r) for r in got] == [("2015", "8888", "USACE"), ("2010", "77", "Topo"), ("1999", None, "x.tif"), (None, None, "plain"), (None, None, "")]


def test_settings_decide_on_files(spark):
    files = spark.createDataFrame([("a_2001_1_resampled.tif",), ("b_2002_2_resampled.tif",), ("ncei_2003_3_resampled.tif",), ("c_2004_4.tif",), (None,)], "name string")
    mosaics = spark.createDataFrame([("a_2001_1.vrt",), ("ncei_2003_3.vrt",), ("c_2004_4.vrt",)], "name string")
    assert [r["used"] for r in L.chosen(files, mosaics, {"a_": {"use": 0}}).collect()] == [False]
    assert [(r["year"], r["used"], r["manual"]) for r in L.chosen(files, mosaics, {}).collect()] == [("2001", True, False)]


def test_time_frames_keep_to_their_own_description(spark):
    frame = lambda d: f"<time-frame>{d}<start-date-time>2001</start-date-time><end-date-time>2002</end-date-time></time-frame>"
    docs = [f"<a>{frame('<description>one &amp; more</description>')}<b>{frame('')}</b></a>", "<a/>", None]
    got = spark.createDataFrame([(d,) for d in docs], "x string").select(L.time_frames(F.col("x"), F.lit("folder")).alias("t")).collect()
    assert [[tuple(f) for f in r["t"]] if r["t"] is not None else None for r in got] == [[("one & more", "2001", "2002"), ("folder", "2001", "2002")], [], None]


def test_bins_are_closed_on_the_right(spark):
    rows = spark.createDataFrame([("p", float(v), 1.0) for v in range(11)] + [("q", 3.0, 2.0), ("p", None, 9.0)], "k string, v double, t double")
    got = {(r["k"], r["bin"]): r["mean"] for r in M.binned(rows, "k", "v", "t", 5).collect()}
    counts = {b: 0 for b in range(5)}
    assert set(got) == {("p", b) for b in counts} | {("q", 2)}
    assert M.binned(rows.withColumn("t", F.col("v")), "k", "v", "t", 5).where("k = 'p' and bin = 0").select("least", "largest").first() == (0.0, 2.0)
