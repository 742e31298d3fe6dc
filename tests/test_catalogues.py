"""Rules of files and grids that snap."""

from pyspark.sql import functions as F

from shoalspark.operators import catalogues as C


def test_keys_of_layer_names(spark):
    names = {"slope_2004_2006_BH4S.tif": ("BH4S", "slope", "2004_2006"), "hurr_count_2010_T1.tif": ("T1", "hurr_count", "2010"), "grain_size_T2.tif": ("T2", "grain_size", None), "depth.tif": (None, "depth", None)}
    df = spark.createDataFrame([(n,) for n in names], "name string").select("name", C.layer_key(F.col("name")).alias("k"))
    assert {r["name"]: tuple(r["k"]) for r in df.collect()} == names


def test_masks_of_regions(spark):
    df = spark.createDataFrame([("a/mask_ER_3_100m.tif",), ("b/ER_11.TIFF",), ("ER_5/mask.tif",), ("a/ER_7.xml",)], "path string")
    assert {(r["region"], r["path"]) for r in C.mask_catalogue(df).collect()} == {("ER_3", "a/mask_ER_3_100m.tif"), ("ER_11", "b/ER_11.TIFF")}
    assert [r["region"] for r in C.mask_catalogue(df, regions=["ER_11"]).collect()] == ["ER_11"]


def test_bounds_and_cells_snap_to_whole_widths(spark):
    grids = spark.createDataFrame([("a", -130.0, 0.0, 20.0, 270.0, 150.0), ("b", 40.0, 10.0, 95.0, 90.0, 20.0)], "layer string, x0 double, y0 double, x1 double, y1 double, size double")
    assert tuple(C.snapped_bounds(grids, 100.0).first()) == (-200.0, 0.0, 100.0, 300.0)
    cells = spark.createDataFrame([("a", 0, 0, 5.0), ("a", 1, 0, None), ("b", 1, 0, 9.0), ("b", 0, 0, 7.0)], "layer string, row int, col int, z double")
    got = {(r["layer"], r["row"], r["col"]): r["z"] for r in C.onto_grid(cells, grids, 100.0).collect()}
    # a's first cell lies from -130 to 20 and from 120 to 270: centres at -50 and at 150 and 250.
    assert got == {("a", 1, -1): 5.0, ("a", 2, -1): 5.0, ("b", 0, 0): 9.0}
    assert {(r["row"], r["col"]): r["z"] for r in C.national_mosaic(cells, grids, 100.0, "first").collect()} == {(1, -1): 5.0, (2, -1): 5.0, (0, 0): 9.0}
