"""Readers of XML, CSV and statistics on hand-made files, and small text rules."""

from pyspark.sql import functions as F

from shoalspark.functions import texts as X
from shoalspark.sources import readers as R

XML = """<PAMDataset>
  <PAMRasterBand band="1"><Description>Depth</Description></PAMRasterBand>
  <PAMRasterBand band="3"><Description>Contributor</Description><GDALRasterAttributeTable>
    <FieldDefn index="1"><Name>survey</Name><Type>2</Type></FieldDefn><FieldDefn index="0"><Name>value</Name><Type>0</Type></FieldDefn>
    <Row index="0"><F>7</F><F>H100</F></Row><Row index="1"><F>9</F><F></F></Row>
  </GDALRasterAttributeTable></PAMRasterBand>
  <PAMRasterBand band="4"><GDALRasterAttributeTable><Row index="0"><F>1</F><F>other</F></Row></GDALRasterAttributeTable></PAMRasterBand>
</PAMDataset>"""


def test_attribute_tables_of_a_band(spark, tmp_path):
    path = tmp_path / "tile.aux.xml"
    path.write_text(XML)
    assert R.field_names(spark, str(path)) == ["value", "survey"]
    every = {tuple(r) for r in R.attribute_table(spark, str(path), ["value", "survey"]).collect()}
    assert {v for v, _ in every} == {"7", "9", "1"}
    rows = {r["value"]: r["survey"] for r in R.band_table(spark, str(path), 3, ["value", "survey"]).collect()}
    assert rows["7"] == "H100" and not rows["9"] and len(rows) == 2
    assert R.band_table(spark, str(path), 2, ["value"]).count() == 0


def test_sediment_rows_and_statistics(spark, tmp_path):
    (tmp_path / "sediment.csv").write_text("Latitude,Longitude,Gravel,Sand,Mud,Clay,Grainsze\n1,2,0,-99,0,-99,3\n1,3,0,50,0,50,-99\n1,4,10,-99,0,0,2.5\n")
    rows = R.sediment_csv(spark, str(tmp_path / "sediment.csv"))
    assert [r["Longitude"] for r in rows.collect()] == [4.0]
    R.write_statistics(spark.createDataFrame([(1, None), (2, "b")], "n int, v string").coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert sorted(part.read_text().split()) == ["1,NA", "2,b", "n,v"]


def test_small_text_rules(spark):
    df = spark.createDataFrame([(" ", "b", " A  Name "), ("a", "b", "x"), (None, None, None)], "a string, b string, c string")
    got = [tuple(r) for r in df.select(X.not_blank(F.col("a"), F.col("b")), X.fuzzy(F.col("c"))).collect()]
    assert got[0][0] == "b" and got[1] == ("a", "x") and got[2] == (None, None) and got[0][1].startswith("a")
