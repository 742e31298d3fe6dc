"""Readers of the formats that surveys arrive in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tabular import headers_down


def attribute_table(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Rows of an XML attribute table (elements Row with fields F) as text columns with the names given."""
    rows = spark.read.format("xml").option("rowTag", "Row").load(path)
    return rows.select(*[F.get("F", F.lit(i)).cast("string").alias(n) for i, n in enumerate(names)])


def band_table(spark: SparkSession, path: str, band: int, names: list[str]) -> DataFrame:
    """attribute_table() of one band of a raster's auxiliary XML (elements PAMRasterBand with an attribute band)."""
    cell = "struct<F:array<string>>"
    schema = f"_band int, GDALRasterAttributeTable struct<Row:array<{cell}>>"
    bands = spark.read.format("xml").option("rowTag", "PAMRasterBand").schema(schema).load(path).where(F.col("_band") == band)
    rows = bands.select(F.explode("GDALRasterAttributeTable.Row").alias("r"))
    return rows.select(*[F.get("r.F", F.lit(i)).alias(n) for i, n in enumerate(names)])


def field_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the FieldDefn elements, in order of their index."""
    found = spark.read.format("xml").option("rowTag", "FieldDefn").load(path).orderBy("_index")
    return [r["Name"] for r in found.select("Name").collect()]


def storm_log(lines: DataFrame, prefix: str = "AL") -> DataFrame:
    """file, line, value -> detail lines split by comma, after the fields of the header line before them."""
    is_head = F.col("value").startswith(prefix)
    down = headers_down(lines, "file", "line", F.when(is_head, F.col("value"))).where(~is_head & F.col("head").isNotNull())
    parts = lambda c: F.transform(F.split(F.regexp_replace(c, r",\s*$", ""), ","), lambda x: F.trim(x))
    return down.select("file", "line", F.concat(parts("head"), parts("value")).alias("fields"))


def feature_links(json_rows: DataFrame, labels: tuple[str, ...] = ("Metadata", "ISO metadata")) -> DataFrame:
    """id and the first link with one of the labels from JSON texts with ExternalProviderLink lists."""
    schema = "id string, ExternalProviderLink array<struct<label:string,altlabel:string,link:string>>"
    j = F.from_json("value", schema)
    hit = F.filter(j["ExternalProviderLink"], lambda x: x["label"].isin(*labels))
    return json_rows.select(j["id"].alias("id"), F.get(hit, F.lit(0))["link"].alias("link"))


def sediment_csv(spark: SparkSession, path: str) -> DataFrame:
    """Sediment samples without those whose shares are all -99 or 0, and without those whose grain size is -99."""
    schema = "Latitude double, Longitude double, Gravel double, Sand double, Mud double, Clay double, Grainsze double"
    rows = spark.read.csv(path, header=True, schema=schema)
    some = [~F.coalesce(F.col(c).isin(-99.0, 0.0), F.lit(False)) for c in ("Gravel", "Sand", "Mud", "Clay")]
    return rows.where(reduce(lambda a, b: a | b, some) & F.coalesce(F.col("Grainsze") != -99, F.lit(True)))


def write_statistics(rows: DataFrame, path: str) -> None:
    """CSV with NA for nulls."""
    rows.write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(path)
