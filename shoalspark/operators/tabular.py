"""Relational operators of the survey workflow: lookups, picks, pairs of years, repairs, null statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .selection import group_medians


def lookup(cells: DataFrame, codes: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """cells with value of their code; of repeated codes the last by order wins, negative and unknown codes give null."""
    last = codes.groupBy(key).agg(F.max_by(value, order).alias(value))
    return cells.join(last, key, "left").withColumn(value, F.when(F.col(key) >= 0, F.col(value)))


def pick_latest(rows: DataFrame, group: str, measured: Column, date: Column, ident: str) -> DataFrame:
    """One row's ident a group: measured before not measured, then the latest date, then the smallest ident."""
    return rows.groupBy(group).agg(F.max_by(ident, F.struct(measured, date, -F.col(ident))).alias(ident))


def null_percent(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.agg(*[F.round(100 * F.avg(F.col(c).isNull().cast("int")), 2).alias(c) for c in columns])


def null_overlap(rows: DataFrame, a: str, b: str) -> DataFrame:
    x, y = F.col(a).isNull(), F.col(b).isNull()
    return rows.agg(F.count_if(x & y).alias("both_null"), F.count_if(x & ~y).alias("only_first"), F.count_if(~x & y).alias("only_second"), F.count_if(x != y).alias("mismatch"))


def year_pairs(years: DataFrame, consecutive: bool = True) -> DataFrame:
    """y0, y1 of a one-column table of years: neighbours in order, or all ordered pairs."""
    ys = years.select("year").distinct()
    if consecutive:
        return ys.select(F.col("year").alias("y0"), F.lead("year").over(Window.orderBy("year")).alias("y1")).where("y1 is not null")
    return ys.select(F.col("year").alias("y0")).join(ys.select(F.col("year").alias("y1")), F.col("y0") < F.col("y1"))


def deltas(tall: DataFrame, pairs: DataFrame) -> DataFrame:
    """cell, y0, y1, delta: change of each cell between the years of each pair, where both have a value."""
    a, b = (tall.select("cell", F.col("year").alias(y), F.col("value").alias(v)) for y, v in (("y0", "v0"), ("y1", "v1")))
    return a.join(pairs, "y0").join(b, ["cell", "y1"]).select("cell", "y0", "y1", (F.col("v1") - F.col("v0")).alias("delta"))


def repaired_by_median(rows: DataFrame, group: str, value: str, valid: Column) -> DataFrame:
    """Invalid values become the median of the group's valid ones; corrected tells where. Rows of a null group have no median."""
    medians = group_medians(rows.where(valid), [group], value).withColumnRenamed("median", "m")
    return rows.join(medians, group, "left").withColumn("corrected", ~valid & F.col("m").isNotNull()).withColumn(value, F.when(valid, F.col(value)).otherwise(F.col("m"))).drop("m")


def headers_down(lines: DataFrame, group: str, order: str, header: Column) -> DataFrame:
    """Detail lines with the last header line before them in their group."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("head", F.last(header, ignorenulls=True).over(w))


def sum_since(cells: DataFrame, yearly: DataFrame, first: int) -> DataFrame:
    """Sum of a cell's yearly counts from its survey year (not before first) on."""
    since = F.greatest(F.lit(first), F.col("since"))
    w = Window.partitionBy("cell").orderBy(F.col("year").desc()).rowsBetween(Window.unboundedPreceding, 0)
    suffix = yearly.withColumn("upto", F.sum("n").over(w))
    return cells.select("cell", since.alias("since")).join(suffix, "cell", "left").where("year is null or year >= since").groupBy("cell").agg(F.coalesce(F.max("upto"), F.lit(0)).alias("total"))


def complete_years(yearly: DataFrame, lo: int, hi: int) -> DataFrame:
    """Mean of the non-zero values of cells over lo to hi, 0 where there is none; only layers with every year count."""
    some = yearly.where(F.col("year").between(lo, hi))
    full = some.groupBy("layer").agg(F.countDistinct("year").alias("n")).where(F.col("n") == hi - lo + 1)
    return some.join(full, "layer", "left_semi").groupBy("layer", "cell").agg(F.coalesce(F.avg(F.nullif("value", F.lit(0))), F.lit(0.0)).alias("mean"))
