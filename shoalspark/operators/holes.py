"""Enclosed holes of a footprint: cells without a value that no path of such cells, side by side, joins to the outside."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def joined_groups(edges: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node, label over the nodes of edges (a, b, both ways): nodes that edges join share a label.

    Every round each label gives way to the smallest that it touches, and the edges are drawn between labels anew, so
    the graph shrinks from round to round.
    """
    now = cut(edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
    between = cut(edges.where("a != b").distinct())
    while not between.isEmpty():
        parent = between.groupBy("a").agg(F.min("b").alias("p")).where("p < a")
        above = parent.select(F.col("a").alias("a2"), F.col("p").alias("p2"))
        parent = cut(parent.join(above, F.col("p") == F.col("a2"), "left").select(F.col("a").alias("old"), F.coalesce("p2", "p").alias("new")))
        now = cut(now.join(parent, F.col("label") == F.col("old"), "left").select("node", F.coalesce("new", "label").alias("label")))
        one = between.join(parent, F.col("a") == F.col("old"), "left").select(F.coalesce("new", "a").alias("a"), "b")
        between = cut(one.join(parent, F.col("b") == F.col("old"), "left").select("a", F.coalesce("new", "b").alias("b")).where("a != b").distinct())
    return now


def enclosed(cells: DataFrame, cut: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """row, col of the holes in the cells (row, col) that have a z; null z counts as no value, no cells have no holes.

    Work is on the gaps between values along a row, not on cells. A gap leaks if a row beside it has no values there at
    all or ends before the gap does; gaps of neighbouring rows that share a column leak together.
    """
    held = cells.where("z is not null").select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col")).distinct()
    ends = held.groupBy("row").agg(F.min("col").alias("lo"), F.max("col").alias("hi"))
    following = F.lead("col").over(Window.partitionBy("row").orderBy("col"))
    gaps = held.select("row", (F.col("col") + 1).alias("a"), (following - 1).alias("b")).where("b >= a")
    gaps = cut(gaps.withColumn("id", F.struct("row", "a")))
    beside = gaps.select("id", "a", "b", F.explode(F.array(F.col("row") - 1, F.col("row") + 1)).alias("row"))
    open_ = beside.join(ends, "row", "left").where("lo is null or a < lo or b > hi").select("id").distinct()
    below = gaps.select((F.col("row") - 1).alias("row"), F.col("a").alias("c"), F.col("b").alias("d"), F.col("id").alias("other"))
    met = gaps.join(below, "row").where("a <= d and c <= b").select("id", "other")
    own = gaps.select(F.col("id").alias("a"), F.col("id").alias("b"))
    both = own.unionAll(met.toDF("a", "b")).unionAll(met.select("other", "id").toDF("a", "b"))
    groups = joined_groups(both, cut)
    leaking = groups.join(open_, F.col("node") == F.col("id"), "left_semi").select(F.col("label").alias("l")).distinct()
    kept = groups.join(leaking, F.col("label") == F.col("l"), "left_anti").select("node")
    return gaps.join(kept, F.col("id") == F.col("node"), "left_semi").select(F.col("row").cast("int").alias("row"), F.explode(F.sequence(F.col("a").cast("int"), F.col("b").cast("int"))).alias("col"))
