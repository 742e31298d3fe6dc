"""Connected components by alternating stars: every round is joins and partial aggregations, none holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, dealt_anew


def _star(pairs: DataFrame, centre: str, others: str, least: str) -> DataFrame:
    """src, dst (dst < src): the others of each centre linked to the least of its group."""
    m = pairs.groupBy(centre).agg(F.least(F.min(others), F.col(centre)).alias("m")).select(dealt_anew(F.col(centre)).alias("c"), "m")
    linked = pairs.select(dealt_anew(F.col(centre)).alias("c"), F.col(centre).alias("centre"), F.col(others).alias("other")).join(m, "c")
    if least == "larger":
        made = linked.where("other > centre").select(F.col("other").alias("src"), F.col("m").alias("dst"))
    else:
        made = linked.select(F.explode(F.array(F.struct(F.col("other").alias("src"), F.col("m").alias("dst")), F.struct(F.col("centre").alias("src"), F.col("m").alias("dst")))).alias("e")).select("e.*")
    return made.where("src != dst").groupBy("src", "dst").agg(F.lit(1).alias("one")).drop("one")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root over the nodes of edges (bigint columns a and b): root is the smallest node reachable, itself included.

    Nulls and self-links are ignored, repeated links count once, an empty table gives no rows. The rounds needed grow
    with the logarithm of the longest chain.
    """
    links = edges.select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")).where("src != dst")  # a null end makes both equal
    now = cut(links.groupBy("src", "dst").agg(F.lit(1).alias("one")).drop("one"))
    mark = _mark(now)
    while mark[0]:
        both = now.select("src", "dst").unionAll(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        larger = _star(both, "src", "dst", "larger")
        now = cut(_star(larger, "src", "dst", "all"))
        if (after := _mark(now)) == mark:
            break
        mark = after
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("root")).groupBy("node", "root").agg(F.lit(1).alias("one")).drop("one")
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionAll(roots)
