"""Terrain forms and drainage on cell tables (row, col, z); rows run south, columns east."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grid import RING, scatter

NAMES = dict(zip(RING, ("nw", "n", "ne", "w", "z", "e", "sw", "s", "se"), strict=True))


def surroundings(cells: DataFrame) -> DataFrame:
    """row, col, z and the eight neighbours by compass name, for cells that have all of them."""
    at = [F.max(F.when((F.col("dr") == i) & (F.col("dc") == j), F.col("v"))).alias(k) for (i, j), k in NAMES.items()]
    return scatter(cells, RING, *at, F.count("v").alias("n_cells")).where("n_cells = 9").drop("n_cells")


def aspect(cells: DataFrame, size: float) -> DataFrame:
    """Compass degrees that the slope faces by weighted differences of the 3 by 3 cells, -1 where it is flat."""
    x = (F.expr("(ne + 2 * e + se) - (nw + 2 * w + sw)") / (8 * size)).alias("x")
    y = (F.expr("(sw + 2 * s + se) - (nw + 2 * n + ne)") / (8 * size)).alias("y")
    turned = F.pmod(90 - F.degrees(F.atan2("y", -F.col("x"))), F.lit(360.0))
    return surroundings(cells).select("row", "col", x, y).select("row", "col", F.when((F.col("x") == 0) & (F.col("y") == 0), -1.0).otherwise(turned).alias("aspect"))


def curvature(cells: DataFrame, size: float) -> DataFrame:
    """Profile, plan and total curvature of the quadratic surface through the 3 by 3 cells; 0 along and across where it is flat."""
    terms = {
        "d": f"((w + e) / 2 - z) / {size * size}D", "g2": f"((n + s) / 2 - z) / {size * size}D", "f": f"(ne + sw - nw - se) / {4 * size * size}D",
        "p": f"(e - w) / {2 * size}D", "q": f"(n - s) / {2 * size}D",
    }
    t = surroundings(cells).select("row", "col", *[F.expr(v).alias(k) for k, v in terms.items()])
    steep = F.expr("p * p + q * q")
    along = F.when(steep == 0, 0.0).otherwise(F.expr("-2 * (d * p * p + g2 * q * q + f * p * q)") / steep)
    across = F.when(steep == 0, 0.0).otherwise(F.expr("2 * (d * q * q + g2 * p * p - f * p * q)") / steep)
    return t.select("row", "col", along.alias("profile"), across.alias("plan"), F.expr("-2 * (d + g2)").alias("total"))


def flow_direction(cells: DataFrame) -> DataFrame:
    """row, col and the neighbour (to_row, to_col) of steepest descent, the first in reading order of equals; null in pits."""
    n = scatter(cells, RING, F.max(F.when((F.col("dr") == 0) & (F.col("dc") == 0), F.col("v"))).alias("z"), F.collect_list(F.struct("dr", "dc", "v")).alias("around")).where("z is not null")
    drop = lambda o: (F.col("z") - o["v"]) / F.sqrt((o["dr"] * o["dr"] + o["dc"] * o["dc"]).cast("double"))
    lower = F.transform(F.filter("around", lambda o: o["v"] < F.col("z")), lambda o: F.struct(drop(o).alias("drop"), (-o["dr"]).alias("up"), (-o["dc"]).alias("left")))
    best = F.array_max(lower)
    return n.select("row", "col", (F.col("row") - best["up"]).alias("to_row"), (F.col("col") - best["left"]).alias("to_col"))


def flow_accumulation(directions: DataFrame, cut: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """row, col, cells: how many cells drain through each, itself included.

    Every round doubles how far upstream is counted and how far down a cell points, so rounds grow with the logarithm of
    the longest path. cut ends the lineage of a round; flow only ever descends, so there are no cycles.
    """
    now = cut(directions.select(F.struct("row", "col").alias("at"), F.when(F.col("to_row").isNotNull(), F.struct(F.col("to_row").alias("row"), F.col("to_col").alias("col"))).alias("to"), F.lit(1).cast("long").alias("n")))
    while not now.where("to is not null").isEmpty():
        arriving = now.where("to is not null").groupBy(F.col("to").alias("into")).agg(F.sum("n").alias("more"))
        further = now.select(F.col("at").alias("via"), F.col("to").alias("next"))
        now = cut(
            now.join(arriving, F.col("at") == F.col("into"), "left").join(further, F.col("to") == F.col("via"), "left").select("at", F.col("next").alias("to"), (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"))
        )
    return now.select("at.row", "at.col", F.col("n").alias("cells"))


def bilinear(coarse: DataFrame, targets: DataFrame, factor: int) -> DataFrame:
    """Targets (row, col) of a grid factor times finer with the weighted mean of the four nearest coarse cells that have values."""
    place = lambda c: (F.col(c) + 0.5) / factor - 0.5
    ends = F.explode(F.array(*[F.struct((F.floor("y") + i).cast("int").alias("kr"), (F.floor("x") + j).cast("int").alias("kc")) for i in (0, 1) for j in (0, 1)])).alias("k")
    near = targets.select("row", "col", place("row").alias("y"), place("col").alias("x")).select("row", "col", "x", "y", ends).select("row", "col", "x", "y", "k.*")
    weight = (1 - F.abs(F.col("y") - F.col("kr"))) * (1 - F.abs(F.col("x") - F.col("kc")))
    values = coarse.where("z is not null").select(F.col("row").alias("kr"), F.col("col").alias("kc"), "z")
    return near.join(values, ["kr", "kc"]).withColumn("w", weight).where("w > 0").groupBy("row", "col").agg((F.sum(F.col("w") * F.col("z")) / F.sum("w")).alias("z"))


def bands(distance: Column, limits: list[float], scores: list[float], beyond: float) -> Column:
    """The score of the first ring whose limit the distance does not exceed, else beyond; null distance gives beyond."""
    made = F.when(F.lit(False), None)
    for limit, s in zip(limits, scores, strict=True):
        made = made.when(distance <= limit, s)
    return made.otherwise(beyond)
