"""The summary grid of a mask, and hazards joined to it: cells on equal keys first, shapes after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import hazards as H
from .lineage import cut
from .polygons import rectangle, touch
from .regions import labelled


def summary_grid(mask: DataFrame, size: float, wanted: float = 500.0, region: str = "ER", merged: bool = False) -> DataFrame:
    """grid_id, row, col of the coarse cells that hold a mask cell (row, col, z) of 1.

    A coarse cell is as many cells wide as come nearest to the wanted width, halves to even, one at least. Each is a grid
    cell of its own, numbered by row and then col; merged gives cells that lie side by side one id, as turning a raster
    into shapes does, numbered by their first cell. Other values and nulls are outside; an empty mask has no grid.
    """
    factor = max(1, round(wanted / size))
    at = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in ("row", "col")]
    cells = cut(mask.where("z = 1").select(*at).distinct())
    named = labelled(cells).select("row", "col", F.col("region.r").alias("r"), F.col("region.c").alias("c")) if merged else cells.select("row", "col", F.col("row").alias("r"), F.col("col").alias("c"))
    # Numbers come from the count of first cells in the rows above, so no task sees all cells.
    firsts = cut(named.select("r", "c").distinct())
    above = firsts.groupBy("r").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("r")) - F.col("n")).select(F.col("r").alias("of"), "before")
    number = firsts.join(F.broadcast(above), F.col("r") == F.col("of")).select("r", "c", (F.col("before") + F.row_number().over(Window.partitionBy("r").orderBy("c"))).alias("number"))
    return named.join(number, ["r", "c"]).select(F.concat(F.lit(f"{region}_grid_"), F.col("number").cast("string")).alias("grid_id"), "row", "col")


def grid_hazards(grid: DataFrame, hazards: DataFrame, width: float) -> DataFrame:
    """The rows of hazards with each grid_id whose cells their ring shares a point with, once for each grid_id.

    Cells are squares of the given width from row and col 0 on. A point is a ring of one point, a line one that runs there
    and back. Hazards without a ring touch nothing.
    """
    end = lambda f, k: f(F.transform("ring", lambda p: p[k]))
    # A box that ends on a cell's border touches the cell before it too.
    span = lambda k: F.explode(F.sequence((F.ceil(end(F.array_min, k) / width) - 1).cast("int"), F.floor(end(F.array_max, k) / width).cast("int")))
    placed = hazards.where(F.size("ring") > 0).select("*", span("y").alias("row")).select("*", span("x").alias("col"))
    x, y = F.col("col") * width, F.col("row") * width
    met = placed.join(grid, ["row", "col"]).where(touch(F.col("ring"), rectangle(x, y, x + width, y + width)))
    return met.drop("row", "col").dropDuplicates(["grid_id", "hazard_id"])


def within_area(hazards: DataFrame, grid: DataFrame, width: float) -> DataFrame:
    """The hazards that touch the area of the grid, each once."""
    ids = grid_hazards(grid, hazards, width).select("hazard_id").distinct()
    return hazards.join(ids, "hazard_id", "left_semi")


def hazards_of_mask(mask: DataFrame, size: float, hazards: DataFrame, wanted: float = 500.0, region: str = "ER", merged: bool = False) -> DataFrame:
    """A row for each grid_id of the mask: counts of the hazards that touch it and the highest scores, zeros without any."""
    grid = cut(summary_grid(mask, size, wanted, region, merged))
    met = grid_hazards(grid, hazards, max(1, round(wanted / size)) * size)
    return H.grid_summary(grid.select("grid_id").distinct(), met)


def point(x: Column, y: Column) -> Column:
    """The ring of a single point."""
    return F.array(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
