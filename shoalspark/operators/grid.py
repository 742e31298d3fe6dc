"""Raster operators on cell tables (row, col, value): one row a cell, missing cells absent or null.

Neighbourhoods are scattered: a cell sends its value to the cells that see it, and a partial aggregate sums before the
shuffle. No operator holds a raster in one task.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RING = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]


def scatter(cells: DataFrame, offsets: Iterable[tuple[int, int]], *sums: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, row, col with aggregates over the cells at the offsets; in sums, v is a neighbour's value, dr and dc its place."""
    moves = F.explode(F.array(*[F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc")) for i, j in offsets])).alias("o")
    sent = cells.where("z is not null").select(*keys, "row", "col", F.col("z").alias("v"), moves)
    sent = sent.select(*keys, (F.col("row") - F.col("o.dr")).alias("row"), (F.col("col") - F.col("o.dc")).alias("col"), "v", F.col("o.dr").alias("dr"), F.col("o.dc").alias("dc"))
    return sent.groupBy(*keys, "row", "col").agg(*sums)


def _at(i: int, j: int) -> Column:
    return F.max(F.when((F.col("dr") == i) & (F.col("dc") == j), F.col("v")))


def slope(cells: DataFrame, size: float) -> DataFrame:
    """Degrees from central differences, one-sided at an edge; null where an axis has no neighbour or the cell is null."""
    cross = [(0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)]
    n = scatter(cells, cross, _at(0, 0).alias("z"), *[_at(i, j).alias(k) for k, (i, j) in zip("nswe", cross[1:], strict=True)]).where("z is not null")
    axis = lambda a, b: F.coalesce((F.col(b) - F.col(a)) / (2 * size), (F.col(b) - F.col("z")) / size, (F.col("z") - F.col(a)) / size)
    return n.select("row", "col", F.degrees(F.atan(F.sqrt(F.pow(axis("n", "s"), 2) + F.pow(axis("w", "e"), 2)))).alias("slope"))


def ruggedness(cells: DataFrame) -> DataFrame:
    """Mean absolute difference to the neighbours that have a value."""
    around = scatter(cells, RING, _at(0, 0).alias("z"), F.collect_list(F.when((F.col("dr") != 0) | (F.col("dc") != 0), F.col("v"))).alias("vs")).where("z is not null")
    return around.select("row", "col", F.try_divide(F.aggregate("vs", F.lit(0.0), lambda a, v: a + F.abs(v - F.col("z"))), F.size("vs")).alias("tri"))


def roughness(cells: DataFrame) -> DataFrame:
    """Largest less smallest value of the 3 by 3 cells."""
    return scatter(cells, RING, _at(0, 0).alias("z"), (F.max("v") - F.min("v")).alias("roughness")).where("z is not null").drop("z")


def box_mean(cells: DataFrame, half: int, whole: bool = False) -> DataFrame:
    """Mean of the values within half cells, summed by rows and then by columns; whole also fills cells without a value."""
    span = range(-half, half + 1)
    rows = scatter(cells, [(0, j) for j in span], F.sum("v").alias("s"), F.count("v").alias("n"))
    both = rows.select("row", "col", F.struct("s", "n").alias("z"))
    made = scatter(both, [(i, 0) for i in span], F.sum("v.s").alias("s"), F.sum("v.n").alias("n")).select("row", "col", (F.col("s") / F.col("n")).alias("mean"))
    return made if whole else made.join(cells.where("z is not null").select("row", "col"), ["row", "col"], "left_semi")


def focal_fill(cells: DataFrame, half: int = 2, rounds: int = 5, cut=lambda df: df) -> DataFrame:
    """Null cells become the mean of the values within half cells, again and again; values stay. cut ends the lineage."""
    for _ in range(rounds):
        means = box_mean(cells, half, whole=True)
        cells = cut(cells.join(means, ["row", "col"], "left").select("row", "col", F.coalesce("z", "mean").alias("z")))
    return cells


def annulus(inner: float, outer: float) -> list[tuple[int, int]]:
    k = int(outer)
    return [(i, j) for i in range(-k, k + 1) for j in range(-k, k + 1) if inner < (i * i + j * j) ** 0.5 <= outer]


def position_index(cells: DataFrame, inner: float, outer: float) -> DataFrame:
    """Value less the mean of the cells whose distance is above inner and at most outer."""
    ring = scatter(cells, annulus(inner, outer), F.avg("v").alias("mean"))
    return cells.where("z is not null").join(ring, ["row", "col"], "left").select("row", "col", (F.col("z") - F.col("mean")).alias("bpi"))


def position_index_blocks(cells: DataFrame, inner: float, outer: float, block: int = 256) -> DataFrame:
    """position_index for wide rings: blocks of cells with their halo; a ring is a few runs of cells in each row, summed by prefix sums."""
    k = int(outer)
    b = lambda c, d: F.floor((F.col(c) + d) / block).cast("int")
    spread = cells.where("z is not null").select("row", "col", "z", F.explode(F.array_distinct(F.array(*[F.struct(b("row", i).alias("br"), b("col", j).alias("bc")) for i in (-k, 0, k) for j in (-k, 0, k)]))).alias("b"))

    def one(group: pd.DataFrame) -> pd.DataFrame:
        r0, c0, n = group["br"].iloc[0] * block - k, group["bc"].iloc[0] * block - k, block + 2 * k
        z, has = np.zeros((n, n)), np.zeros((n, n))
        i, j = group["row"].to_numpy() - r0, group["col"].to_numpy() - c0
        z[i, j], has[i, j] = group["z"], 1
        runs = []  # row offset, reach of the outer circle, reach of the inner one (-1: none)
        for d in range(-k, k + 1):
            rest = np.arange(k + 1)
            far = np.sqrt(d * d + rest * rest)
            runs.append((d, int((far <= outer).sum()) - 1, int((far <= inner).sum()) - 1))
        total, count = np.zeros((n, n)), np.zeros((n, n))
        for values, into in ((z, total), (has, count)):
            upto = np.pad(np.cumsum(values, axis=1), ((0, 0), (1, 0)))
            for d, reach, less in runs:
                for width, sign in ((reach, 1), (less, -1)):
                    if width >= 0:
                        left, right = np.maximum(np.arange(n) - width, 0), np.minimum(np.arange(n) + width + 1, n)
                        part = upto[:, right] - upto[:, left]
                        rows = slice(max(0, -d), min(n, n - d))
                        into[rows] += sign * part[max(0, d) : min(n, n + d)]
        own = (i >= k) & (i < k + block) & (j >= k) & (j < k + block)
        i, j, count = i[own], j[own], np.rint(count)
        with np.errstate(all="ignore"):
            value = z[i, j] - np.where(count[i, j] > 0, total[i, j] / count[i, j], np.nan)
        return pd.DataFrame({"row": i + r0, "col": j + c0, "bpi": value})

    return spread.select("row", "col", "z", "b.*").groupBy("br", "bc").applyInPandas(one, "row int, col int, bpi double").withColumn("bpi", F.nanvl("bpi", F.lit(None).cast("double")))


def coarser(cells: DataFrame, factor: int, how: str = "avg") -> DataFrame:
    by = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in ("row", "col")]
    return cells.groupBy(*by).agg(getattr(F, how)("z").alias("z"))


def mosaic(layers: DataFrame, rule: str, order: str = "layer") -> DataFrame:
    """One value a cell of overlapping layers: max, min, first or last by order; nulls never cover values."""
    some = layers.where("z is not null")
    agg = {"max": F.max("z"), "min": F.min("z"), "first": F.min_by("z", order), "last": F.max_by("z", order), "mean": F.avg("z")}[rule]
    return some.groupBy("row", "col").agg(agg.alias("z"))


def quantiles(cells: DataFrame, shares: list[float], cut) -> DataFrame:
    """share, value: the values below which shares of all values lie, between neighbours in proportion; nulls do not count.

    Values are range-partitioned, and only how many each partition holds is summed in one place, so none holds them all.
    cut ends the lineage, as partitions must stay what they are.
    """
    held = cut(cells.where("z is not null").select("z").repartitionByRange("z").select("z", F.spark_partition_id().alias("part")))
    from pyspark.sql.window import Window

    sizes = held.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("z").alias("least"))
    before = sizes.select(F.col("part").alias("of"), (F.sum("n").over(Window.orderBy("least")) - F.col("n")).alias("before"))
    ranked = held.withColumn("within", F.row_number().over(Window.partitionBy("part").orderBy("z")) - 1).join(before, F.col("part") == F.col("of"))
    total = sizes.agg(F.sum("n").alias("total"))
    wanted = total.select("total", F.explode(F.array(*map(F.lit, map(float, shares)))).alias("share")).withColumn("at", (F.col("total") - 1) * F.col("share"))
    place = F.col("before") + F.col("within")
    near = ranked.select("z", place.alias("place")).join(F.broadcast(wanted), (F.col("place") == F.floor("at")) | (F.col("place") == F.ceil("at")))
    weight = F.when(F.floor("at") == F.ceil("at"), 1.0).otherwise(1 - F.abs(F.col("at") - F.col("place")))
    return near.groupBy("share").agg(F.sum(F.col("z") * weight).alias("value"))


def terrain_class(broad: Column, fine: Column, slope_deg: Column, b: tuple[Column, Column], f: tuple[Column, Column], s: Column) -> Column:
    """First of eight rules over broad and fine position index and slope, with low and high breaks."""
    return (
        F.when((broad <= b[0]) & (fine <= f[0]), 1)
        .when((broad <= b[0]) & (fine >= f[1]), 2)
        .when(broad <= b[0], 3)
        .when((broad >= b[1]) & (fine <= f[0]), 4)
        .when((broad >= b[1]) & (fine >= f[1]), 5)
        .when(broad >= b[1], 6)
        .when(slope_deg >= s, 7)
        .when(broad.isNotNull() & fine.isNotNull() & slope_deg.isNotNull(), 8)
    )


def box_mean_blocks(cells: DataFrame, half: int, block: int = 256) -> DataFrame:
    """Mean of the values within half cells to each side, for all cells of the box round the table's cells that see one.

    For wide squares: blocks at least twice as wide as the halo, so a cell goes to four of them on the whole, and sums from
    tables of running sums over rows and columns.
    """
    block = max(block, 2 * half)
    b = lambda c, d: F.floor((F.col(c) + d) / block).cast("int")
    spread = cells.where("z is not null").select("row", "col", F.col("z").cast("double").alias("z"), F.explode(F.array_distinct(F.array(*[F.struct(b("row", i).alias("br"), b("col", j).alias("bc")) for i in (-half, 0, half) for j in (-half, 0, half)]))).alias("b"))
    n = block + 2 * half

    def one(group: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = group["br"].iloc[0] * block - half, group["bc"].iloc[0] * block - half
        i, j = group["row"].to_numpy() - r0, group["col"].to_numpy() - c0
        made = []
        for values in (group["z"].to_numpy(), np.ones(len(group))):
            upto = np.zeros((n + 1, n + 1))
            upto[i + 1, j + 1] = values
            upto = upto.cumsum(0).cumsum(1)
            w = 2 * half + 1
            made.append(upto[w:, w:] - upto[:-w, w:] - upto[w:, :-w] + upto[:-w, :-w])
        total, count = made[0], np.rint(made[1])
        i, j = np.nonzero(count)
        return pd.DataFrame({"row": i + r0 + half, "col": j + c0 + half, "mean": total[i, j] / count[i, j]})

    means = spread.select("row", "col", "z", "b.*").groupBy("br", "bc").applyInPandas(one, "row int, col int, mean double")
    box = cells.agg(*[f(c).alias(f"{n}_{c}") for c in ("row", "col") for n, f in (("lo", F.min), ("hi", F.max))])
    return means.join(F.broadcast(box)).where("row between lo_row and hi_row and col between lo_col and hi_col").select("row", "col", "mean")


def smoothed(cells: DataFrame, metres: float, size: float) -> DataFrame:
    """Mean of the values within a square of metres to each side; cells without a value that see one get it too.

    The layers of sediment in suspension are filled so. Cells outside the box round the table's cells are none of the raster.
    """
    return box_mean_blocks(cells, int(metres / size)).withColumnRenamed("mean", "z")


def downslope(cells: DataFrame) -> DataFrame:
    """row, col, down (struct of dr and dc): which way a cell falls, by central differences, one-sided at an edge; level cells are absent."""
    cross = [(0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)]
    n = scatter(cells, cross, _at(0, 0).alias("z"), *[_at(i, j).alias(k) for k, (i, j) in zip("nswe", cross[1:], strict=True)]).where("z is not null")
    axis = lambda a, b: F.coalesce((F.col(b) - F.col(a)) / 2, F.col(b) - F.col("z"), F.col("z") - F.col(a), F.lit(0.0))
    return n.select("row", "col", F.struct((-axis("n", "s")).alias("dr"), (-axis("w", "e")).alias("dc")).alias("down")).where("down.dr != 0 or down.dc != 0")


def convergence_index(cells: DataFrame) -> DataFrame:
    """Mean angle between the way the neighbours fall and the direction from them to the cell, less 90 degrees.

    -90 where all neighbours fall towards the cell, 90 where all fall away from it. Level neighbours have no direction and
    do not count; a cell without others is left out.
    """
    ways = downslope(cells).withColumnRenamed("down", "z")
    v, away = F.col("v"), [o for o in RING if o != (0, 0)]
    along = -(v["dr"] * F.col("dr") + v["dc"] * F.col("dc")) / (F.sqrt(v["dr"] * v["dr"] + v["dc"] * v["dc"]) * F.sqrt(F.col("dr") * F.col("dr") + F.col("dc") * F.col("dc")))
    angle = F.degrees(F.acos(F.greatest(F.least(along, F.lit(1.0)), F.lit(-1.0))))
    return scatter(ways, away, (F.avg(angle) - 90).alias("index")).join(cells.where("z is not null").select("row", "col"), ["row", "col"], "left_semi")


def convergence(cells: DataFrame) -> DataFrame:
    """Mean of the eight neighbours less the value, for cells that have all eight: a simple stand-in for convergence_index."""
    side = F.when((F.col("dr") != 0) | (F.col("dc") != 0), F.col("v"))
    around = scatter(cells, RING, _at(0, 0).alias("z"), F.avg(side).alias("mean"), F.count(side).alias("n")).where("z is not null and n = 8")
    return around.select("row", "col", (F.col("mean") - F.col("z")).alias("tci"))


def depth_band(cells: DataFrame, lo: float, hi: float) -> DataFrame:
    """row, col of the cells whose value lies from lo to hi, as between two isobaths."""
    return cells.where(F.col("z").between(lo, hi)).select("row", "col")


def presence(cells: DataFrame) -> DataFrame:
    """row, col, z: 1 where a cell has a value, else 0."""
    return cells.select("row", "col", F.col("z").isNotNull().cast("int").alias("z"))


def masked(cells: DataFrame, mask: DataFrame) -> DataFrame:
    """The cells that the mask (row, col) has, as cutting to an outline leaves them; their other columns stay."""
    return cells.join(mask, ["row", "col"], "left_semi")


def shared_extent(layers: DataFrame, order: str) -> DataFrame:
    """The box round all layers (x0, y0, x1, y1) and the cell size of the first."""
    return layers.agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.min_by("size", order).alias("size"))


def clearances(depths: DataFrame, drafts: DataFrame) -> DataFrame:
    """row, col, ukc: mean depth of each draft cell, of either sign, less the largest draft of its months; drafts of 0 are none."""
    most = drafts.where("draft > 0").groupBy("row", "col").agg(F.max("draft").alias("draft"))
    mean = depths.where("z is not null").groupBy("row", "col").agg(F.avg("z").alias("z"))
    return most.join(mean, ["row", "col"]).select("row", "col", (F.abs("z") - F.col("draft")).alias("ukc"))
