"""Classes of navigational risk on a grid of cells: densities and distances of reported features, rescue, bottoms, depths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores as S

#: Cells in each row of the circles that features are counted in, by the circle's width in cells.
CIRCLES = {
    3: (1, 3, 1),
    5: (1, 3, 5, 3, 1),
    9: (3, 5, 7, 9, 9, 9, 7, 5, 3),
    17: (3, 7, 11, 13, 13, 15, 15, 17, 17, 17, 15, 15, 13, 13, 11, 7, 3),
    31: (7, 13, 17, 19, 21, 23, 25, 27, 27, 29, 29, 29, 31, 31, 31, 31, 31, 31, 31, 29, 29, 29, 27, 27, 25, 23, 21, 19, 17, 13, 7),
}
#: Circle -> class of cells that see a feature within it. Doubtful existence reaches further than position.
NEAR_POSITION = {3: 5, 5: 4, 9: 3, 17: 2}
NEAR_EXISTENCE = {5: 5, 9: 4, 17: 3, 31: 2}
#: Codes of bottom types in their three schemes.
BOTTOM_1 = {
    "BOULDER": 1, "CLAY": 2, "COBBLES": 3, "CORAL": 4, "GRAVEL": 5, "HARD": 6, "MUD": 7, "OOZE": 8, "PEBBLES": 9, "ROCKY": 10, "SAND": 11, "SHALE": 12,
    "SHELL": 13, "SILT": 14, "STONE": 15, "VOLCANIC": 16, "CINDER": 17, "UNKNOWN": 0,
}
BOTTOM_2 = {"MUD": 1, "SAND": 2, "ROCK": 5, "UNKNOWN": 0}
BOTTOM_3 = {"HARD": 5, "SOFT": 2, "UNKNOWN": 0}


def circle(width: int) -> set[tuple[int, int]]:
    """Places (row, col) of a circle's cells round its middle."""
    half = width // 2
    return {(i - half, j) for i, cells in enumerate(CIRCLES[width]) for j in range(-(cells // 2), cells // 2 + 1)}


def _spread(cells: DataFrame, places: list[tuple], *keep: str) -> DataFrame:
    """Each row once for each place (dr, dc, near, counts) that it is seen from, at the row and col of that place."""
    # As one expression: hundreds of places made one by one through the driver's gateway would take seconds.
    seen = F.explode(F.expr("array(" + ", ".join("named_struct('dr', {}, 'dc', {}, 'near', {}, 'counts', {})".format(*p) for p in places) + ")")).alias("o")
    sent = cells.select("row", "col", *keep, seen)
    return sent.select((F.col("row") - F.col("o.dr")).alias("row"), (F.col("col") - F.col("o.dc")).alias("col"), *keep, "o.near", "o.counts")


def surveyed_around(points: DataFrame, near: dict[int, int], counted: int = 17) -> DataFrame:
    """row, col, n, near for the cells that see points (row, col): how many lie in the circle counted, and the class of the nearest.

    near gives a circle's class, the highest of those that hold a point counting. Points are summed by cell first.
    """
    reach = {w: circle(w) for w in {*near, counted}}
    places = [(*p, max([c for w, c in near.items() if p in reach[w]], default=0), int(p in reach[counted])) for p in sorted(set().union(*reach.values()))]
    sums = points.groupBy("row", "col").agg(F.count(F.lit(1)).alias("z"))
    return _spread(sums, places, "z").groupBy("row", "col").agg(F.sum(F.col("z") * F.col("counts")).alias("n"), F.max("near").alias("near"))


def features_around(cells: DataFrame, counted: int = 17) -> DataFrame:
    """row, col, n: how many features (cells: feature, row, col) have a cell in the circle, each counting once."""
    places = [(*p, 0, 1) for p in sorted(circle(counted))]
    return _spread(cells, places, "feature").groupBy("row", "col", "feature").agg(F.lit(1).alias("one")).groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"))


def density_class(n: Column) -> Column:
    """Class of a count: none 1, one 2, up to four 4, more 5; null stays."""
    return F.when(n > 4, 5).when(n >= 2, 4).when(n >= 1, 2).when(n.isNotNull(), 1)


def boaters_class(n: Column) -> Column:
    """Class of a count of boaters' reports: none 1, one 2, up to ten 3, up to a hundred 4, more 5; null stays."""
    return F.when(n > 100, 5).when(n >= 11, 4).when(n >= 2, 3).when(n == 1, 2).when(n.isNotNull(), 1)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def groundings(grid: DataFrame, points: DataFrame) -> DataFrame:
    """row, col, class of the grid's cells by density and distance of groundings, the higher of the two."""
    seen = surveyed_around(points, NEAR_POSITION)
    return grid.join(seen, ["row", "col"], "left").select("row", "col", F.greatest(density_class(_zero("n")), _zero("near")).alias("class"))


def reported_errors(grid: DataFrame, position: DataFrame, existence: DataFrame) -> DataFrame:
    """row, col, class of the grid's cells: the highest of the distances to points of doubtful position and existence and their joint density."""
    one = surveyed_around(position, NEAR_POSITION).withColumnsRenamed({"n": "n1", "near": "near1"})
    two = surveyed_around(existence, NEAR_EXISTENCE, 31).withColumnsRenamed({"n": "n2", "near": "near2"})
    both = grid.join(one, ["row", "col"], "left").join(two, ["row", "col"], "left")
    return both.select("row", "col", F.greatest(density_class(_zero("n1") + _zero("n2")), _zero("near1"), _zero("near2")).alias("class"))


def rescue_class(metres: Column, length_class: Column) -> Column:
    """Class 0 to 5 of the distance to rescue and the length of vessels; without vessels it is 0."""
    far = S.steps(metres, [(138900, -3), (277800, -2), (555600, -1), (1111000, 0)], 1)
    total = F.coalesce(far + length_class, F.lit(-5))
    return F.when(total <= -4, 0).when(total <= 0, total + 4).otherwise(5)


def bottom_code(name: Column, codes: dict[str, int]) -> Column:
    """The code of a bottom type in capitals; null for names that the scheme does not have."""
    return F.try_element_at(F.create_map(*[F.lit(v) for kv in codes.items() for v in kv]), name)


def depth_class(depth: Column) -> Column:
    """Class of a depth: to 4 m 3, to 20 m 4, to 50 m 3, to 100 m 2, deeper 1."""
    return S.steps(depth, [(4, 3), (20, 4), (50, 3), (100, 2)], 1)


def current_class(speed: Column) -> Column:
    """Class of a current: to 0.1 1, to 0.2 2, to 0.5 3, to 1 4, to 100 5; others are null."""
    return F.when(speed.between(0, 100), S.steps(speed, [(0.1, 1), (0.2, 2), (0.5, 3), (1, 4)], 5))


def complexity(slope: Column, threshold: float, *others: Column) -> Column:
    """100 where the slope is above the threshold or another class says so, else 1; the highest of what there is."""
    return F.greatest(F.when(slope > threshold, 100).when(slope.isNotNull(), 1), *others)


def decoded(key: Column, present_year: int = 2018) -> dict[str, Column]:
    """Class, year, age and doubt (a class above 2) of a survey priority key: its first digit is 6 less the class, the last four are the year."""
    digits = key.cast("long").cast("string")
    zone = 6 - F.substring(digits, 1, 1).cast("int")
    year = F.right(digits, F.lit(4)).cast("int")
    return {"class": zone, "year": year, "age": present_year - year, "doubtful": zone > 2}
