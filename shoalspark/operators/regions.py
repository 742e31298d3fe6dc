"""Regions of cells: labels of connected cells, enclosed holes, and outlines as rings.

Cells are grouped in blocks. A block labels its own cells, and only cells on its border meet the next block's, so the
tables that the rounds of joining work on are borders, not areas.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .holes import joined_groups
from .lineage import cut


def _labels(rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """For each cell the position of the first cell (by row, then col) of its region, neighbours being side by side."""
    order = np.lexsort((cols, rows))
    r, c = rows[order], cols[order]
    new = np.append(True, (r[1:] != r[:-1]) | (c[1:] != c[:-1] + 1))
    run = np.cumsum(new) - 1  # runs along rows are joined, not cells
    first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(r)) - 1
    parent = list(range(len(first)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    of_row = {}
    for k, at in enumerate(first):
        of_row.setdefault(int(r[at]), []).append(k)
    for row, own in of_row.items():
        above, i = of_row.get(row - 1, []), 0
        for k in own:
            while i < len(above) and c[last[above[i]]] < c[first[k]]:
                i += 1
            j = i
            while j < len(above) and c[first[above[j]]] <= c[last[k]]:
                a, b = root(above[j]), root(k)
                parent[max(a, b)] = min(a, b)
                j += 1
    at = first[[root(x) for x in range(len(first))]][run]
    out = np.empty(len(rows), np.int64)
    out[order] = order[at]
    return out


def labelled(cells: DataFrame, block: int = 512) -> DataFrame:
    """row, col, region over the cells (row, col): cells that steps from side to side join share a region.

    A region is named by its first cell, by row and then col, as a struct. Repeated cells count once, an empty table has none.
    """
    b = lambda c: F.floor(F.col(c) / block).cast("int")
    placed = cells.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col")).distinct()

    def one(group: pd.DataFrame) -> pd.DataFrame:
        at = _labels(group["row"].to_numpy(), group["col"].to_numpy())
        return pd.DataFrame({"row": group["row"], "col": group["col"], "r": group["row"].to_numpy()[at], "c": group["col"].to_numpy()[at]})

    own = placed.groupBy(b("row").alias("br"), b("col").alias("bc")).applyInPandas(lambda g: one(g), "row int, col int, r int, c int")
    own = cut(own.select("row", "col", F.struct("r", "c").alias("part")))
    # A cell on a block's last row or column meets the one beyond it.
    south = own.where(F.pmod("row", F.lit(block)) == block - 1).select((F.col("row") + 1).alias("row"), "col", F.col("part").alias("a"))
    east = own.where(F.pmod("col", F.lit(block)) == block - 1).select("row", (F.col("col") + 1).alias("col"), F.col("part").alias("a"))
    edge = own.where((F.pmod("row", F.lit(block)) == 0) | (F.pmod("col", F.lit(block)) == 0)).select("row", "col", F.col("part").alias("b"))
    met = cut(south.unionAll(east).join(edge, ["row", "col"]).select("a", "b").distinct())
    both = met.unionAll(met.select("b", "a").toDF("a", "b"))
    groups = joined_groups(both, cut)
    return own.join(groups, F.col("part") == F.col("node"), "left").select("row", "col", F.coalesce("label", "part").alias("region"))


def enclosed_holes(cells: DataFrame, block: int = 512) -> DataFrame:
    """row, col, region of the cells without a value that no steps from side to side lead from to the outside.

    cells has row, col and z; a null z is no value. Work covers the box round the values, a block a task.
    """
    held = cells.where("z is not null").select("row", "col").distinct()
    span = cut(held.agg(*[f(c).alias(f"{n}_{c}") for c in ("row", "col") for n, f in (("lo", F.min), ("hi", F.max))]).where("lo_row is not null"))
    b = lambda c: F.floor(F.col(c) / block).cast("int")
    blocks = span.select("*", F.explode(F.sequence(b("lo_row"), b("hi_row"))).alias("br")).withColumn("bc", F.explode(F.sequence(b("lo_col"), b("hi_col"))))
    marks = blocks.select("br", "bc", F.lit(None).cast("int").alias("row"), F.lit(None).cast("int").alias("col"), "lo_row", "hi_row", "lo_col", "hi_col")
    rows = held.select(b("row").alias("br"), b("col").alias("bc"), F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), *[F.lit(None).cast("int").alias(c) for c in ("lo_row", "hi_row", "lo_col", "hi_col")])

    def gaps(group: pd.DataFrame) -> pd.DataFrame:
        mark = group[group["row"].isna()].iloc[0]
        r0, c0 = int(mark["br"]) * block, int(mark["bc"]) * block
        lo_r, hi_r = max(r0, int(mark["lo_row"])), min(r0 + block - 1, int(mark["hi_row"]))
        lo_c, hi_c = max(c0, int(mark["lo_col"])), min(c0 + block - 1, int(mark["hi_col"]))
        free = np.ones((hi_r - lo_r + 1, hi_c - lo_c + 1), bool)
        some = group[group["row"].notna()]
        free[some["row"].to_numpy(int) - lo_r, some["col"].to_numpy(int) - lo_c] = False
        i, j = np.nonzero(free)
        return pd.DataFrame({"row": i + lo_r, "col": j + lo_c})

    free = marks.unionByName(rows).groupBy("br", "bc").applyInPandas(gaps, "row int, col int")
    regions = cut(labelled(free, block))
    rim = (F.col("row") == F.col("lo_row")) | (F.col("row") == F.col("hi_row")) | (F.col("col") == F.col("lo_col")) | (F.col("col") == F.col("hi_col"))
    leaking = regions.join(F.broadcast(span)).where(rim).select(F.col("region").alias("open")).distinct()
    return regions.join(leaking, F.col("region") == F.col("open"), "left_anti")


def outlines(cells: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, ring_id and ring of the borders of cells (row, col): corners in order, with the cells to the left of each side.

    Outer rings run one way and holes the other, so signed areas add up to the number of cells. Sides that two cells share
    cancel, sides in a line are one, and a side that starts at a corner of two rings is followed by the left turn. Rings
    are named by their first corner; corners are struct(x, y) with x the column and y the row.
    """
    placed = cells.select(*keys, F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col")).distinct()
    r, c = F.col("row"), F.col("col")
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    # Sides run with the cell to their left: along the row's lower end, then up, back and down.
    ends = [(corner(c, r), corner(c + 1, r)), (corner(c + 1, r), corner(c + 1, r + 1)), (corner(c + 1, r + 1), corner(c, r + 1)), (corner(c, r + 1), corner(c, r))]
    sides = placed.select(*keys, F.explode(F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in ends])).alias("s")).select(*keys, "s.a", "s.b")
    two_way = sides.select(*keys, F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), "a", "b")
    single = cut(two_way.groupBy(*keys, "lo", "hi").agg(F.count(F.lit(1)).alias("n"), F.first("a").alias("a"), F.first("b").alias("b")).where("n = 1").select(*keys, "a", "b"))
    way = lambda a, b: F.struct((F.col(f"{b}.x") - F.col(f"{a}.x")).alias("dx"), (F.col(f"{b}.y") - F.col(f"{a}.y")).alias("dy"))
    ahead = single.select(*[F.col(k).alias("k_" + k) for k in keys], F.col("a").alias("c"), F.col("b").alias("d"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("k_" + k))
    joined = single.join(ahead, same & (F.col("b") == F.col("c"))).withColumn("u", way("a", "b")).withColumn("v", way("c", "d"))
    turn = F.col("u.dx") * F.col("v.dy") - F.col("u.dy") * F.col("v.dx")  # 1 left, 0 on, -1 right
    following = joined.groupBy(*keys, "a", "b").agg(F.max(F.struct(turn.alias("turn"), "d")).alias("m"))
    # Sides are nodes; each leads to the one after it. Pointers double until each knows the first side of its ring.
    node = following.select(*keys, F.struct("a", "b").alias("side"), F.struct(F.col("b").alias("a"), F.col("m.d").alias("b")).alias("to"), F.col("m.turn").alias("bend"))
    node = cut(node.withColumn("ring_id", F.col("side")).withColumn("step", F.lit(1).cast("long")))
    jumps = cut(node.select(*keys, "side", "to", F.least("side", "to").alias("least")))
    while True:
        other = jumps.select(*[F.col(k).alias("k_" + k) for k in keys], F.col("side").alias("at"), F.col("to").alias("next"), F.col("least").alias("more"))
        again = cut(jumps.join(other, same & (F.col("to") == F.col("at"))).select(*keys, "side", F.col("next").alias("to"), F.least("least", "more").alias("least"), (F.col("more") < F.col("least")).alias("fell")))
        jumps = again.drop("fell")
        if again.where("fell").isEmpty():
            break
    # From the first side on, how far each side is: distances double from the sides that lead to the first one.
    named = cut(node.drop("ring_id", "step").join(jumps.select(*[F.col(k).alias("k_" + k) for k in keys], F.col("side").alias("own"), F.col("least").alias("ring_id")), same & (F.col("side") == F.col("own"))).select(*keys, "side", "to", "bend", "ring_id"))
    ranks = cut(named.select(*keys, "side", F.when(F.col("to") != F.col("ring_id"), F.col("to")).alias("to"), F.lit(1).cast("long").alias("left")))
    while not ranks.where("to is not null").isEmpty():
        other = ranks.select(*[F.col(k).alias("k_" + k) for k in keys], F.col("side").alias("at"), F.col("to").alias("next"), F.col("left").alias("more"))
        ranks = cut(ranks.join(other, same & (F.col("to") == F.col("at")), "left").select(*keys, "side", F.col("next").alias("to"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left")))
    order = ranks.select(*[F.col(k).alias("k_" + k) for k in keys], F.col("side").alias("own"), "left")
    whole = named.join(order, same & (F.col("side") == F.col("own"))).where("bend != 0")
    point = F.struct((-F.col("left")).alias("at"), F.col("side.b.x").cast("double").alias("x"), F.col("side.b.y").cast("double").alias("y"))
    rings = whole.groupBy(*keys, "ring_id").agg(F.sort_array(F.collect_list(point)).alias("p"))
    return rings.select(*keys, F.concat_ws("_", "ring_id.a.x", "ring_id.a.y", "ring_id.b.x", "ring_id.b.y").alias("ring_id"), F.transform("p", lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y"))).alias("ring"))


def signed_area(ring: Column) -> Column:
    """Area of a ring, above zero if it runs with its inside to the left."""
    from .polygons import edges

    return F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]) / 2
