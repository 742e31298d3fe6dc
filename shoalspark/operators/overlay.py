"""Overlay of polygons: intersection, union and difference as pieces between horizontal lines, and their areas.

Lines through all corners and crossings cut two polygons into slabs in which no sides meet, so whatever is inside either
runs between pairs of sides. Pieces are trapezoids; their areas add up to that of the result exactly, holes and several
parts included. Pairs come from a join on tiles, each pair once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import kernels as K
from .polygons import _covered, _in_tiles, _tiled, intersecting

RULES: dict[str, Callable[[bool, bool], bool]] = {"intersection": lambda a, b: a and b, "union": lambda a, b: a or b, "difference": lambda a, b: a and not b}
RING = "array<struct<x:double,y:double>>"


def _sides(rings: list[np.ndarray]) -> np.ndarray:
    """x1, y1, x2, y2 of all sides, upwards; level sides bound nothing between lines."""
    some = [np.hstack([r, np.roll(r, -1, 0)]) for r in rings if len(r) > 2]
    sides = np.vstack(some) if some else np.empty((0, 4))
    sides = sides[sides[:, 1] != sides[:, 3]]
    turn = sides[:, 1] > sides[:, 3]
    sides[turn] = sides[turn][:, [2, 3, 0, 1]]
    return sides


def _heights(sides: np.ndarray) -> np.ndarray:
    """Heights of all corners and of all points where two sides cross."""
    y = [sides[:, 1], sides[:, 3]]
    dx, dy = sides[:, 2] - sides[:, 0], sides[:, 3] - sides[:, 1]
    for k in range(len(sides) - 1):
        rest = slice(k + 1, None)
        cross = dx[k] * dy[rest] - dy[k] * dx[rest]
        some = np.flatnonzero(cross) + k + 1
        t = ((sides[some, 0] - sides[k, 0]) * dy[some] - (sides[some, 1] - sides[k, 1]) * dx[some]) / (dx[k] * dy[some] - dy[k] * dx[some])
        at = sides[k, 1] + t * dy[k]
        y.append(at[(t > 0) & (t < 1) & (at > sides[some, 1]) & (at < sides[some, 3])])
    return np.unique(np.concatenate(y))


def pieces(a: list[np.ndarray], b: list[np.ndarray], rule: str) -> list[np.ndarray]:
    """Trapezoids (four corners, counter-clockwise) of the rule over two sets of rings, each by even and odd crossings."""
    sides = [_sides(a), _sides(b)]
    every, of = np.vstack(sides), np.repeat([0, 1], [len(s) for s in sides])
    if not len(every):
        return []
    y, keep, made = _heights(every), RULES[rule], []
    slope = (every[:, 2] - every[:, 0]) / (every[:, 3] - every[:, 1])
    for low, high in zip(y[:-1], y[1:], strict=True):
        middle = (low + high) / 2
        here = np.flatnonzero((every[:, 1] < middle) & (every[:, 3] > middle))
        here = here[np.argsort(every[here, 0] + (middle - every[here, 1]) * slope[here], kind="stable")]
        inside, start = [False, False], None
        for k in here.tolist():
            was = keep(*inside)
            inside[of[k]] = not inside[of[k]]
            now = keep(*inside)
            if now and not was:
                start = k
            elif was and not now:
                x = lambda s, h: every[s, 0] + (h - every[s, 1]) * slope[s]
                piece = np.array([(x(start, low), low), (x(k, low), low), (x(k, high), high), (x(start, high), high)])
                if area([piece]) > 0:
                    made.append(piece)
    return made


def area(rings: list[np.ndarray]) -> float:
    """Sum of the rings' areas, those that run clockwise below zero."""
    return float(sum((r[:, 0] * np.roll(r[:, 1], -1) - np.roll(r[:, 0], -1) * r[:, 1]).sum() / 2 for r in rings))


def _array(ring) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2)


def _rows(rings: list[np.ndarray]) -> list:
    return [[{"x": x, "y": y} for x, y in r.tolist()] for r in rings]


def overlay(left: DataFrame, right: DataFrame, size: float, rule: str = "intersection") -> DataFrame:
    """a_id, b_id, area and pieces (rings) of the rule over each pair of polygons (a_id or b_id, ring) that share a point.

    Pairs whose result has no area, as those that only touch have no intersection, are left out.
    """
    pairs = intersecting(left, right, size)
    both = pairs.join(left.select("a_id", F.col("ring").alias("one")), "a_id").join(right.select("b_id", F.col("ring").alias("other")), "b_id")
    kinds = f"a_id {left.schema['a_id'].dataType.simpleString()}, b_id {right.schema['b_id'].dataType.simpleString()}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [pieces([_array(a)], [_array(b)], rule) for a, b in zip(batch["one"], batch["other"], strict=True)]
            yield pd.DataFrame({"a_id": batch["a_id"], "b_id": batch["b_id"], "area": [area(m) for m in made], "pieces": [_rows(m) for m in made]})

    return both.select("a_id", "b_id", "one", "other").mapInPandas(run, f"{kinds}, area double, pieces array<{RING}>").where("area > 0")


def shared_areas(left: DataFrame, right: DataFrame, size: float, block_rows: int = 4096) -> DataFrame:
    """a_id, b_id, shared and rest: the areas of overlay's intersection and difference for each pair that shares a point, in one pass.

    Rings are worked out where their tile is searched; pairs are neither joined nor cut into pieces.
    """
    schema = StructType([left.schema["a_id"], right.schema["b_id"], StructField("shared", DoubleType()), StructField("rest", DoubleType())])

    def search(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        a, b = K.Rings(ours["ring"]), K.Rings(theirs["ring"])
        corner = tuple(float(ours[c][0].as_py()) for c in ("_tx", "_ty")) if len(ours) else (0.0, 0.0)
        pairs = list(K.meeting(a, b, corner, size))
        i, j = (np.concatenate(f) for f in zip(*pairs, strict=True)) if pairs else (np.empty(0, int), np.empty(0, int))
        shared, rest = K.shares(a, b, i, j)
        return pa.table([ours["a_id"].take(i), theirs["b_id"].take(j), shared, rest], names=["a_id", "b_id", "shared", "rest"])

    return _in_tiles(_covered(left.select("a_id", "ring"), size), _covered(right.select("b_id", "ring"), size), block_rows).applyInArrow(search, schema)


def outer_parts(polygons: DataFrame, keys: list[str], order: str, size: float) -> DataFrame:
    """keys, order, tx, ty, area and pieces: each polygon (ring) without those of the same keys that come before it in falling order.

    Polygons of one order are one. So winds leave each place to the strongest: the rings of a storm's weaker winds keep
    what stronger ones leave. Square tiles of the given size cut all polygons, and a task works on one tile of one set of
    keys, so areas are to be added up over the tiles.
    """
    kinds = ", ".join(f"`{k}` {polygons.schema[k].dataType.simpleString()}" for k in [*keys, order])
    tiled = _tiled(polygons.select(*keys, order, "ring"), "b", size).select(*keys, order, "tx", "ty", "ring")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        x, y = group["tx"].iloc[0] * size, group["ty"].iloc[0] * size
        tile = [np.array([(x, y), (x + size, y), (x + size, y + size), (x, y + size)], float)]
        held: list[np.ndarray] = []
        first, made = [], []
        for _, own in group.sort_values(order, ascending=False, kind="stable").groupby(order, sort=False):
            whole: list[np.ndarray] = []
            for ring in own["ring"]:
                whole = pieces(whole, pieces([_array(ring)], tile, "intersection"), "union")
            made.append(pieces(whole, held, "difference"))
            first.append(own.iloc[0])
            held = pieces(whole, held, "union")
        return pd.DataFrame(first)[[*keys, order, "tx", "ty"]].assign(area=[area(m) for m in made], pieces=[_rows(m) for m in made])

    return tiled.groupBy(*keys, "tx", "ty").applyInPandas(run, f"{kinds}, tx long, ty long, area double, pieces array<{RING}>").where("area > 0")
