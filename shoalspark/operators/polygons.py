"""Polygon tables: an id and ring, an array of structs (x, y) whose last point joins the first. Rings are simple polygons.

Joins go through square tiles: polygons are put on the tiles that their boxes cover, points on theirs, and the exact test
follows the equi-join. The tile size should be about that of a common polygon.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import kernels as K
from .lineage import cut


def ring_of(points: list[tuple[Column | float, Column | float]]) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.array(*[F.struct(as_col(x).cast("double").alias("x"), as_col(y).cast("double").alias("y")) for x, y in points])


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return ring_of([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


def edges(ring: Column) -> Column:
    """Array of structs (a, b), the ends of each side."""
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def area(ring: Column) -> Column:
    """Area by the shoelace rule, whatever the direction."""
    return F.abs(F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2


def holds(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point lies within, by crossings; points on a side may be either."""
    crossed = lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / F.nullif(e["b"]["y"] - e["a"]["y"], F.lit(0.0)) + e["a"]["x"])
    return F.aggregate(edges(ring), F.lit(False), lambda s, e: s != F.coalesce(crossed(e), F.lit(False)))


def _side(a: Column, b: Column, p: Column) -> Column:
    return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])


def _meet(s: Column, t: Column) -> Column:
    """Whether two sides share a point."""
    apart = lambda k: (F.greatest(s["a"][k], s["b"][k]) < F.least(t["a"][k], t["b"][k])) | (F.greatest(t["a"][k], t["b"][k]) < F.least(s["a"][k], s["b"][k]))
    return ~apart("x") & ~apart("y") & (_side(t["a"], t["b"], s["a"]) * _side(t["a"], t["b"], s["b"]) <= 0) & (_side(s["a"], s["b"], t["a"]) * _side(s["a"], s["b"], t["b"]) <= 0)


def touch(one: Column, other: Column) -> Column:
    """Whether two polygons share a point: sides that meet, or one within the other."""
    sides = F.exists(edges(one), lambda s: F.exists(edges(other), lambda t: _meet(s, t)))
    first = lambda r: F.get(r, F.lit(0))
    return sides | holds(other, first(one)["x"], first(one)["y"]) | holds(one, first(other)["x"], first(other)["y"])


def _boxed(polygons: DataFrame, prefix: str) -> DataFrame:
    end = lambda f, k: f(F.transform("ring", lambda p: p[k]))
    return polygons.select(
        "*", end(F.array_min, "x").alias(prefix + "x0"), end(F.array_min, "y").alias(prefix + "y0"), end(F.array_max, "x").alias(prefix + "x1"), end(F.array_max, "y").alias(prefix + "y1")
    )


def _tile(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("long")


def _tiled(polygons: DataFrame, prefix: str, size: float) -> DataFrame:
    """polygons with box columns and a row for each tile (tx, ty) of their box."""
    span = lambda k: F.explode(F.sequence(_tile(F.col(f"{prefix}{k}0"), size), _tile(F.col(f"{prefix}{k}1"), size)))
    return _boxed(polygons.where(F.size("ring") > 0), prefix).withColumn("tx", span("x")).withColumn("ty", span("y"))


def _dealt(rows: DataFrame, large: DataFrame, own: str, other: str, count: str, others: str) -> DataFrame:
    """rows of tiles (_tx, _ty) with the number of their block and, once for each, those of the blocks of the other side."""
    some = rows.join(large, ["_tx", "_ty"], "left").withColumns({count: F.coalesce(count, F.lit(1)), others: F.coalesce(others, F.lit(1))})
    known = F.xxhash64(*[c for c in rows.columns if "map<" not in rows.schema[c].dataType.simpleString()])
    return some.withColumn(own, F.pmod(known, F.col(count)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop(count, others)


def _in_tiles(left: DataFrame, right: DataFrame, block_rows: int):
    """Both sides' rows of a tile (_tx, _ty) as cogroups. A tile above block_rows is dealt to blocks, whose pairs are groups of their own."""
    each = left.select("_tx", "_ty", F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(right.select("_tx", "_ty", F.lit(0), F.lit(1)))
    blocks = lambda c: F.greatest(F.ceil(F.sum(c) / block_rows), F.lit(1)).cast("int")
    large = each.groupBy("_tx", "_ty").agg(blocks("l").alias("_m"), blocks("r").alias("_n")).where("_m > 1 or _n > 1")
    keys = ["_tx", "_ty", "_i", "_j"]
    return _dealt(left, large, "_i", "_j", "_m", "_n").groupBy(*keys).cogroup(_dealt(right, large, "_j", "_i", "_n", "_m").groupBy(*keys))


def _streamed(left: DataFrame, right: DataFrame, columns: list[str], search: Callable[[pa.Table, pa.Table], Iterator[pa.Table]], schema: StructType, block_rows: int, held: int = 1 << 18, chunk: int = 1 << 17) -> DataFrame:
    """search(some rows of left, those of right) over every tile (_tx, _ty), where a task holds right's rows of a tile and a chunk of left's at a time.

    A tile is dealt to more tasks by left's rows, block_rows to each, as far as the copies of right's rows that this takes
    are no more than half of left's rows: what is shuffled is in proportion to the tables, however crowded a tile is. Only
    above held rows of right are left's rows copied too, as a task can't hold more. What search finds is given on in
    parts. columns are left's own.
    """
    each = left.select("_tx", "_ty", F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(right.select("_tx", "_ty", F.lit(0), F.lit(1)))
    tiles = each.groupBy("_tx", "_ty").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    most = F.when(F.col("r") > 0, 1 + F.floor(F.col("l") / (2 * F.col("r")))).otherwise(1)
    blocks = lambda c: F.greatest(F.ceil(c), F.lit(1)).cast("int")
    large = cut(tiles.select("_tx", "_ty", blocks(F.least(F.ceil(F.col("l") / block_rows), most)).alias("_m"), blocks(F.col("r") / held).alias("_n")).where("_m > 1 or _n > 1"))
    large = F.broadcast(large) if large.count() <= 100_000 else large  # else both tables are shuffled once more
    keys, theirs = ["_tx", "_ty", "_i", "_j"], [c for c in right.columns if c not in ("_tx", "_ty")]
    one = _dealt(left, large, "_i", "_j", "_m", "_n").select(*keys, F.lit(True).alias("_left"), F.struct(*columns).alias("_a"), F.lit(None).alias("_b"))
    two = _dealt(right, large, "_j", "_i", "_n", "_m").select(*keys, F.lit(False).alias("_left"), F.lit(None).alias("_a"), F.struct(*theirs).alias("_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, ours, known = None, [], []

        def found() -> Iterator[pa.RecordBatch]:
            if ours and known:
                for made in search(pa.Table.from_batches(ours).combine_chunks(), pa.Table.from_batches(known).combine_chunks()):
                    yield from made.combine_chunks().to_batches(max_chunksize=chunk)
            ours.clear()

        for batch in batches:
            at = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (*keys, "_left")])
            ends = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(0)) + 1
            for start, stop in zip([0, *ends], [*ends, batch.num_rows], strict=True):
                if start == stop:
                    continue
                here = tuple(at[:4, start].tolist())
                if here != tile:
                    yield from found()
                    known.clear()
                    tile = here
                mine = bool(at[4, start])
                (ours if mine else known).append(pa.RecordBatch.from_struct_array(batch.column("_a" if mine else "_b").slice(start, stop - start)))
                if mine and sum(b.num_rows for b in ours) >= chunk:
                    yield from found()
        yield from found()

    return one.unionByName(two).repartition(*keys).sortWithinPartitions(*keys, "_left").mapInArrow(run, schema)


def _placed(points: DataFrame, size: float) -> DataFrame:
    return points.where("x is not null and y is not null").withColumns({"_tx": _tile(F.col("x"), size), "_ty": _tile(F.col("y"), size)})


def _covered(polygons: DataFrame, size: float) -> DataFrame:
    return _tiled(polygons, "_b", size).withColumnsRenamed({"tx": "_tx", "ty": "_ty"}).drop("_bx0", "_by0", "_bx1", "_by1")


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table[n].to_numpy().astype(float) for n in names]


def within(points: DataFrame, polygons: DataFrame, size: float, block_rows: int = 4096) -> DataFrame:
    """Points (x, y and any columns) with each polygon (poly_id) that holds them; null places are within none."""
    columns = points.columns
    schema = StructType([*points.schema.fields, polygons.schema["poly_id"]])

    def search(some: pa.Table, rings: pa.Table) -> Iterator[pa.Table]:
        for i, j in K.held(*_numbers(some, "x", "y"), K.Rings(rings["ring"])):
            yield some.take(i).append_column("poly_id", rings["poly_id"].take(j))

    return _streamed(_placed(points, size), _covered(polygons.select("poly_id", "ring"), size), columns, search, schema, block_rows)


def clip(points: DataFrame, polygons: DataFrame, size: float, block_rows: int = 4096) -> DataFrame:
    """The points that some polygon holds, each once."""
    places = points.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).distinct()

    def search(some: pa.Table, rings: pa.Table) -> pa.Table:
        hit = np.zeros(len(some), bool)
        for i, _ in K.held(*_numbers(some, "x", "y"), K.Rings(rings["ring"])):
            hit[i] = True
        return some.select(["x", "y"]).filter(pa.array(hit)).rename_columns(["_hx", "_hy"])

    held = _in_tiles(_placed(places, size), _covered(polygons.select("ring"), size), block_rows).applyInArrow(search, "_hx double, _hy double")
    return points.join(held, (F.col("x").cast("double") == F.col("_hx")) & (F.col("y").cast("double") == F.col("_hy")), "left_semi")


def intersecting(left: DataFrame, right: DataFrame, size: float, block_rows: int = 4096) -> DataFrame:
    """a_id, b_id of the polygons of left (a_id, ring) and right (b_id, ring) that share a point, each pair once.

    A pair that shares several tiles counts in the one that holds the lower left corner of the boxes' overlap.
    """
    return _meeting(left.select("a_id", "ring"), right, size, ["a_id"], block_rows)


def _meeting(left: DataFrame, right: DataFrame, size: float, columns: list[str], block_rows: int = 4096, some: bool = False) -> DataFrame:
    """columns of left and b_id for each pair that shares a point; with some, columns alone, once or more for each that has a pair."""
    schema = StructType([*[left.schema[c] for c in columns], *([] if some else [right.schema["b_id"]])])

    def search(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        corner = tuple(float(ours[c][0].as_py()) for c in ("_tx", "_ty")) if len(ours) else (0.0, 0.0)
        found = ((i, j) for i, j in K.meeting(K.Rings(ours["ring"]), K.Rings(theirs["ring"]), corner, size) if len(i))
        if some:
            hit = np.zeros(len(ours), bool)
            for i, _ in found:
                hit[i] = True
            return ours.select(columns).filter(pa.array(hit))
        pairs = list(found)
        i, j = (np.concatenate(f) for f in zip(*pairs, strict=True)) if pairs else (np.empty(0, int), np.empty(0, int))
        return ours.select(columns).take(i).append_column("b_id", theirs["b_id"].take(j))

    return _in_tiles(_covered(left, size), _covered(right.select("b_id", "ring"), size), block_rows).applyInArrow(search, schema)


def intersect_join(left: DataFrame, right: DataFrame, size: float, how: str = "inner") -> DataFrame:
    """The rows of left with the b_id of each polygon of right that they touch: inner, left (null without any) or left_semi.

    a_id is unique. Rows travel with their pairs, so that pairs need no join of their own.
    """
    columns = ["a_id", *[c for c in left.columns if c != "a_id"]]
    pairs = lambda: _meeting(left.where("a_id is not null"), right, size, columns)
    if how == "inner":
        return pairs()
    met = _meeting(left.where("a_id is not null").select("a_id", "ring"), right, size, ["a_id"], some=True).distinct()
    if how == "left_semi":
        return left.join(met, "a_id", "left_semi").select(*columns)
    alone = left.join(met, "a_id", "left_anti").select(*columns, F.lit(None).cast(right.schema["b_id"].dataType).alias("b_id"))
    return pairs().unionByName(alone)


def burn(polygons: DataFrame, size: float, rule: str = "replace", all_touched: bool = False, tile: int = 256) -> DataFrame:
    """row, col, z: cells of the given size whose centre a polygon (poly_id, ring, value) holds, or that it touches.

    Where polygons overlap their values add up (add), or that of the largest poly_id counts (replace). Cells are made
    from the boxes of the polygons, so a polygon costs as many rows as its box has cells; a task makes them a square of tile
    by tile cells at a time, and the squares of a large polygon are dealt to many tasks.
    """
    boxed = _boxed(polygons.where(F.size("ring") > 0), "b")
    end = lambda k, i: F.floor(F.col(f"b{k}{i}") / size).cast("int")
    square = lambda k: F.explode(F.sequence(F.floor(end(k, 0) / tile).cast("int"), F.floor(end(k, 1) / tile).cast("int")))
    dealt = boxed.withColumn("ty", square("y")).withColumn("tx", square("x")).repartition("poly_id", "ty", "tx")
    cell = lambda k: F.explode(F.sequence(F.greatest(end(k, 0), F.col(f"t{k}") * tile), F.least(end(k, 1), F.col(f"t{k}") * tile + tile - 1)))
    cells = dealt.withColumn("row", cell("y")).withColumn("col", cell("x")).select("poly_id", "ring", "value", "row", "col")
    x, y = F.col("col") * size, F.col("row") * size
    hit = touch(F.col("ring"), rectangle(x, y, x + size, y + size)) if all_touched else holds(F.col("ring"), x + size / 2, y + size / 2)
    z = F.sum("value") if rule == "add" else F.max_by("value", "poly_id")
    return cells.where(hit).groupBy("row", "col").agg(z.alias("z"))


QUADRANTS = {"ne": 0.0, "nw": math.pi / 2, "se": -math.pi / 2, "sw": -math.pi}


def quarter_circle(x: Column, y: Column, radius: Column, quadrant: str, points: int = 10) -> Column:
    """Ring of the quarter of a circle that looks to a quadrant: points along the arc, then the centre."""
    start = QUADRANTS[quadrant]
    angles = [start + math.pi / 2 * k / (points - 1) for k in range(points)]
    return ring_of([*[(x + radius * math.cos(a), y + radius * math.sin(a)) for a in angles], (x, y)])


def _hull(points: np.ndarray) -> np.ndarray:
    """Convex hull, counter-clockwise from the leftmost point."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points

    def chain(rows: np.ndarray) -> list:
        out: list = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(chain(points) + chain(points[::-1]))


def hulls(polygons: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of polygons (rings, an array of rings, and keys) with ring, the convex hull of all their points."""
    kinds = ", ".join(f"`{k}` {polygons.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [[{"x": float(x), "y": float(y)} for x, y in _hull(np.array([(p["x"], p["y"]) for ring in rings for p in ring], float))] for rings in batch["rings"]]
            yield batch[keys].assign(ring=made)

    return polygons.select(*keys, "rings").mapInPandas(run, f"{kinds}, ring array<struct<x:double,y:double>>")


def apart(one: Column, other: Column) -> Column:
    """Whether two convex rings, counter-clockwise, have no inner point in common: a side of one has all of the other beyond it.

    What reaches across a side by less than a billionth of its length only touches.
    """
    square = lambda e: (e["b"]["x"] - e["a"]["x"]) * (e["b"]["x"] - e["a"]["x"]) + (e["b"]["y"] - e["a"]["y"]) * (e["b"]["y"] - e["a"]["y"])
    beyond = lambda a, b: F.exists(edges(a), lambda e: F.forall(b, lambda p: _side(e["a"], e["b"], p) <= square(e) * 1e-9))
    return beyond(one, other) | beyond(other, one)


def swaths(fixes: DataFrame) -> DataFrame:
    """Where winds reach: storm, quadrant, wind and order, x, y, radius -> storm, quadrant, wind, ring, in any number of rows.

    Each fix with a radius gives its quarter circle. Where the quarters of consecutive fixes of a storm, quadrant and wind
    overlap, they are the swath as they are; where they do not, the convex hull of both is added. A place is reached if some
    ring of the storm, quadrant and wind holds it.
    """
    from pyspark.sql.window import Window

    rows = fixes.where("radius > 0")
    ring = F.coalesce(*[F.when(F.col("quadrant") == q, quarter_circle(F.col("x"), F.col("y"), F.col("radius"), q)) for q in QUADRANTS])
    keys = ["storm", "quadrant", "wind"]
    both = rows.withColumn("ring", ring).withColumn("next", F.lead("ring").over(Window.partitionBy(*keys).orderBy("order")))
    joined = both.where(F.col("next").isNotNull() & apart(F.col("ring"), F.col("next"))).select(*keys, F.array("ring", "next").alias("rings"))
    return both.select(*keys, "ring").unionByName(hulls(joined, keys))


def strongest(points: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """For each point and storm the strongest wind of the polygons (poly_id, ring, storm, wind) that hold it.

    Taking stronger polygons away from weaker ones, one after the other, leaves each place with just that wind.
    """
    schema = StructType([points.schema["id"], polygons.schema["storm"], polygons.schema["wind"]])

    def search(some: pa.Table, rings: pa.Table) -> pa.Table:
        storms = rings["storm"].combine_chunks().dictionary_encode("encode")
        values = pc.unique(rings["wind"].drop_null()).sort()
        storm, wind = storms.indices.to_numpy(zero_copy_only=False), pc.index_in(rings["wind"], values).fill_null(-1).to_numpy() + 1
        best = np.full((len(some), len(storms.dictionary)), -1, np.int32)
        for i, j in K.held(*_numbers(some, "x", "y"), K.Rings(rings["ring"])):
            np.maximum.at(best, (i, storm[j]), wind[j].astype(np.int32))
        i, k = np.nonzero(best >= 0)
        named = pa.concat_arrays([pa.nulls(1, values.type), values])
        return pa.table([some["id"].take(i), storms.dictionary.take(k), named.take(best[i, k])], names=["id", "storm", "wind"])

    rows = _in_tiles(_placed(points.select("id", "x", "y"), size), _covered(polygons.select("ring", "storm", "wind"), size), 4096).applyInArrow(search, schema)
    return rows.groupBy("id", "storm").agg(F.max("wind").alias("wind"))


def quartered(tiles: DataFrame) -> DataFrame:
    """Four tiles for each (tile, x0, y0, x1, y1), numbered 1 to 4 from the lower left, row by row."""
    mx, my = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    part = lambda k, *b: F.struct(F.concat_ws("_", "tile", F.lit(str(k))).alias("tile"), *[c.alias(n) for c, n in zip(b, ("x0", "y0", "x1", "y1"), strict=True)])
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    four = F.array(part(1, x0, y0, mx, my), part(2, mx, y0, x1, my), part(3, x0, my, mx, y1), part(4, mx, my, x1, y1))
    return tiles.select(F.explode(four).alias("t")).select("t.*")


def tile_scheme(session, x0: float, y0: float, size: float, columns: int, rows: int) -> DataFrame:
    """tile, number and box of a scheme of equal tiles, numbered from the lower left, row by row."""
    n = session.range(columns * rows)
    i, j = F.col("id") % columns, F.floor(F.col("id") / columns)
    return n.select(
        F.concat(F.lit("T"), F.lpad(j.cast("string"), 4, "0"), F.lpad(i.cast("string"), 4, "0")).alias("tile"), (F.col("id") + 1).alias("number"),
        (i * size + x0).alias("x0"), (j * size + y0).alias("y0"), ((i + 1) * size + x0).alias("x1"), ((j + 1) * size + y0).alias("y1"),
    )
