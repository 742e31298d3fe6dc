"""Features as well-known binary in Parquet, with bounds by which files are left out.

A feature is a kind (point, line or polygon) and parts, arrays of struct(x, y): one part with one point, one part, or an
outer ring and its holes, each without the closing point.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: the number of each kind.
KINDS = {"point": 1, "line": 2, "polygon": 3}
PARTS = "array<array<struct<x:double,y:double>>>"


def encode(kind: str, parts: list[np.ndarray]) -> bytes:
    """Little-endian well-known binary; a polygon's rings are closed in it. An empty point has no numbers."""
    head = struct.pack("<BI", 1, KINDS[kind])
    flat = lambda p: np.ascontiguousarray(p, "<f8").tobytes()
    if kind == "point":
        return head + flat(parts[0] if parts and len(parts[0]) else np.full((1, 2), np.nan))
    if kind == "line":
        return head + struct.pack("<I", len(parts[0]) if parts else 0) + (flat(parts[0]) if parts else b"")
    rings = [np.vstack([p, p[:1]]) for p in parts]
    return head + struct.pack("<I", len(rings)) + b"".join(struct.pack("<I", len(r)) + flat(r) for r in rings)


def decode(data: bytes) -> tuple[str, list[np.ndarray]]:
    """kind and parts of either byte order."""
    order = "<" if data[0] == 1 else ">"
    kind = {n: k for k, n in KINDS.items()}[struct.unpack_from(order + "I", data, 1)[0]]
    points = lambda at, n: np.frombuffer(data, order + "f8", 2 * n, at).reshape(-1, 2).astype(float)
    if kind == "point":
        p = points(5, 1)
        return kind, [] if np.isnan(p).all() else [p]
    if kind == "line":
        return kind, [points(9, struct.unpack_from(order + "I", data, 5)[0])]
    at, parts = 9, []
    for _ in range(struct.unpack_from(order + "I", data, 5)[0]):
        n = struct.unpack_from(order + "I", data, at)[0]
        ring = points(at + 4, n)
        parts.append(ring[:-1] if n > 1 and (ring[0] == ring[-1]).all() else ring)
        at += 4 + 16 * n
    return kind, parts


def _plain(parts) -> list[np.ndarray]:
    return [np.array([(p["x"], p["y"]) for p in part], float).reshape(-1, 2) for part in parts]


def to_wkb(kind: Column, parts: Column) -> Column:
    """The well-known binary of a feature, null if its kind or parts are."""

    @F.pandas_udf("binary")
    def made(kind: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([None if k is None or p is None else encode(k, _plain(p)) for k, p in zip(kind, parts, strict=True)], dtype=object)

    return made(kind, parts)


def from_wkb(data: Column) -> Column:
    """struct(kind, parts) of well-known binary; the struct's fields are null where there is none."""

    @F.pandas_udf(f"kind string, parts {PARTS}")
    def made(data: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if d is None else decode(bytes(d)) for d in data]
        return pd.DataFrame({"kind": [k for k, _ in rows], "parts": [None if p is None else [[{"x": x, "y": y} for x, y in part] for part in p] for _, p in rows]})

    return made(data)


def _span(parts: Column, k: str) -> tuple[Column, Column]:
    every = F.transform(F.flatten(parts), lambda p: p[k])
    return F.array_min(every), F.array_max(every)


def _between(cells: int = 16) -> Column:
    """Place along a curve that keeps near boxes together: bits of the middle's x and y in turn."""
    at = lambda k: F.least(F.greatest(F.floor((F.col(f"{k}_mid") - F.col(f"{k}_lo")) / F.nullif(F.col(f"{k}_hi") - F.col(f"{k}_lo"), F.lit(0.0)) * (1 << cells)), F.lit(0)), F.lit((1 << cells) - 1))
    x, y = (F.coalesce(at(k), F.lit(0)).cast("long") for k in "xy")
    made = F.lit(0).cast("long")
    for b in range(cells):
        for v, up in ((x, 0), (y, 1)):
            made = made.bitwiseOR(F.shiftleft(F.shiftright(v, b).bitwiseAND(F.lit(1)), 2 * b + up))
    return made


def write_features(features: DataFrame, folder: str, files: int) -> None:
    """Writes features (kind, parts and any columns) to folder/data, near ones in one file, and each file's bounds to folder/bounds.

    The geometry becomes well-known binary, its box the columns xmin, ymin, xmax and ymax; features without a finite box
    keep null bounds and are found by readers without a box alone.
    """
    (x0, x1), (y0, y1) = _span(F.col("parts"), "x"), _span(F.col("parts"), "y")
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)
    rows = features.select("*", *[finite(c).alias(n) for c, n in ((x0, "xmin"), (y0, "ymin"), (x1, "xmax"), (y1, "ymax"))])
    box = rows.agg(F.min("xmin").alias("x_lo"), F.max("xmax").alias("x_hi"), F.min("ymin").alias("y_lo"), F.max("ymax").alias("y_hi"))
    placed = rows.join(F.broadcast(box)).withColumn("x_mid", (F.col("xmin") + F.col("xmax")) / 2).withColumn("y_mid", (F.col("ymin") + F.col("ymax")) / 2).withColumn("curve", _between())
    keep = [c for c in features.columns if c not in ("kind", "parts")]
    placed.repartitionByRange(files, "curve").sortWithinPartitions("curve").select(*keep, to_wkb(F.col("kind"), F.col("parts")).alias("geometry"), "xmin", "ymin", "xmax", "ymax").write.mode("overwrite").parquet(f"{folder}/data")
    data = features.sparkSession.read.parquet(f"{folder}/data").withColumn("file", F.input_file_name())
    data.groupBy("file").agg(*[f(c).alias(c) for f, c in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))], F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{folder}/bounds")


def files_within(spark: SparkSession, folder: str, box: tuple[float, float, float, float] | None = None) -> list[str]:
    """The files of a folder of features whose bounds share a point with the box (x0, y0, x1, y1); all without one."""
    bounds = spark.read.parquet(f"{folder}/bounds")
    if box is not None:
        bounds = bounds.where((F.col("xmin") <= box[2]) & (F.col("xmax") >= box[0]) & (F.col("ymin") <= box[3]) & (F.col("ymax") >= box[1]))
    return [r["file"] for r in bounds.select("file").orderBy("file").collect()]


def read_features(spark: SparkSession, folder: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """The features of a folder, or those whose boxes share a point with the given one; only files that may hold some are read."""
    files = files_within(spark, folder, box)
    rows = spark.read.parquet(*files) if files else spark.read.parquet(f"{folder}/data").limit(0)
    if box is not None:
        rows = rows.where((F.col("xmin") <= box[2]) & (F.col("xmax") >= box[0]) & (F.col("ymin") <= box[3]) & (F.col("ymax") >= box[1]))
    return rows.withColumn("_g", from_wkb(F.col("geometry"))).select(*[c for c in rows.columns if c not in ("geometry", "xmin", "ymin", "xmax", "ymax")], "_g.kind", "_g.parts")


def inner_point(parts: Column) -> Column:
    """A point within a polygon of rings, holes or not: the middle of the longest run inside, along a line across it.

    The line lies between two heights of corners, so it meets no corner; null for a polygon without height.
    """
    from ..operators.polygons import edges

    # Each step's result is bound once: a lambda that names an expression would work it out anew for every side.
    bound = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))

    def at(sides: Column, y: Column) -> Column:
        crossed = F.filter(sides, lambda e: (e["a"]["y"] > y) != (e["b"]["y"] > y))
        places = F.array_sort(F.transform(crossed, lambda e: e["a"]["x"] + (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"])))
        runs = lambda xs: F.transform(F.filter(xs, lambda _, i: i % 2 == 0), lambda x, i: F.struct((F.get(xs, 2 * i + 1) - x).alias("length"), ((F.get(xs, 2 * i + 1) + x) / 2).alias("x")))
        return F.struct(bound(places, lambda xs: F.array_max(runs(xs)))["x"].alias("x"), y.alias("y"))

    def across(heights: Column) -> Column:
        half = F.floor(F.size(heights) / 2).cast("int")
        y = (F.get(heights, half - 1) + F.get(heights, half)) / 2
        both = F.struct(y.alias("y"), F.flatten(F.transform(parts, edges)).alias("sides"))
        return F.when(F.size(heights) > 1, bound(both, lambda b: at(b["sides"], b["y"])))

    return bound(F.array_sort(F.array_distinct(F.transform(F.flatten(parts), lambda p: p["y"]))), across)
