"""Samples that come out alike in every run, and every n-th row of an order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut


def seeded_sample(rows: DataFrame, key: list[str], share: float, seed: int = 42) -> DataFrame:
    """The rows whose key falls into the share, by a checksum of seed and key: equal keys stay or go together, in any partitioning."""
    text = F.concat_ws("\u0001", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in key])
    return rows.where(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") < int(share * (1 << 32)))


def every_nth(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first row of the order and each n-th after it. Ranges of the order are counted, so no task holds all rows.

    The order should tell rows apart; of equal ones any may come first.
    """
    ordered = rows.sort(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = cut(ordered.withColumn("_part", F.shiftrightunsigned("_at", 33)).withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))))
    start, offsets = 0, []
    for r in sorted(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("rows")).collect()):
        offsets.append((r["_part"], start))
        start += r["rows"]
    before = rows.sparkSession.createDataFrame(offsets, "_of long, _start long")
    at = placed.join(F.broadcast(before), F.col("_part") == F.col("_of"))
    return at.where((F.col("_start") + F.col("_row")) % n == 0).select(*rows.columns)
