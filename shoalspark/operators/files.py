"""Catalogues of layer files: which are meant, and in what order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def only_one(files: DataFrame, pattern: str, name: str = "path") -> str:
    """The one path that the pattern finds, in either case; none and several are errors."""
    found = [r[0] for r in files.where(F.lower(name).rlike(pattern)).select(name).limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"{pattern}: expected one file, found {'none' if not found else 'more'}")
    return found[0]


def shore_class(tile: Column) -> Column:
    """Nearshore for tiles that begin with BH; offshore for others but the coarse ones, BF2H and a digit, which are neither."""
    return F.when(tile.startswith("BH"), "nearshore").when(~tile.rlike("^BF2H[0-9]"), "offshore")


def provider_id(folder: Column, used: Column) -> Column:
    """The id of a provider in use: its folder's name without the first two parts; null for those not in use."""
    return F.when(used, F.concat_ws("_", F.slice(F.split(folder, "_"), 3, 1000)))


def region_order(name: Column) -> Column:
    """Regions go by the number in their name; those without come last."""
    return F.coalesce(F.regexp_extract(name, r"(\d+)", 1).try_cast("int"), F.lit(9999))


def period_start(name: Column) -> Column:
    """The first day of a file's period <YYYYMMDD>-<YYYYMMDD>; names without one come last."""
    day = F.regexp_extract(name, r"(\d{8})-\d{8}", 1)
    return F.when(day != "", day).otherwise("99999999")


def of_provider(files: DataFrame, provider: str, path: str, order: str) -> DataFrame:
    """A row for each provider: its files by name, how many, and the grid of the first, which the mosaic takes."""
    return files.groupBy(provider).agg(F.array_sort(F.collect_set(path)).alias("paths"), F.count(F.lit(1)).alias("n"), F.min_by("crs", order).alias("crs"))


def usable_width(width: Column) -> Column:
    """Widths of vessels; missing ones and those not above 0 count as 1."""
    return F.when(width > 0, width).otherwise(1.0)
