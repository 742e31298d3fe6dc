"""Which raster files take part in training, prediction and masks, and rasters of regions on one national grid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grid import mosaic

#: Names of layers and folders that the rules look for.
SEDIMENT_MASK = "sand_mud_mask"
FILLED_FOLDERS = ("filled_lidar", "filled_tifs")
COMBINED_FOLDER = "combined_lidar"
BASE_NAME, BASE_START, DATE_LAYER = "bluetopo", "bt.", "survey_end_date"
UNCERTAINTY = "unc"
DERIVED = ("tsm_cumulative", "hurr_count_mean", "hurr_count_cumulative", "hurr_strength_cumulative")
DERIVED_YEARS = r"hurr_(?:count|strength)_\d{4}_\d{4}"
RASTER_ENDS = (".tif", ".tiff")
REGION_NAME = r"ER_[0-9]+"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def in_folder(path: Column, *folders: str) -> Column:
    """Whether a part of the path, in either case, is one of the names."""
    return F.arrays_overlap(F.split(F.lower(path), "/"), F.array(*map(F.lit, folders)))


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def is_raster(path: Column) -> Column:
    return _any([F.lower(path).endswith(e) for e in RASTER_ENDS])


def is_base(path: Column) -> Column:
    """Whether a file belongs to the base survey, but for the layer of its dates."""
    name = F.lower(file_name(path))
    return (name.contains(BASE_NAME) | name.startswith(BASE_START)) & ~name.contains(DATE_LAYER)


def source_file(path: Column, excluded: list[str]) -> Column:
    """Sources of layers: no sediment masks, and none in an excluded folder, whose case counts."""
    inside = F.arrays_overlap(F.split(path, "/"), F.array(*map(F.lit, excluded))) if excluded else F.lit(False)
    return ~file_name(path).contains(SEDIMENT_MASK) & ~inside


def training_file(path: Column) -> Column:
    """Rasters to train on: not filled, mosaics only if combined, and nothing of the base survey but its dates."""
    name = F.lower(file_name(path))
    loose = name.contains("mosaic") & ~name.contains("combined") & ~in_folder(path, COMBINED_FOLDER)
    return is_raster(path) & ~in_folder(path, *FILLED_FOLDERS) & ~loose & ~is_base(path)


def table_file(path: Column, prediction: bool) -> Column:
    """Rasters that become columns of a tile's table: neither uncertainties nor sums and means over years; training leaves
    the base survey out, prediction takes depths from it alone."""
    name = F.lower(file_name(path))
    depth = name.contains("bathy") & ~name.contains(BASE_NAME) & ~name.startswith(BASE_START)
    left_out = _any([name.contains(UNCERTAINTY), *[name.contains(d) for d in DERIVED], name.rlike(DERIVED_YEARS), depth if prediction else is_base(path)])
    return is_raster(path) & ~in_folder(path, *FILLED_FOLDERS) & ~left_out


def mask_catalogue(files: DataFrame, path: str = "path", regions: list[str] | None = None) -> DataFrame:
    """region, path of the mask rasters whose name has a region's id, of the given regions or of all."""
    name = file_name(F.col(path))
    rows = files.where(is_raster(F.col(path)) & name.rlike(REGION_NAME)).select(F.regexp_extract(name, f"({REGION_NAME})", 1).alias("region"), F.col(path).alias("path"))
    return rows if regions is None else rows.where(F.col("region").isin(regions))


def layer_key(name: Column) -> Column:
    """struct(tile, variable, years) of a clipped layer's name, <variable>_<years>_<tile>: years are one or two of four digits,
    the tile the rest after the last underscore; what is not there is null."""
    stem = F.regexp_replace(name, r"\.[A-Za-z]+$", "")
    part = lambda k: F.nullif(F.regexp_extract(stem, r"^(.*?)(?:_(\d{4}(?:_\d{4})?))?(?:_([^_]+))?$", k), F.lit(""))
    return F.struct(part(3).alias("tile"), part(1).alias("variable"), part(2).alias("years"))


def snapped_bounds(grids: DataFrame, width: float) -> DataFrame:
    """x0, y0, x1, y1 round all grids (x0, y0, x1, y1), moved out to whole widths."""
    low, high = (lambda c: F.floor(F.min(c) / width) * width), (lambda c: F.ceil(F.max(c) / width) * width)
    return grids.agg(low("x0").cast("double").alias("x0"), low("y0").cast("double").alias("y0"), high("x1").cast("double").alias("x1"), high("y1").cast("double").alias("y1"))


def onto_grid(cells: DataFrame, grids: DataFrame, width: float) -> DataFrame:
    """layer, row, col, z on the snapped grid of a width: each of its cells takes the value of the source cell that holds its centre.

    cells has layer, row, col and z, rows running down from the top; grids has layer, x0 (left), y1 (top) and size of each
    layer's cells, and is small. Target rows and cols count from 0 at the origin of coordinates, rows upwards. Nulls stay away.
    """
    placed = cells.where("z is not null").join(F.broadcast(grids.select("layer", "x0", "y1", "size")), "layer")
    left, top = F.col("x0") + F.col("col") * F.col("size"), F.col("y1") - F.col("row") * F.col("size")
    # Centres from the left side on and before the right one; below the top and from the lower side on.
    first = lambda v: F.ceil(v / width - 0.5).cast("int")
    span = lambda lo, hi: F.when(first(hi) > first(lo), F.sequence(first(lo), first(hi) - 1)).otherwise(F.array().cast("array<int>"))
    rows = placed.select("layer", "z", F.explode(span(top - F.col("size"), top)).alias("r"), left.alias("left"), "size")
    return rows.select("layer", F.col("r").alias("row"), F.explode(span(F.col("left"), F.col("left") + F.col("size"))).alias("col"), "z")


def national_mosaic(cells: DataFrame, grids: DataFrame, width: float, rule: str = "max") -> DataFrame:
    """row, col, z of all layers on the snapped grid: the largest value, or that of the first layer by name."""
    return mosaic(onto_grid(cells, grids, width), rule)
