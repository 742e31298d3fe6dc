"""Tables of the change model: cell layers to wide tables, column names, year pairs and the long form."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import texts as X

#: Layers of the later year, in the order that their names are looked for, and their column in the long form.
LATER = (
    "bpi_broad", "bpi_fine", "curv_plan", "curv_profile", "curv_total", "flowacc", "flowdir", "gradmag", "rugosity", "shearproxy", "slope_deg", "slope", "tci", "terrain_classification",
)
#: Columns of the long form in their order; those of the pair are put before the sediment.
BEFORE = (
    "X", "Y", "FID", "tile_id", "year_ti", "year_t", "bathy_ti", "bathy_t", "bpi_broad_t", "bpi_fine_t", "curv_plan_t", "curv_profile_t", "curv_total_t", "flowacc_t",
    "flowdir_cos_t", "flowdir_sin_t", "gradmag_t", "rugosity_t", "shearproxy_t", "slope_t", "slope_deg_t", "tci_t", "terrain_classification_t", "delta_bathy",
)
AFTER = ("grain_size_layer", "prim_sed_layer", "survey_end_date")


def wide(cells: DataFrame, variables: list[str]) -> DataFrame:
    """x, y and a column for each variable from cells (x, y, variable, value); places with no value at all are left out.

    Places count as one when they agree to three decimals; of repeated values the largest stays.
    """
    rows = cells.where(F.col("value").isNotNull()).select(F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), "variable", "value")
    return rows.groupBy("x", "y").pivot("variable", variables).agg(F.max("value")).where(F.coalesce(*[F.col(f"`{v}`") for v in variables]).isNotNull())


def sampled(points: DataFrame, coarse: DataFrame, x0: float, y0: float, size: float, name: str) -> DataFrame:
    """points (x, y) with column name: what they had, else the value of the coarse cell (row, col, value) that they lie in; rows run down from y0."""
    at = coarse.select(F.col("row").alias("r"), F.col("col").alias("c"), F.col("value").alias("found"))
    joined = points.join(at, (F.floor((F.lit(y0) - F.col("y")) / size) == F.col("r")) & (F.floor((F.col("x") - x0) / size) == F.col("c")), "left")
    return joined.withColumn(name, F.coalesce(F.col(name), "found") if name in points.columns else F.col("found")).drop("r", "c", "found")


def standardised(rows: DataFrame, tile: str = "") -> DataFrame:
    """rows with standard column names; of columns that come to have one name the first stays."""
    names = rows.sparkSession.createDataFrame([(i, c) for i, c in enumerate(rows.columns)], "i int, c string")
    made = [r["c"] for r in names.select("i", X.standard_name(F.col("c"), tile).alias("c")).orderBy("i").collect()]
    first = {new: old for old, new in reversed(list(zip(rows.columns, made, strict=True)))}
    return rows.select(*[F.col(f"`{old}`").alias(new) for new, old in first.items()])


def column_years(columns: list[str]) -> list[tuple[str, int, str]]:
    """Column, year and variable of the columns that end in a year, filled or not; those of year pairs are left out."""
    found = [(c, re.search(r"_(\d{4})(?:_filled)?$", c)) for c in columns if not re.search(r"\d{4}_\d{4}", c)]
    return [(c, int(m[1]), c[: m.start()]) for c, m in found if m]


def _depth(columns: list[str], year: int) -> str | None:
    return next((c for c in columns if re.fullmatch(rf"bathy_{year}_filled", c, re.IGNORECASE)), None)


def with_deltas(rows: DataFrame, pairs: list[tuple[int, int]]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """rows with the change of depth of each pair whose years both have one, without other pairs' columns; and those pairs."""
    valid = [p for p in pairs if _depth(rows.columns, p[0]) and _depth(rows.columns, p[1])]
    made = rows.withColumns({f"delta_bathy_{a}_{b}": F.col(f"`{_depth(rows.columns, b)}`") - F.col(f"`{_depth(rows.columns, a)}`") for a, b in valid}) if valid else rows
    names = {f"{a}_{b}" for a, b in valid}
    stale = [c for c in made.columns if (m := re.search(r"(\d{4}_\d{4})$", c)) and not c.startswith("delta_bathy_") and m[1] not in names]
    return made.drop(*stale), valid


def long_pairs(rows: DataFrame, pairs: list[tuple[int, int]]) -> dict[tuple[int, int], DataFrame]:
    """For each valid pair of years the long form of a wide table, distinct rows, columns that exist in their fixed order."""
    table, valid = with_deltas(rows, pairs)
    has = lambda *words: next((c for c in table.columns if any(w in c.lower() for w in words)), None)
    out = {}
    for a, b in valid:
        q = lambda c: F.col(f"`{c}`")
        made: dict[str, Column] = {c: q(c) for c in ("X", "Y", "FID", "tile_id") if c in table.columns}
        made |= {"year_t": F.lit(b), "year_ti": F.lit(a), "bathy_ti": q(_depth(table.columns, a)), "bathy_t": q(_depth(table.columns, b)), "delta_bathy": q(f"delta_bathy_{a}_{b}")}
        for c in table.columns:
            if c.endswith(f"_{b}") and not re.search(r"\d{4}_\d{4}$", c) and (kind := next((k for k in LATER if k in c.lower()), None)):
                if kind == "flowdir":
                    made |= {"flowdir_cos_t": F.cos(F.radians(q(c))), "flowdir_sin_t": F.sin(F.radians(q(c)))}
                else:
                    made[f"{kind}_t"] = q(c)
        of_pair = [n for n in (f"hurr_strength_mean_{a}_{b}", f"tsm_mean_{a}_{b}") if n in table.columns]
        made |= {n: q(n) for n in of_pair}
        for name, found in zip(AFTER, (has("grain", "sed_size"), has("prim_sed", "sed_type"), has("survey")), strict=True):
            if found:
                made[name] = q(found)
        out[a, b] = table.select(*[made[c].alias(c) for c in (*BEFORE, *of_pair, *AFTER) if c in made]).distinct()
    return out


def usable_tiles(stats: DataFrame, pair: str, most: float = 95.0) -> DataFrame:
    """Tiles whose table lacks less than most percent of a pair's change of depth (column <pair>_nan_percent)."""
    return stats.where(F.col(f"{pair}_nan_percent") < most)


def known_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns of names that rows has, in the order of names."""
    return rows.select(*[F.col(f"`{c}`") for c in names if c in rows.columns])


def spans(rows: DataFrame, predictors: list[str]) -> DataFrame:
    """predictor, least, largest and range of each; null where it has no value."""
    tall = rows.select(*[F.col(f"`{p}`").cast("double").alias(p) for p in predictors]).unpivot([], predictors, "predictor", "value")
    return tall.groupBy("predictor").agg(F.min("value").alias("least"), F.max("value").alias("largest"), (F.max("value") - F.min("value")).alias("span"))


def hybrid_change(modelled: Column, neighbours: Column) -> Column:
    """The modelled change, and that of the nearest neighbours where there is none."""
    return F.coalesce(modelled, neighbours)
