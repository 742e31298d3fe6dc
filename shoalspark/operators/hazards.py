"""Hazards of charts: classes by how sure their position is, and their summary on a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import texts as X

#: Object group of a chart -> what it is.
KINDS = {"OBSTRN": "Obstruction", "WRECKS": "Wreck", "PILPNT": "Pile", "UWTROC": "Underwater / awash rock"}
KNOWN, REPORTED = "01_known_hazard", "02_unverified_reported_error"
COUNTED = {"obstruction_count": "OBSTRN", "wreck_count": "WRECKS", "pile_count": "PILPNT", "rock_count": "UWTROC"}


def with_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """rows with each of the names as text, null where it was not there."""
    return rows.withColumns({n: F.col(n).cast("string") if n in rows.columns else F.lit(None).cast("string") for n in names})


def classified(hazards: DataFrame) -> DataFrame:
    """hazards with type, position code, label and note, methodology group and the three weights.

    The code is QUAPOS, or that of the primitive where it is null. Positions coded 2 to 9, and those that STATUS or INFORM
    doubt, are reported (weight 3); those coded 1, 10 or 11 and those without code are known (1); all else is other (0),
    as are object groups that are no hazards.
    """
    rows = with_columns(hazards, ["object_group", "QUAPOS", "QUAPOS_primitive", "STATUS", "INFORM"])
    group, code = F.col("object_group"), X.position_code(F.coalesce("QUAPOS", "QUAPOS_primitive"))
    doubt = F.concat_ws(" ", F.coalesce(F.lower("STATUS"), F.lit("")), F.coalesce(F.lower("INFORM"), F.lit("")))
    weight = F.when(F.coalesce(group.isin(*KINDS), F.lit(False)), X.quality_weight(code, doubt)).otherwise(0)
    kind = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in KINDS.items() for v in kv]), group), F.lit("Other"))
    note = F.when(F.col("QUAPOS").isNotNull(), "Read directly from S-57 feature object").when(F.col("QUAPOS_primitive").isNotNull(), "Transferred from nearest S-57 primitive/vector record").otherwise("No QUAPOS available")
    return rows.withColumns({
        "hazard_type": kind, "quapos_code": code, "quapos_label": X.position_label(code), "quapos_note": note,
        "methodology_group": F.when(weight == 3, REPORTED).when(weight == 1, KNOWN).otherwise("other"),
        "hazard_weight": weight.cast("double"), "known_weight": F.when(weight == 1, 1.0).otherwise(0.0), "reported_weight": F.when(weight == 3, 3.0).otherwise(0.0),
    })


def grid_summary(grid: DataFrame, hazards: DataFrame) -> DataFrame:
    """A row for each grid_id: counts of its hazards and the highest scores; grid cells without any have zeros.

    hazards has a row for each grid cell that a hazard touches, with grid_id, hazard_id, object_group, methodology_group
    and score columns. Highest, not summed, as a hazard's score already takes in its neighbourhood.
    """
    most = lambda c: F.coalesce(F.max(c), F.lit(0.0)).alias(c)
    joined = grid.select("grid_id").join(hazards, "grid_id", "left")
    return joined.groupBy("grid_id").agg(
        F.count("hazard_id").alias("total_hazard_count"), F.count_if(F.col("methodology_group") == KNOWN).alias("known_hazard_count"), F.count_if(F.col("methodology_group") == REPORTED).alias("reported_error_count"),
        *[F.count_if(F.col("object_group") == g).alias(n) for n, g in COUNTED.items()], most("hazard_score"), most("known_score"), most("reported_score"),
    )


def burned(summary: DataFrame, cells: DataFrame, value: str) -> DataFrame:
    """row, col, z of the mask cells (row, col, grid_id, mask) within the mask (1) whose grid cell has a value above 0."""
    inside = cells.where("mask = 1")
    return inside.join(summary.select("grid_id", F.col(value).alias("z")), "grid_id").where("z > 0").select("row", "col", "z")


def debris_class(known: Column, reported: Column) -> Column:
    """Class of human debris: known and three times reported ones, 0, 1, to 5, to 9 and more."""
    n = known + 3 * reported
    return F.when(n > 9, 5).when(n > 5, 4).when(n > 1, 3).when(n > 0, 2).when(n.isNotNull(), 1)
