"""Queries over summary grids with hazards, features in files, inner points and repeatable samples."""

import uuid

from pyspark.sql import functions as F

from ..operators import catalogues as C
from ..operators import hazards as H
from ..operators import overlay as O
from ..operators import polygons as Y
from ..operators import samples as A
from ..operators import summarygrid as S
from ..operators.lineage import cut
from ..sources import features as W
from ..sqlpair import Tables, query
from .coast import BOXES, MEET, OTHER, boxes, others, triangles
from .raster import CELLS, cells

_GROUPS = list(H.COUNTED.values())
_MASK = f"SELECT r AS row, c AS col FROM ({CELLS}) WHERE (r * 5 + c * 11 + r // 9) % 23 < 4"
_HAZARDS = f"SELECT s_suppkey AS hazard_id, (s_suppkey * 6007 % 6301) + 0.5 AS x0, (s_suppkey * 3001 % 6299) + 0.5 AS y0, s_suppkey * 37 % 400 AS w, s_suppkey * 53 % 300 AS h, ['{"', '".join(_GROUPS)}'][s_suppkey % 4 + 1] AS kind, s_suppkey % 3 AS sure, (s_suppkey % 17)::DOUBLE AS score FROM supplier"


def _hazards(t: Tables):
    k = F.col("s_suppkey")
    x, y = k * 6007 % 6301 + F.lit(0.5), k * 3001 % 6299 + F.lit(0.5)
    group = F.element_at(F.array(*map(F.lit, _GROUPS)), (k % 4 + 1).cast("int"))
    method = F.when(k % 3 == 0, H.KNOWN).when(k % 3 == 1, H.REPORTED).otherwise("other")
    score = (k % 17).cast("double")
    return t.supplier.select(k.alias("hazard_id"), Y.rectangle(x, y, x + k * 37 % 400, y + k * 53 % 300).alias("ring"), group.alias("object_group"), method.alias("methodology_group"), score.alias("hazard_score"), (score * 2).alias("known_score"), (score * 3).alias("reported_score"))


@query(f"""
WITH m AS ({_MASK}), g AS (SELECT *, row_number() OVER (ORDER BY row, col) AS n FROM (SELECT DISTINCT row // 3 AS row, col // 3 AS col FROM m)), z AS ({_HAZARDS}),
j AS (SELECT g.n, z.* FROM g LEFT JOIN z ON z.x0 <= g.col * 300 + 300 AND z.x0 + z.w >= g.col * 300 AND z.y0 <= g.row * 300 + 300 AND z.y0 + z.h >= g.row * 300)
SELECT 'ER_1_grid_' || n AS grid_id, count(hazard_id) AS total_hazard_count, count(*) FILTER (sure = 0) AS known_hazard_count, count(*) FILTER (sure = 1) AS reported_error_count,
  {", ".join(f"count(*) FILTER (kind = '{g}') AS {n}" for n, g in H.COUNTED.items())}, coalesce(max(score), 0) AS hazard_score, coalesce(max(score) * 2, 0) AS known_score, coalesce(max(score) * 3, 0) AS reported_score
FROM j GROUP BY n
""")
def summary_grid_of_hazards(t: Tables):
    r, c = F.col("row"), F.col("col")
    mask = cells(t).select("row", "col", F.when((r * 5 + c * 11 + F.floor(r / 9)) % 23 < 4, 1).otherwise(0).alias("z"))
    return S.hazards_of_mask(mask, 100.0, _hazards(t), 300.0, "ER_1")


@query("SELECT p_partkey AS poly_id, p_partkey * 6007 % 9973 + 0.5 + (2 * p_size + 51) / 4 AS x, p_partkey * 3001 % 9967 + 0.5 + (4 * p_size + 60) / 2 AS y FROM part")
def inner_points(t: Tables):
    return triangles(t).select("poly_id", W.inner_point(F.array("ring")).alias("p")).select("poly_id", "p.x", "p.y")


@query(f"SELECT a_id AS id, round((x1 - x0) * (y1 - y0), 6) AS area FROM ({BOXES}) WHERE x0 <= 6000 AND x1 >= 3000 AND y0 <= 5000 AND y1 >= 2500")
def features_in_a_box(t: Tables):
    """Footprints written as well-known binary and read back from the files that reach into a box."""
    session = t.spark
    cut(session.range(1))  # names the shared folder where none is set
    folder = f"{session.sparkContext.getCheckpointDir()}/features-{uuid.uuid4().hex}"
    W.write_features(boxes(t).select(F.col("a_id").alias("id"), F.lit("polygon").alias("kind"), F.array("ring").alias("parts")), folder, 8)
    found = W.read_features(session, folder, (3000.0, 2500.0, 6000.0, 5000.0))
    return found.select("id", F.round(Y.area(F.get("parts", F.lit(0))), 6).alias("area"))


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS k FROM orders) WHERE k % 10 = 1")
def every_tenth_order(t: Tables):
    return A.every_nth(t.orders.select("o_orderkey"), ["o_orderkey"], 10)


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE ('0x' || substr(md5('42' || chr(1) || l_orderkey || chr(1) || l_linenumber), 1, 8))::BIGINT < 429496729")
def seeded_sample(t: Tables):
    return A.seeded_sample(t.lineitem, ["l_orderkey", "l_linenumber"], 0.1).select("l_orderkey", "l_linenumber")


_LAP = "(least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0))"


@query(f"WITH a AS ({BOXES}), b AS ({OTHER}) SELECT a_id, b_id, round({_LAP}, 6) AS shared, round((a.x1 - a.x0) * (a.y1 - a.y0) - {_LAP}, 6) AS rest FROM a JOIN b ON {MEET} WHERE {_LAP} > 0 AND (a.x1 - a.x0) * (a.y1 - a.y0) - {_LAP} > 0")
def overlay_areas(t: Tables):
    """Area that footprints share, and that the first keeps without the second."""
    found = O.shared_areas(boxes(t), others(t), 200.0).where("shared > 0 and rest > 0")
    return found.select("a_id", "b_id", F.round("shared", 6).alias("shared"), F.round("rest", 6).alias("rest"))


_WINDS = "SELECT s_nationkey AS storm, s_suppkey % 3 AS wind, (s_suppkey * 61 % 40)::INT AS x, (s_suppkey * 53 % 40)::INT AS y, (s_suppkey * 17 % 12 + 3)::INT AS w, (s_suppkey * 29 % 9 + 2)::INT AS h FROM supplier"


@query(f"""
WITH z AS ({_WINDS}), c AS (SELECT storm, max(wind) AS wind, r.r, q.q FROM z, range(0, 60) r(r), range(0, 60) q(q) WHERE q.q >= x AND q.q < x + w AND r.r >= y AND r.r < y + h GROUP BY storm, r.r, q.q)
SELECT storm, wind, count(*)::DOUBLE AS area FROM c GROUP BY storm, wind
""")
def wind_ring_areas(t: Tables):
    """Area of each storm's winds without its stronger ones; suppliers stand for polygons of whole coordinates."""
    k = F.col("s_suppkey")
    x, y = k * 61 % 40, k * 53 % 40
    winds = t.supplier.select(F.col("s_nationkey").alias("storm"), (k % 3).alias("wind"), Y.rectangle(x, y, x + k * 17 % 12 + 3, y + k * 29 % 9 + 2).alias("ring"))
    return O.outer_parts(winds, ["storm"], "wind", 7.0).groupBy("storm", "wind").agg(F.round(F.sum("area"), 6).alias("area"))


_FOLDERS = ["raw", "filled_tifs", "Combined_Lidar", "old/Filled_Lidar", "skip"]
_NAMES = ["bathy_2004", "BlueTopo_bathy", "BT.survey_end_date", "lidar_mosaic", "combined_mosaic", "sand_mud_mask", "hurr_count_2004_2010", "tsm_mean_2004_2006", "slope_unc", "mask_ER_3", "grain_size"]
_PATHS = f"SELECT o_orderkey AS id, ['{"', '".join(_FOLDERS)}'][o_orderkey % 5 + 1] || '/' || ['{"', '".join(_NAMES)}'][o_custkey % 11 + 1] || '_BH4' || o_custkey % 7 || ['.tif', '.TIFF', '.xml'][o_orderkey % 3 + 1] AS path FROM orders"


@query(f"""
WITH p AS ({_PATHS}), q AS (SELECT id, path, lower(string_split(path, '/')[-1]) AS name, string_split(lower(path), '/') AS parts, string_split(path, '/')[-1] AS plain FROM p),
f AS (SELECT *, name LIKE '%.tif' OR name LIKE '%.tiff' AS raster, list_contains(parts, 'filled_lidar') OR list_contains(parts, 'filled_tifs') AS filled, (contains(name, 'bluetopo') OR starts_with(name, 'bt.')) AS base FROM q)
SELECT id, NOT contains(plain, 'sand_mud_mask') AND NOT list_contains(string_split(path, '/'), 'skip') AS source,
  raster AND NOT filled AND NOT (contains(name, 'mosaic') AND NOT contains(name, 'combined') AND NOT list_contains(parts, 'combined_lidar')) AND NOT (base AND NOT contains(name, 'survey_end_date')) AS training,
  raster AND NOT filled AND NOT contains(name, 'unc') AND NOT regexp_matches(name, 'hurr_(count|strength)_[0-9]{{4}}_[0-9]{{4}}') AND NOT (contains(name, 'bathy') AND NOT base) AS prediction,
  CASE WHEN raster AND regexp_matches(plain, 'ER_[0-9]+') THEN regexp_extract(plain, 'ER_[0-9]+') END AS region
FROM f
""")
def file_catalogue(t: Tables):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), (i + 1).cast("int"))
    paths = t.orders.select(k.alias("id"), F.concat(pick(_FOLDERS, k % 5), F.lit("/"), pick(_NAMES, c % 11), F.lit("_BH4"), (c % 7).cast("string"), pick([".tif", ".TIFF", ".xml"], k % 3)).alias("path"))
    path = F.col("path")
    regions = C.mask_catalogue(paths.select("id", "path")).select(F.col("path").alias("p"), "region").distinct()
    return paths.join(regions, path == F.col("p"), "left").select("id", C.source_file(path, ["skip"]).alias("source"), C.training_file(path).alias("training"), C.table_file(path, True).alias("prediction"), "region")


@query(f"""
WITH c AS (SELECT r % 4 AS layer, r, c, z FROM ({CELLS})), s AS (SELECT layer, layer * 1000.0 - 70 + c * (40 + layer * 25) AS x, 5000.0 + layer * 333 - r * (40 + layer * 25) AS y, (40 + layer * 25)::DOUBLE AS size, z FROM c),
t AS (SELECT floor(y / 100)::INT + i AS row, floor(x / 100)::INT + j AS col, s.* FROM s, range(-3, 4) a(i), range(-3, 4) b(j))
SELECT row, col, round(max(z), 6) AS z FROM t WHERE (col + 0.5) * 100 >= x AND (col + 0.5) * 100 < x + size AND (row + 0.5) * 100 >= y - size AND (row + 0.5) * 100 < y GROUP BY ALL
""")
def national_mosaic(t: Tables):
    """Four regions with cells of 40 to 115 m on one grid of 100 m, the largest value where they overlap."""
    layer = F.col("row") % 4
    grids = t.spark.range(4).select(F.col("id").cast("int").alias("layer"), (F.col("id") * 1000.0 - 70).alias("x0"), (F.col("id") * 333.0 + 5000).alias("y1"), (F.col("id") * 25.0 + 40).alias("size"))
    return C.national_mosaic(cells(t).select(layer.alias("layer"), "row", "col", "z"), grids, 100.0).withColumn("z", F.round("z", 6))
