"""Queries over polygons, storms, hazards, clearances and model tables. Footprints and grids are made from the star tables."""

from pyspark.sql import functions as F

from ..functions import scores as S
from ..operators import files as L
from ..operators import grid as G
from ..operators import hazards as H
from ..operators import modeltable as M
from ..operators import polygons as Y
from ..sqlpair import Tables, query
from .raster import CELLS, YEARS, cells, years
from .space import POINTS, points

#: Right-angled triangles whose corners lie between the points; no point lies on a side.
TRIANGLES = "SELECT p_partkey AS poly_id, p_partkey * 6007 % 9973 + 0.5 AS x, p_partkey * 3001 % 9967 + 0.5 AS y, (2 * p_size + 51)::DOUBLE AS w, (4 * p_size + 60)::DOUBLE AS h, p_size AS value FROM part"
IN_TRIANGLE = "p.x > t.x AND p.y > t.y AND (p.x - t.x) / t.w + (p.y - t.y) / t.h < 1"
BOXES = "SELECT s_suppkey AS a_id, s_suppkey * 6007 % 9973 + 0.5 AS x0, s_suppkey * 3001 % 9967 + 0.5 AS y0, s_suppkey * 6007 % 9973 + 0.5 + 100 + s_nationkey * 10 AS x1, s_suppkey * 3001 % 9967 + 180.5 AS y1 FROM supplier"
OTHER = "SELECT c_custkey AS b_id, (c_custkey * 7919 % 10007)::DOUBLE AS x0, (c_custkey * 4001 % 10009)::DOUBLE AS y0, (c_custkey * 7919 % 10007)::DOUBLE + 70 AS x1, (c_custkey * 4001 % 10009)::DOUBLE + 40 + c_nationkey AS y1 FROM customer"
MEET = "a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1"


def triangles(t: Tables):
    k, size = F.col("p_partkey"), F.col("p_size")
    x, y, w, h = k * 6007 % 9973 + 0.5, k * 3001 % 9967 + 0.5, 2 * size + 51, 4 * size + 60
    return t.part.select(k.alias("poly_id"), Y.ring_of([(x, y), (x + w, y), (x, y + h)]).alias("ring"), size.alias("value"))


def boxes(t: Tables):
    x, y = F.col("s_suppkey") * 6007 % 9973 + 0.5, F.col("s_suppkey") * 3001 % 9967 + 0.5
    return t.supplier.select(F.col("s_suppkey").alias("a_id"), Y.rectangle(x, y, x + 100 + F.col("s_nationkey") * 10, y + 180).alias("ring"))


def others(t: Tables):
    x, y = F.col("c_custkey") * 7919 % 10007, F.col("c_custkey") * 4001 % 10009
    return t.customer.select(F.col("c_custkey").alias("b_id"), Y.rectangle(x, y, x + 70, y + 40 + F.col("c_nationkey")).alias("ring"))


@query(f"WITH p AS ({POINTS}), t AS ({TRIANGLES}) SELECT p.id, t.poly_id FROM p JOIN t ON {IN_TRIANGLE}")
def points_in_polygons(t: Tables):
    return Y.within(points(t), triangles(t), 200.0).select("id", "poly_id")


@query(f"WITH p AS ({POINTS}), t AS ({TRIANGLES}) SELECT p.id FROM p WHERE EXISTS (SELECT 1 FROM t WHERE {IN_TRIANGLE})")
def clip_to_polygons(t: Tables):
    return Y.clip(points(t), triangles(t), 200.0).select("id")


@query(f"WITH a AS ({BOXES}), b AS ({OTHER}) SELECT a_id, b_id FROM a JOIN b ON {MEET}")
def intersects_inner(t: Tables):
    return Y.intersect_join(boxes(t), others(t), 200.0).select("a_id", "b_id")


@query(f"WITH a AS ({BOXES}), b AS ({OTHER}) SELECT a_id, b_id FROM a LEFT JOIN b ON {MEET}")
def intersects_left(t: Tables):
    return Y.intersect_join(boxes(t), others(t), 200.0, "left").select("a_id", "b_id")


@query(f"WITH a AS ({BOXES}), b AS ({OTHER}) SELECT a_id FROM a WHERE EXISTS (SELECT 1 FROM b WHERE {MEET})")
def intersects_semi(t: Tables):
    return Y.intersect_join(boxes(t), others(t), 200.0, "left_semi").select("a_id")


@query(f"""
WITH t AS (SELECT * FROM ({TRIANGLES}) WHERE poly_id % 3 > 0), c AS (SELECT r.k AS row, q.k AS col, r.k * 24 + 12.0 AS y, q.k * 24 + 12.0 AS x FROM range(0, 440) r(k), range(0, 440) q(k)),
h AS (SELECT row, col, value, poly_id FROM t JOIN c p ON {IN_TRIANGLE})
SELECT row::INT AS row, col::INT AS col, max_by(value, poly_id) AS last_value, sum(value)::BIGINT AS total FROM h GROUP BY ALL
""")
def burn_replace_and_add(t: Tables):
    some = triangles(t).where("poly_id % 3 > 0")
    return Y.burn(some, 24.0).withColumnRenamed("z", "last_value").join(Y.burn(some, 24.0, "add").withColumnRenamed("z", "total"), ["row", "col"])


@query("""
WITH c AS (SELECT r.k AS row, q.k AS col, r.k * 50.0 AS y0, q.k * 50.0 AS x0 FROM range(0, 210) r(k), range(0, 220) q(k)),
b AS (SELECT s_suppkey AS id, s_suppkey * 6007 % 9973 + 0.5 AS x, s_suppkey * 3001 % 9967 + 0.5 AS y, s_suppkey * 6007 % 9973 + 0.5 + 100 + s_nationkey * 10 AS x1, s_suppkey * 3001 % 9967 + 180.5 AS y1 FROM supplier)
SELECT row::INT AS row, col::INT AS col, max(id) AS z FROM c JOIN b ON x <= x0 + 50 AND x0 <= x1 AND y <= y0 + 50 AND y0 <= y1 GROUP BY ALL
""")
def burn_all_touched(t: Tables):
    return Y.burn(boxes(t).select(F.col("a_id").alias("poly_id"), "ring", F.col("a_id").alias("value")), 50.0, all_touched=True)


@query("""
WITH e AS (SELECT event_id, (value * 3 + 1)::DOUBLE AS r FROM events)
SELECT event_id, round(4.5 * r * r * sin(pi() / 18), 5) AS area FROM e
""")
def quarter_circles(t: Tables):
    r = F.col("value") * 3 + 1
    kinds = [Y.area(Y.quarter_circle(F.col("event_id").cast("double"), F.lit(5.0), r, q)) for q in Y.QUADRANTS]
    return t.events.select("event_id", F.round((kinds[0] + kinds[1] + kinds[2] + kinds[3]) / 4, 5).alias("area"))


@query(f"""
WITH p AS ({POINTS}), t AS (SELECT *, poly_id % 20 AS storm, CASE poly_id % 4 WHEN 0 THEN 64 WHEN 1 THEN 50 WHEN 2 THEN 34 ELSE 0 END AS wind FROM ({TRIANGLES}))
SELECT p.id, storm, max(wind) AS wind FROM p JOIN t ON {IN_TRIANGLE} GROUP BY ALL
""")
def storm_ring_winds(t: Tables):
    k = F.col("poly_id")
    wind = F.when(k % 4 == 0, 64).when(k % 4 == 1, 50).when(k % 4 == 2, 34).otherwise(0)
    return Y.strongest(points(t), triangles(t).withColumns({"storm": k % 20, "wind": wind}), 200.0).select("id", "storm", "wind")


@query("""
WITH t AS (SELECT n_nationkey AS n, n_nationkey * 8.0 AS x, 4.0 AS y FROM nation), q AS (SELECT * FROM (VALUES (1, 0, 0), (2, 1, 0), (3, 0, 1), (4, 1, 1)) v(k, i, j))
SELECT 'N' || n || '_' || k AS tile, (x + i * 4)::DOUBLE AS x0, (y + j * 4)::DOUBLE AS y0, (x + i * 4 + 4)::DOUBLE AS x1, (y + j * 4 + 4)::DOUBLE AS y1 FROM t, q
""")
def tile_quadrants(t: Tables):
    x = F.col("n_nationkey") * 8.0
    return Y.quartered(t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("tile"), x.alias("x0"), F.lit(4.0).alias("y0"), (x + 8).alias("x1"), F.lit(12.0).alias("y1")))


@query("SELECT 'T' || lpad((k // 30)::VARCHAR, 4, '0') || lpad((k % 30)::VARCHAR, 4, '0') AS tile, k + 1 AS number, k % 30 * 500.0::DOUBLE - 100 AS x0, k // 30 * 500.0::DOUBLE AS y0, k % 30 * 500.0::DOUBLE + 400 AS x1, k // 30 * 500.0::DOUBLE + 500 AS y1 FROM range(0, 600) r(k)")
def tiles_of_the_world(t: Tables):
    s = Y.tile_scheme(t.spark, -100.0, 0.0, 500.0, 30, 20)
    return s.select("tile", "number", "x0", "y0", "x1", "y1")


_ORDER_HAZARDS = """SELECT o_orderkey, ['OBSTRN', 'WRECKS', 'PILPNT', 'UWTROC', 'LNDMRK'][(o_orderkey % 5 + 1)::INT] AS object_group, CASE WHEN o_orderkey % 3 > 0 THEN 'code ' || (o_custkey % 13) END AS q,
  CASE WHEN o_orderkey % 2 = 0 THEN (o_custkey % 12)::VARCHAR END AS p, CASE WHEN o_orderkey % 10 = 0 THEN 'Existence Doubtful' END AS st, CASE WHEN o_orderkey % 12 = 0 THEN 'reported 1987' END AS inf FROM orders"""
_HAZARDS = f"""WITH o AS ({_ORDER_HAZARDS}), c AS (SELECT *, TRY_CAST(regexp_extract(coalesce(q, p), '(\\d+)', 1) AS INT) AS code FROM o),
w AS (SELECT *, CASE WHEN object_group = 'LNDMRK' THEN 0 WHEN st IS NOT NULL OR inf IS NOT NULL OR code BETWEEN 2 AND 9 THEN 3 WHEN code IS NULL OR code IN (1, 10, 11) THEN 1 ELSE 0 END AS weight FROM c)"""


def hazards(t: Tables):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    group = F.get(F.array(*map(F.lit, ("OBSTRN", "WRECKS", "PILPNT", "UWTROC", "LNDMRK"))), (k % 5).cast("int"))
    return H.classified(
        t.orders.select(
            "o_orderkey", "o_custkey", group.alias("object_group"), F.when(k % 3 > 0, F.concat(F.lit("code "), (c % 13).cast("string"))).alias("QUAPOS"), F.when(k % 2 == 0, (c % 12).cast("string")).alias("QUAPOS_primitive"),
            F.when(k % 10 == 0, "Existence Doubtful").alias("STATUS"), F.when(k % 12 == 0, "reported 1987").alias("INFORM"),
        )
    )


@query(f"""{_HAZARDS}
SELECT o_orderkey, CASE object_group WHEN 'OBSTRN' THEN 'Obstruction' WHEN 'WRECKS' THEN 'Wreck' WHEN 'PILPNT' THEN 'Pile' WHEN 'UWTROC' THEN 'Underwater / awash rock' ELSE 'Other' END AS hazard_type, code AS quapos_code,
  CASE code WHEN 1 THEN 'surveyed' WHEN 2 THEN 'unsurveyed' WHEN 3 THEN 'inadequately surveyed' WHEN 4 THEN 'approximate' WHEN 5 THEN 'position doubtful' WHEN 6 THEN 'unreliable' WHEN 7 THEN 'reported, not surveyed'
    WHEN 8 THEN 'reported, not confirmed' WHEN 9 THEN 'estimated' WHEN 10 THEN 'precisely known' WHEN 11 THEN 'calculated' END AS quapos_label,
  CASE weight WHEN 3 THEN '02_unverified_reported_error' WHEN 1 THEN '01_known_hazard' ELSE 'other' END AS methodology_group, weight::DOUBLE AS hazard_weight FROM w
""")
def hazard_classes(t: Tables):
    return hazards(t).select("o_orderkey", "hazard_type", "quapos_code", "quapos_label", "methodology_group", "hazard_weight")


@query(f"""{_HAZARDS}, g AS (SELECT *, o_custkey % 97 AS cell FROM w JOIN (SELECT o_orderkey, o_custkey FROM orders) USING (o_orderkey)), grid AS (SELECT range AS grid_id FROM range(0, 120))
SELECT grid_id, count(o_orderkey) AS total_hazard_count, count(*) FILTER (weight = 1) AS known_hazard_count, count(*) FILTER (weight = 3) AS reported_error_count,
  count(*) FILTER (object_group = 'OBSTRN') AS obstruction_count, count(*) FILTER (object_group = 'WRECKS') AS wreck_count, count(*) FILTER (object_group = 'PILPNT') AS pile_count, count(*) FILTER (object_group = 'UWTROC') AS rock_count,
  coalesce(max(weight), 0)::DOUBLE AS hazard_score, coalesce(max(CASE WHEN weight = 1 THEN 1 ELSE 0 END), 0)::DOUBLE AS known_score, coalesce(max(CASE WHEN weight = 3 THEN 3 ELSE 0 END), 0)::DOUBLE AS reported_score
FROM grid LEFT JOIN g ON cell = grid_id GROUP BY grid_id
""")
def hazard_grid(t: Tables):
    h = hazards(t).select((F.col("o_custkey") % 97).alias("grid_id"), F.col("o_orderkey").alias("hazard_id"), "object_group", "methodology_group", F.col("hazard_weight").alias("hazard_score"), F.col("known_weight").alias("known_score"), F.col("reported_weight").alias("reported_score"))
    return H.grid_summary(t.spark.range(120).withColumnRenamed("id", "grid_id"), h)


@query("SELECT p_partkey, CASE WHEN n > 9 THEN 5 WHEN n > 5 THEN 4 WHEN n > 1 THEN 3 WHEN n > 0 THEN 2 ELSE 1 END AS class FROM (SELECT p_partkey, p_size % 4 + 3 * (p_partkey % 4) AS n FROM part)")
def debris_classes(t: Tables):
    return t.part.select("p_partkey", H.debris_class(F.col("p_size") % 4, F.col("p_partkey") % 4).alias("class"))


_STAGE = f"""WITH g AS (SELECT (l_orderkey % 64)::INT AS r, (l_partkey % 64)::INT AS c, -avg(l_quantity) AS depth, max(year(l_shipdate)) AS yr, max(l_linenumber) - 3 AS soft, avg(l_tax) AS tide, count(*) AS storms, max(l_discount * 100) AS debris FROM lineitem GROUP BY 1, 2),
v AS (SELECT r, c, CASE WHEN (r + c) % 13 > 0 THEN depth END AS depth, CASE WHEN r % 9 > 0 THEN yr END AS yr, soft, tide, storms, CASE WHEN c % 4 > 0 THEN debris END AS debris FROM g),
b AS (SELECT *, depth IS NOT NULL AND yr IS NOT NULL AS inside, CASE WHEN depth IS NOT NULL AND soft > 0 AND abs(depth) <= 20 THEN tide * (2024 - yr) END AS exposure FROM v),
k AS (SELECT *, CASE WHEN inside AND soft > 0 AND abs(depth) <= 40 THEN CASE WHEN storms <= 0 THEN 1 WHEN storms <= 4 THEN 2 WHEN storms <= 10 THEN 3 WHEN storms <= 20 THEN 4 ELSE 5 END END AS storm_bin,
  CASE WHEN exposure < 0.1 THEN 1 WHEN exposure < 0.2 THEN 2 WHEN exposure < 0.5 THEN 3 WHEN exposure < 1 THEN 4 WHEN exposure IS NOT NULL THEN 5 END AS tide_bin,
  CASE WHEN inside THEN CASE WHEN coalesce(debris, 0) <= 0 THEN 1 WHEN debris <= 1 THEN 2 WHEN debris <= 5 THEN 3 WHEN debris <= 10 THEN 4 ELSE 5 END END AS debris_bin FROM b),
s AS (SELECT *, CASE WHEN inside THEN (coalesce(storm_bin - 1, 0) + coalesce(tide_bin - 1, 0) + coalesce(debris_bin - 1, 0)) * 0.022::DOUBLE / 3 END AS coefficient FROM k)"""


def stage_cells(t: Tables):
    g = t.lineitem.groupBy((F.col("l_orderkey") % 64).cast("int").alias("row"), (F.col("l_partkey") % 64).cast("int").alias("col")).agg(
        (-F.avg("l_quantity")).alias("depth"), F.max(F.year("l_shipdate")).alias("yr"), (F.max("l_linenumber") - 3).alias("soft"), F.avg("l_tax").alias("tide"), F.count(F.lit(1)).alias("storms"), F.max(F.col("l_discount") * 100).alias("debris")
    )
    return g.withColumns({"depth": F.when((F.col("row") + F.col("col")) % 13 > 0, F.col("depth")), "yr": F.when(F.col("row") % 9 > 0, F.col("yr")), "debris": F.when(F.col("col") % 4 > 0, F.col("debris"))})


@query(f"{_STAGE} SELECT r AS row, c AS col, round(coefficient, 9) AS coefficient, storm_bin, tide_bin, debris_bin, round(exposure, 9) AS exposure FROM s")
def stage1_change(t: Tables):
    made = S.change_bins(*[F.col(c) for c in ("depth", "yr", "soft", "tide", "storms", "debris")])
    rows = stage_cells(t).select("row", "col", *[v.alias(k) for k, v in made.items()])
    return rows.withColumns({"coefficient": F.round("coefficient", 9), "exposure": F.round("exposure", 9)})


@query(f"""{_STAGE}, d AS (SELECT *, (c % 15) / 10.0::DOUBLE AS slope, CASE WHEN r % 3 > 0 THEN abs(depth) - c % 30 END AS ukc FROM s),
l AS (SELECT *, CASE WHEN slope < 0.5 THEN 20 WHEN slope < 1 THEN 30 ELSE 40 END AS lo, CASE WHEN slope < 0.5 THEN 50 WHEN slope < 1 THEN 75 ELSE 100 END AS hi FROM d),
f AS (SELECT *, CASE WHEN ukc >= 0 THEN CASE WHEN ukc <= 1 THEN 100 WHEN ukc <= lo THEN 80 WHEN ukc <= hi THEN 30 ELSE 10 END
    WHEN depth IS NOT NULL THEN CASE WHEN abs(depth) < 2 THEN 100 WHEN abs(depth) <= lo THEN 80 WHEN abs(depth) <= hi THEN 30 ELSE 10 END END AS desired,
  greatest(least((50 + c) * exp(-coefficient * (2024 - yr)), 110), 0) AS present FROM l)
SELECT r AS row, c AS col, desired, CASE WHEN coefficient IS NOT NULL THEN round(present, 7) END AS present, CASE WHEN coefficient IS NOT NULL THEN round(desired - present, 7) END AS gap FROM f
""")
def stage2_scores(t: Tables):
    coeff = S.change_bins(*[F.col(c) for c in ("depth", "yr", "soft", "tide", "storms", "debris")])["coefficient"]
    ukc = F.when(F.col("row") % 3 > 0, S.clearance(F.col("depth"), F.col("col") % 30))
    made = S.survey_scores(50 + F.col("col"), ukc, F.col("depth"), F.col("col") % 15 / F.lit(10.0), coeff, F.col("yr"))
    rows = stage_cells(t).select("row", "col", *[v.alias(k) for k, v in made.items()])
    return rows.withColumns({"present": F.round("present", 7), "gap": F.round("gap", 7)})


@query(f"""
WITH g AS ({CELLS}), m AS (SELECT (o_orderkey % 64)::INT AS r, (o_custkey % 64)::INT AS c, month(o_orderdate) AS m, max(o_custkey % 12) AS draft FROM orders GROUP BY ALL),
d AS (SELECT r, c, max(draft) AS draft FROM m WHERE draft > 0 GROUP BY ALL)
SELECT r AS row, c AS col, round(abs(z) - draft, 6) AS ukc FROM g JOIN d USING (r, c)
""")
def regional_clearance(t: Tables):
    drafts = t.orders.groupBy((F.col("o_orderkey") % 64).cast("int").alias("row"), (F.col("o_custkey") % 64).cast("int").alias("col"), F.month("o_orderdate").alias("month")).agg(F.max(F.col("o_custkey") % 12).alias("draft"))
    return G.clearances(cells(t), drafts).withColumn("ukc", F.round("ukc", 6))


@query(f"WITH g AS (SELECT r, c, -z AS z FROM ({CELLS})) SELECT r AS row, c AS col, z BETWEEN -20 AND 0 AS shallow, z BETWEEN -40 AND 0 AS shelf FROM g WHERE z BETWEEN -40 AND 0")
def isobath_cells(t: Tables):
    deep = cells(t).withColumn("z", -F.col("z"))
    shallow = G.depth_band(deep, -20, 0).withColumn("s", F.lit(True))
    return G.depth_band(deep, -40, 0).join(shallow, ["row", "col"], "left").select("row", "col", F.coalesce("s", F.lit(False)).alias("shallow"), F.lit(True).alias("shelf"))


@query(f"WITH g AS ({CELLS}), k AS (SELECT * FROM g WHERE (r * 7 + c * 3) % 5 <> 0), t AS (SELECT r, c FROM range(0, 64) a(r), range(0, 64) b(c)) SELECT t.r::INT AS row, t.c::INT AS col, round(avg(k.z), 6) AS z FROM t JOIN k ON k.r BETWEEN t.r - 3 AND t.r + 3 AND k.c BETWEEN t.c - 3 AND t.c + 3 GROUP BY ALL")
def suspended_sediment(t: Tables):
    some = cells(t).where((F.col("row") * 7 + F.col("col") * 3) % 5 != 0)
    return G.smoothed(some, 2000.0, 600.0).where("row between 0 and 63 and col between 0 and 63").withColumn("z", F.round("z", 6))


@query(f"WITH g AS ({CELLS}) SELECT a.r AS row, a.c AS col, round(avg(b.z) - max(a.z), 6) AS tci FROM g a JOIN g b ON b.r BETWEEN a.r - 1 AND a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1 AND (a.r <> b.r OR a.c <> b.c) GROUP BY ALL HAVING count(*) = 8")
def convergence_index(t: Tables):
    return G.convergence(cells(t)).withColumn("tci", F.round("tci", 6))


@query(f"SELECT r AS row, c AS col, z FROM ({CELLS}) WHERE (r + c) % 3 = 0")
def cut_to_mask(t: Tables):
    mask = G.presence(cells(t)).where("z = 1 and (row + col) % 3 = 0").select("row", "col")
    return G.masked(cells(t), mask)


@query("SELECT min(x) AS x0, min(y) AS y0, max(x + 5) AS x1, max(y + 9) AS y1, arg_min(s, k) AS size FROM (SELECT p_partkey AS k, p_size::DOUBLE AS x, (p_partkey % 77)::DOUBLE AS y, (p_size % 3 + 1)::DOUBLE AS s FROM part)")
def common_extent(t: Tables):
    x, y = F.col("p_size").cast("double"), (F.col("p_partkey") % 77).cast("double")
    return G.shared_extent(t.part.select("p_partkey", x.alias("x0"), y.alias("y0"), (x + 5).alias("x1"), (y + 9).alias("y1"), (F.col("p_size") % 3 + 1).cast("double").alias("size")), "p_partkey")


@query(f"SELECT r::DOUBLE AS x, c::DOUBLE AS y, max(z) FILTER (layer = 1995) AS a_1995, max(z) FILTER (layer = 1996) AS b_1996 FROM ({YEARS}) WHERE layer IN (1995, 1996) GROUP BY ALL")
def layers_to_wide(t: Tables):
    name = F.when(F.col("layer") == 1995, "a_1995").when(F.col("layer") == 1996, "b_1996")
    return M.wide(years(t).select(F.col("row").cast("double").alias("x"), F.col("col").cast("double").alias("y"), name.alias("variable"), F.col("z").alias("value")).where("variable is not null"), ["a_1995", "b_1996"])


@query(f"""
WITH g AS (SELECT (c // 8)::INT AS col, (r // 8)::INT AS row, avg(z) AS value FROM ({CELLS}) GROUP BY 1, 2), p AS (SELECT id, x, y, CASE WHEN id % 4 = 0 THEN 1.0 END AS had FROM ({POINTS}))
SELECT id, round(coalesce(had, value), 6) AS depth FROM p LEFT JOIN g ON row = floor((10000 - y) / 1500) AND col = floor((x - 500) / 1500)
""")
def coarse_sample(t: Tables):
    coarse = G.coarser(cells(t), 8).withColumnRenamed("z", "value")
    p = points(t).withColumn("depth", F.when(F.col("id") % 4 == 0, 1.0))
    return M.sampled(p, coarse, 500.0, 10000.0, 1500.0, "depth").select("id", F.round("depth", 6).alias("depth"))


_WIDE = "SELECT p_partkey AS FID, p_size::DOUBLE AS X, (p_partkey % 31)::DOUBLE AS Y, p_retailprice AS a, p_retailprice + p_size AS b, p_size * 2.0::DOUBLE AS s, (p_partkey % 4 * 90)::DOUBLE AS f, p_size % 9 AS g FROM part"


@query(f"""
WITH w AS ({_WIDE}) SELECT X, Y, FID, 2004 AS year_ti, 2006 AS year_t, a AS bathy_ti, b AS bathy_t, round(cos(radians(f)), 9) AS flowdir_cos_t, round(sin(radians(f)), 9) AS flowdir_sin_t, s AS slope_t, round(b - a, 6) AS delta_bathy,
  s + 1 AS tsm_mean_2004_2006, g AS grain_size_layer FROM w
""")
def wide_to_long_pairs(t: Tables):
    k, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    wide = t.part.select(
        k.alias("FID"), size.cast("double").alias("X"), (k % 31).cast("double").alias("Y"), price.alias("bathy_20040101"), (price + size).alias("combined_bathy_2006"), (size * 2.0).alias("bathy_slope_2006"), (k % 4 * 90).cast("double").alias("flowdir_2006"),
        (size * 2.0 + 1).alias("2004_2006_tsm_mean"), (size * 3.0).alias("2010_2015_tsm_mean"), (size % 9).alias("grain_size"),
    )
    rows = M.long_pairs(M.standardised(wide), [(1998, 2001), (2004, 2006), (2010, 2015)])
    (made,) = rows.values()
    return made.withColumns({"delta_bathy": F.round("delta_bathy", 6), "flowdir_cos_t": F.round("flowdir_cos_t", 9), "flowdir_sin_t": F.round("flowdir_sin_t", 9)})


@query("SELECT 'p_size' AS predictor, min(p_size)::DOUBLE AS least, max(p_size)::DOUBLE AS largest, (max(p_size) - min(p_size))::DOUBLE AS span FROM part UNION ALL SELECT 'p_retailprice', min(p_retailprice), max(p_retailprice), max(p_retailprice) - min(p_retailprice) FROM part")
def predictor_spans(t: Tables):
    return M.spans(t.part, ["p_size", "p_retailprice"])


@query("""
WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size * 1.0::DOUBLE END AS m, p_retailprice AS k, p_partkey % 100 AS pct FROM part)
SELECT p_partkey, coalesce(m, k) AS change FROM s WHERE pct < 95
""")
def usable_tiles_and_hybrid(t: Tables):
    k = F.col("p_partkey")
    rows = t.part.select("p_partkey", F.when(k % 5 != 0, F.col("p_size").cast("double")).alias("m"), "p_retailprice", (k % 100).alias("2004_2006_nan_percent"))
    return M.usable_tiles(rows, "2004_2006").select("p_partkey", M.hybrid_change(F.col("m"), F.col("p_retailprice")).alias("change"))


@query("""
WITH f AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'BH4' WHEN 1 THEN 'BF2H' || (o_custkey % 10) ELSE 'BC3' END || '_' || o_custkey AS tile, 'Base_x_Provider_' || (o_custkey % 5) || '_' || o_orderstatus AS folder FROM orders)
SELECT o_orderkey, CASE WHEN tile LIKE 'BH%' THEN 'nearshore' WHEN NOT regexp_matches(tile, '^BF2H[0-9]') THEN 'offshore' END AS shore, CASE WHEN o_orderkey % 2 = 0 THEN substr(folder, 8) END AS provider,
  CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 10)::INT ELSE 9999 END AS region, CASE WHEN o_orderkey % 6 > 0 THEN '20050101' ELSE '99999999' END AS start, CASE WHEN o_orderkey % 7 > 2 THEN (o_orderkey % 7 - 2)::DOUBLE ELSE 1.0 END AS width FROM f
""")
def file_rules(t: Tables):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    tile = F.concat(F.when(k % 3 == 0, "BH4").when(k % 3 == 1, F.concat(F.lit("BF2H"), (F.col("o_custkey") % 10).cast("string"))).otherwise("BC3"), F.lit("_"), c)
    folder = F.concat(F.lit("Base_x_Provider_"), (F.col("o_custkey") % 5).cast("string"), F.lit("_"), F.col("o_orderstatus"))
    region = F.when(k % 4 > 0, F.concat(F.lit("ER_"), (k % 10).cast("string"))).otherwise("ER")
    period = F.when(k % 6 > 0, "TSM_20050101-20050131.nc").otherwise("TSM.nc")
    width = F.when(k % 7 > 0, (k % 7 - 2).cast("double"))
    return t.orders.select(
        "o_orderkey", L.shore_class(tile).alias("shore"), L.provider_id(folder, k % 2 == 0).alias("provider"), L.region_order(region).alias("region"), L.period_start(period).alias("start"), L.usable_width(width).alias("width")
    )


@query("SELECT p_brand, list(p_name ORDER BY p_name) AS paths, count(*) AS n, arg_min(p_size, p_partkey)::VARCHAR AS crs FROM (SELECT p_brand, p_partkey, p_size, p_name || '_' || p_partkey AS p_name FROM part) GROUP BY p_brand")
def provider_mosaics(t: Tables):
    files = t.part.select("p_brand", F.concat_ws("_", "p_name", F.col("p_partkey").cast("string")).alias("path"), F.col("p_size").cast("string").alias("crs"), "p_partkey")
    return L.of_provider(files, "p_brand", "path", "p_partkey")
