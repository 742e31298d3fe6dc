"""Queries over exact medians, neighbours, Voronoi cells, regions of cells, storm swaths and trees of all tiles."""

from pyspark.sql import functions as F

from ..operators import forests as B
from ..operators import grid as G
from ..operators import neighbours as N
from ..operators import polygons as Y
from ..operators import regions as R
from ..operators import selection as Q
from ..sqlpair import Tables, query
from .raster import CELLS, cells

MASKED = f"SELECT r::INT AS row, c::INT AS col, z FROM ({CELLS}) WHERE (r * 7 + c * 3 + (r * c) % 11) % 5 < 3"


def masked(t: Tables):
    r, c = F.col("row"), F.col("col")
    return cells(t).where((r * 7 + c * 3 + (r * c) % 11) % 5 < 3)


@query(" UNION ALL ".join(f"SELECT l_returnflag AS mode, {s}::DOUBLE AS share, round(quantile_cont(l_extendedprice, {s}), 6) AS value FROM lineitem GROUP BY 1" for s in (0.05, 0.5, 0.95)))
def group_quantiles(t: Tables):
    found = Q.group_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", [0.05, 0.5, 0.95])
    return found.select(F.col("l_returnflag").alias("mode"), "share", F.round("value", 6).alias("value"))


_SIX = ", ".join(f"embedding[{i}]::DOUBLE AS f{i}" for i in range(1, 7))
_FAR = " + ".join(f"(q.f{i} - p.f{i}) ** 2" for i in range(1, 7))


@query(f"""
WITH e AS (SELECT vec_id, label, {_SIX} FROM embeddings WHERE label IS NOT NULL),
n AS (SELECT q.vec_id, q.label, p.vec_id AS near, sqrt({_FAR}) AS d, row_number() OVER (PARTITION BY q.vec_id, q.label ORDER BY {_FAR}, p.vec_id) AS n FROM e q JOIN e p ON q.label = p.label AND q.vec_id <> p.vec_id WHERE q.vec_id % 50 = 0)
SELECT vec_id, n::INT AS n, near, round(d, 6) AS distance FROM n WHERE n <= 5
""")
def nearest_over_six_features(t: Tables):
    names = [f"f{i}" for i in range(6)]
    e = t.embeddings.select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)])
    near = N.nearest_rows(e.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "q_id"), e.withColumnRenamed("vec_id", "p_id"), 5, ["label"], names)
    return near.select(F.col("q_id").alias("vec_id"), "n", F.col("p_id").alias("near"), F.round("d", 6).alias("distance"))


_SITES = "SELECT s_suppkey AS site_id, (s_suppkey * 6007 % 9973)::DOUBLE AS x, (s_suppkey * 3001 % 9967)::DOUBLE AS y FROM supplier"
_PLACES = "SELECT DISTINCT (o_custkey * 104729 % 10009 // 100)::INT AS row, (o_orderkey * 7919 % 10007 // 100)::INT AS col FROM orders"
_TURN = "(b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x)"


@query(f"""
WITH s AS ({_SITES}), p AS ({_PLACES}),
h AS (SELECT DISTINCT a.site_id FROM s a JOIN s b ON a.site_id <> b.site_id JOIN s c ON TRUE GROUP BY a.site_id, b.site_id HAVING min({_TURN}) >= 0),
d AS (SELECT row, col, arg_min(site_id, {{'d': ((col + 0.5) * 100 - x) ** 2 + ((row + 0.5) * 100 - y) ** 2, 'i': site_id}}) AS site_id FROM p, s GROUP BY ALL)
SELECT row, col, site_id FROM d WHERE site_id NOT IN (SELECT site_id FROM h)
""")
def voronoi_cells(t: Tables):
    """The nearest supplier to each cell with an order; suppliers on the hull of all have no closed cell."""
    k = F.col("s_suppkey")
    sites = t.supplier.select(k.alias("site_id"), (k * 6007 % 9973).cast("double").alias("x"), (k * 3001 % 9967).cast("double").alias("y"))
    at = lambda c: F.floor(c / 100).cast("int")
    places = t.orders.select(at(F.col("o_custkey") * 104729 % 10009).alias("row"), at(F.col("o_orderkey") * 7919 % 10007).alias("col"))
    return N.nearest_site(places, sites, 100.0)


_BESIDE = "abs(a.row - b.row) + abs(a.col - b.col) = 1"


@query(f"""
WITH RECURSIVE m AS ({MASKED}), reach AS (SELECT row * 1000 + col AS start, row, col FROM m UNION SELECT a.start, b.row, b.col FROM reach a JOIN m b ON {_BESIDE})
SELECT row, col, min(start) // 1000 AS first_row, min(start) % 1000 AS first_col FROM reach GROUP BY ALL
""")
def connected_regions(t: Tables):
    return R.labelled(masked(t)).select("row", "col", F.col("region.r").alias("first_row"), F.col("region.c").alias("first_col"))


@query(f"""
WITH RECURSIVE m AS (SELECT row, col FROM ({MASKED})), e AS (SELECT min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1 FROM m),
g AS (SELECT r.r::INT AS row, c.c::INT AS col FROM e, range(0, 64) r(r), range(0, 64) c(c) WHERE r.r BETWEEN r0 AND r1 AND c.c BETWEEN c0 AND c1 EXCEPT SELECT row, col FROM m),
out AS (SELECT row, col FROM g, e WHERE row IN (r0, r1) OR col IN (c0, c1) UNION SELECT b.row, b.col FROM out a JOIN g b ON {_BESIDE})
SELECT row, col FROM g EXCEPT SELECT row, col FROM out
""")
def enclosed_holes(t: Tables):
    return R.enclosed_holes(masked(t)).select("row", "col")


@query(f"""
WITH m AS (SELECT *, (row // 16)::INT AS mask FROM ({MASKED})), s AS (SELECT a.mask, a.row, a.col, 4 - count(b.row) AS open FROM m a LEFT JOIN m b ON a.mask = b.mask AND {_BESIDE} GROUP BY ALL)
SELECT mask, count(*)::DOUBLE AS area, sum(open)::DOUBLE AS border FROM s GROUP BY mask
""")
def outlines_of_masks(t: Tables):
    """Areas and lengths of the rings round each mask's cells."""
    rings = R.outlines(masked(t).withColumn("mask", F.floor(F.col("row") / 16).cast("int")), ("mask",))
    length = F.aggregate(Y.edges(F.col("ring")), F.lit(0.0), lambda s, e: s + F.abs(e["a"]["x"] - e["b"]["x"]) + F.abs(e["a"]["y"] - e["b"]["y"]))
    return rings.groupBy("mask").agg(F.sum(R.signed_area(F.col("ring"))).alias("area"), F.sum(length).alias("border"))


@query(f"""
WITH g AS ({CELLS}), s AS (SELECT g.r, g.c, -coalesce((b.z - a.z) / 2, b.z - g.z, g.z - a.z, 0) AS dr, -coalesce((e.z - w.z) / 2, e.z - g.z, g.z - w.z, 0) AS dc
  FROM g LEFT JOIN g a ON a.r = g.r - 1 AND a.c = g.c LEFT JOIN g b ON b.r = g.r + 1 AND b.c = g.c LEFT JOIN g w ON w.r = g.r AND w.c = g.c - 1 LEFT JOIN g e ON e.r = g.r AND e.c = g.c + 1)
SELECT g.r AS row, g.c AS col, round(avg(degrees(acos(greatest(least(((g.r - s.r) * s.dr + (g.c - s.c) * s.dc) / (sqrt(s.dr ** 2 + s.dc ** 2) * sqrt((g.r - s.r) ** 2 + (g.c - s.c) ** 2)), 1), -1)))) - 90, 6) AS index
FROM g JOIN s ON g.r BETWEEN s.r - 1 AND s.r + 1 AND g.c BETWEEN s.c - 1 AND s.c + 1 AND (g.r <> s.r OR g.c <> s.c) AND (s.dr <> 0 OR s.dc <> 0) GROUP BY ALL
""")
def convergence_angles(t: Tables):
    return G.convergence_index(cells(t)).withColumn("index", F.round("index", 6))


@query(f"WITH m AS ({MASKED}), g AS (SELECT r::INT AS row, c::INT AS col FROM ({CELLS})) SELECT g.row, g.col, round(avg(z), 6) AS mean FROM g JOIN m ON m.row BETWEEN g.row - 12 AND g.row + 12 AND m.col BETWEEN g.col - 12 AND g.col + 12 GROUP BY ALL")
def wide_square_mean(t: Tables):
    kept = masked(t).select("row", "col", "z")
    holed = cells(t).select("row", "col").join(kept, ["row", "col"], "left")
    return G.box_mean_blocks(holed, 12).join(holed.select("row", "col"), ["row", "col"], "left_semi").withColumn("mean", F.round("mean", 6))


_FIXES = "SELECT s_suppkey AS ord, s_suppkey % 4 AS q, s_nationkey AS storm, (s_suppkey * 3001 % 997)::DOUBLE AS x, (s_suppkey * 6007 % 991)::DOUBLE AS y, (40 + s_suppkey * 37 % 160)::DOUBLE AS radius FROM supplier"
_ARC = " UNION ALL ".join(f"SELECT ord, q, storm, {k} AS k, x + radius * cos((CASE q WHEN 0 THEN 0 WHEN 1 THEN pi() / 2 WHEN 2 THEN -pi() / 2 ELSE -pi() END) + pi() / 18 * {k}) AS x, y + radius * sin((CASE q WHEN 0 THEN 0 WHEN 1 THEN pi() / 2 WHEN 2 THEN -pi() / 2 ELSE -pi() END) + pi() / 18 * {k}) AS y FROM f" for k in range(10))
_OUT = "(e.x2 - e.x1) * (v.y - e.y1) - (e.y2 - e.y1) * (v.x - e.x1)"


@query(f"""
WITH f AS ({_FIXES}), v AS ({_ARC} UNION ALL SELECT ord, q, storm, 10 AS k, x, y FROM f),
e AS (SELECT a.ord, a.q, a.storm, a.k, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM v a JOIN v b ON a.ord = b.ord AND b.k = (a.k + 1) % 11),
n AS (SELECT ord, lead(ord) OVER (PARTITION BY storm, q ORDER BY ord) AS other, storm, q FROM f),
two AS (SELECT ord AS one, other, ord AS pair, storm, q FROM n WHERE other IS NOT NULL UNION ALL SELECT other, ord, ord, storm, q FROM n WHERE other IS NOT NULL),
beyond AS (SELECT DISTINCT pair FROM (SELECT b.pair, b.one, e.k FROM two b JOIN e ON e.ord = b.one JOIN v ON v.ord = b.other GROUP BY ALL HAVING max({_OUT}) <= 0)),
hp AS (SELECT DISTINCT b.pair, b.storm, b.q, v.x, v.y FROM two b JOIN v ON v.ord = b.one WHERE b.pair IN (SELECT pair FROM beyond)),
he AS (SELECT a.pair, a.storm, a.q, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM hp a JOIN hp b ON a.pair = b.pair AND (a.x <> b.x OR a.y <> b.y) JOIN hp c ON c.pair = a.pair
  GROUP BY ALL HAVING min((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x)) >= -1e-7),
p AS (SELECT DISTINCT (p_partkey * 6007 % 50)::INT AS row, (p_partkey * 3001 % 53)::INT AS col FROM part), c AS (SELECT row, col, col * 20 + 10.3 AS x, row * 20 + 10.7 AS y FROM p),
inq AS (SELECT e.storm, e.q, c.row, c.col, e.ord FROM c JOIN e ON TRUE GROUP BY ALL HAVING min((e.x2 - e.x1) * (c.y - e.y1) - (e.y2 - e.y1) * (c.x - e.x1)) > 0),
inh AS (SELECT he.storm, he.q, c.row, c.col, he.pair FROM c JOIN he ON TRUE GROUP BY ALL HAVING min((he.x2 - he.x1) * (c.y - he.y1) - (he.y2 - he.y1) * (c.x - he.x1)) > 0)
SELECT DISTINCT storm, q::INT AS quadrant, row, col FROM (SELECT storm, q, row, col FROM inq UNION ALL SELECT storm, q, row, col FROM inh)
""".replace("GROUP BY ALL HAVING min((e.x2", "GROUP BY e.storm, e.q, c.row, c.col, e.ord HAVING min((e.x2").replace("GROUP BY ALL HAVING min((he.x2", "GROUP BY he.storm, he.q, c.row, c.col, he.pair HAVING min((he.x2").replace("GROUP BY ALL HAVING max(", "GROUP BY b.pair, b.one, e.k HAVING max(").replace("GROUP BY ALL HAVING min((b.x", "GROUP BY a.pair, a.storm, a.q, a.x, a.y, b.x, b.y HAVING min((b.x"))
def storm_swath_cells(t: Tables):
    """Cells that each storm's quadrant reaches; suppliers stand for fixes, nations for storms."""
    k = F.col("s_suppkey")
    names = F.element_at(F.array(*map(F.lit, Y.QUADRANTS)), (k % 4 + 1).cast("int"))
    fixes = t.supplier.select(F.col("s_nationkey").alias("storm"), names.alias("quadrant"), F.lit(34).alias("wind"), k.alias("order"), (k * 3001 % 997).cast("double").alias("x"), (k * 6007 % 991).cast("double").alias("y"), (k * 37 % 160 + 40).cast("double").alias("radius"))
    rings = Y.swaths(fixes).withColumn("poly_id", F.monotonically_increasing_id())
    from ..operators.lineage import cut

    rings = cut(rings)
    p = F.col("p_partkey")
    places = t.part.select((p * 6007 % 50).cast("int").alias("row"), (p * 3001 % 53).cast("int").alias("col")).distinct().withColumn("x", F.col("col") * 20 + F.lit(10.3)).withColumn("y", F.col("row") * 20 + F.lit(10.7))
    held = Y.within(places, rings.select("poly_id", "ring"), 200.0).join(rings.select("poly_id", "storm", "quadrant"), "poly_id")
    number = F.array_position(F.array(*map(F.lit, Y.QUADRANTS)), F.col("quadrant")) - 1
    return held.select("storm", number.cast("int").alias("quadrant"), "row", "col").distinct()


def _trained(t: Tables):
    price = F.col("l_extendedprice") / 1000
    rows = t.lineitem.select(
        F.concat("l_returnflag", "l_linestatus").alias("tile"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), (F.col("l_orderkey") % 3).cast("int").alias("fold"),
        F.col("l_quantity").cast("double").alias("quantity"), F.col("l_discount").cast("double").alias("discount"), F.col("l_tax").cast("double").alias("tax"), price.cast("double").alias("target"),
    )
    how = B.Growth(depth=3, rate=0.5, rounds=4, default_rounds=3, patience=2, bins=16)
    return B.trained(rows, "tile", "id", ["quantity", "discount", "tax"], "target", "fold", refits=2, how=how)


@query()
def boosted_tiles_fit(t: Tables):
    """Rounds and errors of every flag and status's trees over all its lines, with the mean gain of each feature."""
    checks, gains, _, fits = _trained(t)
    fit = fits.groupBy("tile").agg(F.avg("rmse").alias("fit_rmse"), F.avg("r2").alias("fit_r2"))
    gain = gains.groupBy("tile").pivot("feature", ["quantity", "discount", "tax"]).agg(F.avg("gain"))
    return checks.join(fit, "tile").join(gain, "tile", "left")


@query()
def boosted_tiles_predictions(t: Tables):
    """Mean and spread over the refits of every line's prediction."""
    return _trained(t)[2]
