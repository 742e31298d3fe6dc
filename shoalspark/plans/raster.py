"""Raster queries over a 64 by 64 grid of mean quantities."""

from pyspark.sql import functions as F

from ..operators import grid as G
from ..operators.lineage import cut
from ..sqlpair import Tables, query

CELLS = "SELECT (l_orderkey % 64)::INT AS r, (l_partkey % 64)::INT AS c, avg(l_quantity) AS z FROM lineitem GROUP BY 1, 2"
YEARS = "SELECT (l_orderkey % 64)::INT AS r, (l_partkey % 64)::INT AS c, year(l_shipdate) AS layer, avg(l_quantity) AS z FROM lineitem GROUP BY 1, 2, 3"


def cells(t: Tables):
    return t.lineitem.groupBy((F.col("l_orderkey") % 64).cast("int").alias("row"), (F.col("l_partkey") % 64).cast("int").alias("col")).agg(F.avg("l_quantity").alias("z"))


def years(t: Tables):
    return t.lineitem.groupBy((F.col("l_orderkey") % 64).cast("int").alias("row"), (F.col("l_partkey") % 64).cast("int").alias("col"), F.year("l_shipdate").alias("layer")).agg(F.avg("l_quantity").alias("z"))


def _rounded(df, *names, n=6):
    return df.withColumns({k: F.round(k, n) for k in names})


@query(f"""
WITH g AS ({CELLS}), j AS (SELECT g.r, g.c, g.z, n.z AS n, s.z AS s, w.z AS w, e.z AS e FROM g LEFT JOIN g n ON n.r = g.r - 1 AND n.c = g.c LEFT JOIN g s ON s.r = g.r + 1 AND s.c = g.c
  LEFT JOIN g w ON w.r = g.r AND w.c = g.c - 1 LEFT JOIN g e ON e.r = g.r AND e.c = g.c + 1)
SELECT r AS row, c AS col, round(degrees(atan(sqrt(pow(coalesce((s - n) / 16, (s - z) / 8, (z - n) / 8), 2) + pow(coalesce((e - w) / 16, (e - z) / 8, (z - w) / 8), 2)))), 6) AS slope FROM j
""")
def slope_stencil(t: Tables):
    return _rounded(G.slope(cells(t), 8.0), "slope")


_AROUND = f"WITH g AS ({CELLS}), j AS (SELECT a.r, a.c, a.z, b.z AS v, a.r = b.r AND a.c = b.c AS own FROM g a JOIN g b ON b.r BETWEEN a.r - 1 AND a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1)"


@query(f"{_AROUND} SELECT r AS row, c AS col, round(avg(abs(v - z)) FILTER (NOT own), 6) AS tri FROM j GROUP BY r, c")
def ruggedness_stencil(t: Tables):
    return _rounded(G.ruggedness(cells(t)), "tri")


@query(f"{_AROUND} SELECT r AS row, c AS col, round(max(v) - min(v), 6) AS roughness FROM j GROUP BY r, c")
def roughness_stencil(t: Tables):
    return _rounded(G.roughness(cells(t)), "roughness")


@query(f"WITH g AS ({CELLS}) SELECT a.r AS row, a.c AS col, round(avg(b.z), 6) AS mean FROM g a JOIN g b ON b.r BETWEEN a.r - 2 AND a.r + 2 AND b.c BETWEEN a.c - 2 AND a.c + 2 GROUP BY a.r, a.c")
def box_mean(t: Tables):
    return _rounded(G.box_mean(cells(t), 2), "mean")


_FILLED = "".join(
    f""", a{k} AS (SELECT g.r, g.c, coalesce(g.z, (SELECT avg(b.z) FROM a{k - 1} b WHERE b.r BETWEEN g.r - 2 AND g.r + 2 AND b.c BETWEEN g.c - 2 AND g.c + 2)) AS z FROM a{k - 1} g)"""
    for k in range(1, 6)
)


@query(f"WITH a0 AS (SELECT r, c, CASE WHEN r % 20 < 4 OR c % 30 < 3 THEN z END AS z FROM ({CELLS})){_FILLED} SELECT r AS row, c AS col, round(z, 6) AS z FROM a5")
def focal_fill(t: Tables):
    holes = cells(t).withColumn("z", F.when((F.col("row") % 20 < 4) | (F.col("col") % 30 < 3), F.col("z")))
    return _rounded(G.focal_fill(holes, 2, 5, cut), "z")


@query(f"WITH g AS ({CELLS}) SELECT a.r AS row, a.c AS col, round(a.z - avg(b.z), 6) AS bpi FROM g a LEFT JOIN g b ON (b.r - a.r) ** 2 + (b.c - a.c) ** 2 <= 16 AND (b.r - a.r) ** 2 + (b.c - a.c) ** 2 > 1 GROUP BY a.r, a.c, a.z")
def position_index_fine(t: Tables):
    return _rounded(G.position_index(cells(t), 1, 4), "bpi")


@query(f"WITH g AS ({CELLS}) SELECT a.r AS row, a.c AS col, round(a.z - avg(b.z), 5) AS bpi FROM g a LEFT JOIN g b ON (b.r - a.r) ** 2 + (b.c - a.c) ** 2 <= 900 AND (b.r - a.r) ** 2 + (b.c - a.c) ** 2 > 100 GROUP BY a.r, a.c, a.z")
def position_index_broad(t: Tables):
    return _rounded(G.position_index_blocks(cells(t), 10, 30, block=32), "bpi", n=5)


@query(f"WITH g AS ({CELLS}) SELECT r // 4 AS row, c // 4 AS col, max(z) AS z FROM g GROUP BY ALL")
def block_max(t: Tables):
    return G.coarser(cells(t), 4, "max")


@query(f"WITH g AS ({CELLS}) SELECT r // 2 AS row, c // 2 AS col, round(avg(z), 6) AS z FROM g GROUP BY ALL")
def overview_avg(t: Tables):
    return _rounded(G.coarser(cells(t), 2), "z")


for _rule, _sql in {"max": "max(z)", "min": "min(z)", "first": "arg_min(z, layer)", "last": "arg_max(z, layer)"}.items():

    def _mosaic(t: Tables, rule=_rule):
        return G.mosaic(years(t), rule)

    _mosaic.__name__ = f"mosaic_{_rule}"
    query(f"SELECT r AS row, c AS col, {_sql} AS z FROM ({YEARS}) GROUP BY ALL")(_mosaic)


@query(f"SELECT r AS row, c AS col, count(DISTINCT layer) AS coverage FROM ({YEARS}) GROUP BY ALL")
def coverage_count(t: Tables):
    return years(t).where("z is not null").groupBy("row", "col").agg(F.countDistinct("layer").alias("coverage"))


@query(f"WITH y AS ({YEARS}), n AS (SELECT layer, count(*) AS n FROM y GROUP BY layer) SELECT a.layer AS y0, b.layer AS y1, count(*) AS cells, round(100 * count(*) / least(max(m.n), max(k.n)), 4) AS pct FROM y a JOIN y b ON a.r = b.r AND a.c = b.c AND a.layer < b.layer JOIN n m ON m.layer = a.layer JOIN n k ON k.layer = b.layer GROUP BY ALL")
def pairwise_overlap(t: Tables):
    y = years(t).select("row", "col", "layer")
    n = y.groupBy("layer").agg(F.count(F.lit(1)).alias("n"))
    pairs = y.withColumnRenamed("layer", "y0").join(y.withColumnRenamed("layer", "y1"), ["row", "col"]).where("y0 < y1").groupBy("y0", "y1").agg(F.count(F.lit(1)).alias("cells"))
    both = pairs.join(n.select(F.col("layer").alias("y0"), F.col("n").alias("n0")), "y0").join(n.select(F.col("layer").alias("y1"), F.col("n").alias("n1")), "y1")
    return both.select("y0", "y1", "cells", F.round(100 * F.col("cells") / F.least("n0", "n1"), 4).alias("pct"))


@query(f"SELECT r AS row, c AS col, CASE WHEN bool_or(z > 25) AND bool_or(layer < 1996) THEN 2 WHEN bool_or(z > 25) THEN 1 END AS mask FROM ({YEARS}) GROUP BY ALL")
def mask_or_merge(t: Tables):
    g = years(t).groupBy("row", "col").agg(F.bool_or(F.col("z") > 25).alias("a"), F.bool_or(F.col("layer") < 1996).alias("b"))
    return g.select("row", "col", F.when(F.col("a") & F.col("b"), 2).when(F.col("a"), 1).alias("mask"))


@query(f"WITH g AS ({CELLS}) SELECT round(quantile_cont(z, 0.15), 6) AS low, round(quantile_cont(z, 0.85), 6) AS high FROM g")
def quantile_breaks(t: Tables):
    q = G.quantiles(cells(t), [0.15, 0.85], cut)
    of = lambda share: F.round(F.max(F.when(F.col("share") == share, F.col("value"))), 6)
    return q.agg(of(0.15).alias("low"), of(0.85).alias("high"))


@query(f"""
SELECT r AS row, c AS col, CASE WHEN b <= -1 AND f <= -1 THEN 1 WHEN b <= -1 AND f >= 1 THEN 2 WHEN b <= -1 THEN 3 WHEN b >= 1 AND f <= -1 THEN 4 WHEN b >= 1 AND f >= 1 THEN 5 WHEN b >= 1 THEN 6 WHEN s >= 3 THEN 7 ELSE 8 END AS class
FROM (SELECT r, c, z - 25 AS b, (r % 5) - 2 AS f, c % 6 AS s FROM ({CELLS}))
""")
def rule_classify(t: Tables):
    k = lambda a, b: (F.lit(a), F.lit(b))
    return cells(t).select("row", "col", G.terrain_class(F.col("z") - 25, F.col("row") % 5 - 2, F.col("col") % 6, k(-1, 1), k(-1, 1), F.lit(3)).alias("class"))


@query(f"WITH g AS ({CELLS}) SELECT round(count(*) FILTER (u < 0) / count(*), 6) AS below, round(count(*) FILTER (u > 0 AND u <= 5) / count(*), 6) AS small, round(count(*) FILTER (u > 5) / count(*), 6) AS large FROM (SELECT z - 25 AS u FROM g)")
def clearance_histogram(t: Tables):
    u = cells(t).select((F.col("z") - 25).alias("u"))
    share = lambda c: F.round(F.count_if(c) / F.count(F.lit(1)), 6)
    return u.agg(share(F.col("u") < 0).alias("below"), share((F.col("u") > 0) & (F.col("u") <= 5)).alias("small"), share(F.col("u") > 5).alias("large"))


@query(f"WITH g AS ({CELLS}), k AS (SELECT r // 8 AS r, c // 8 AS c, max(z) AS coarse FROM g GROUP BY ALL) SELECT g.r AS row, g.c AS col, coarse FROM g JOIN k ON k.r = g.r // 8 AND k.c = g.c // 8")
def align_nearest(t: Tables):
    k = G.coarser(cells(t), 8, "max").select(F.col("row").alias("kr"), F.col("col").alias("kc"), F.col("z").alias("coarse"))
    return cells(t).join(k, (F.floor(F.col("row") / 8) == F.col("kr")) & (F.floor(F.col("col") / 8) == F.col("kc"))).select("row", "col", "coarse")


@query(f"SELECT storm, r AS row, c AS col, max(layer) AS wind FROM (SELECT *, (r + c) % 7 AS storm FROM ({YEARS})) GROUP BY ALL")
def storm_rings(t: Tables):
    return years(t).groupBy(((F.col("row") + F.col("col")) % 7).alias("storm"), "row", "col").agg(F.max("layer").alias("wind"))


@query(f"SELECT r AS row, c AS col, CASE WHEN sum(z) <= 200 THEN round(sum(z), 6) END AS density FROM ({YEARS}) GROUP BY ALL")
def density_cutoff(t: Tables):
    return years(t).groupBy("row", "col").agg(F.sum("z").alias("s")).select("row", "col", F.when(F.col("s") <= 200, F.round("s", 6)).alias("density"))
