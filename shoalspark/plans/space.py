"""Spatial and model queries; points are orders on a plane, and the first components of embeddings."""

from pyspark.sql import functions as F

from ..operators import models as M
from ..operators import selection as Q
from ..operators import spatial as P
from ..sqlpair import Tables, query

POINTS = "SELECT o_orderkey AS id, (o_orderkey * 7919 % 10007)::DOUBLE AS x, (o_custkey * 104729 % 10009)::DOUBLE AS y FROM orders"
RING = [(1000.0, 1000.0), (8000.0, 2000.0), (7000.0, 8000.0), (4000.0, 4000.0), (2000.0, 9000.0)]


def points(t: Tables):
    return t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") * 7919 % 10007).cast("double").alias("x"), (F.col("o_custkey") * 104729 % 10009).cast("double").alias("y"))


@query(f"WITH p AS ({POINTS}) SELECT a.id, count(*) - 1 AS neighbours, sum(b.id % 10)::BIGINT AS weight FROM p a JOIN p b ON (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 150.0 ** 2 GROUP BY a.id")
def neighbourhood_sum(t: Tables):
    near = P.neighbourhood(points(t).withColumn("weight", F.col("id") % 10), 150.0)
    return near.select("id", (F.col("n") - 1).alias("neighbours"), F.col("total").alias("weight"))


@query(f"""
WITH p AS ({POINTS}), b AS (SELECT p_partkey AS id, (p_partkey * 6007 % 10007)::DOUBLE AS x, (p_partkey * 3001 % 10009)::DOUBLE AS y FROM part),
n AS (SELECT p.id, b.id AS near, sqrt((p.x - b.x) ** 2 + (p.y - b.y) ** 2) AS d FROM p JOIN b ON (p.x - b.x) ** 2 + (p.y - b.y) ** 2 <= 100.0 ** 2),
m AS (SELECT id, near, d, row_number() OVER (PARTITION BY id ORDER BY d, near) AS k FROM n)
SELECT p.id, near, round(d, 6) AS distance FROM p LEFT JOIN (SELECT * FROM m WHERE k = 1) m USING (id)
""")
def nearest_within(t: Tables):
    k = F.col("p_partkey")
    sites = t.part.select(k.alias("b_id"), (k * 6007 % 10007).cast("double").alias("x"), (k * 3001 % 10009).cast("double").alias("y"))
    n = P.nearest(points(t).withColumnRenamed("id", "a_id"), sites, 100.0)
    return n.select(F.col("a_id").alias("id"), F.col("b_id").alias("near"), F.round("distance", 6).alias("distance"))


@query(f"""
WITH p AS ({POINTS}),
n AS (SELECT a.id, b.id AS near, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM p a JOIN p b ON a.id <> b.id AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 100.0 ** 2),
m AS (SELECT id, near, d, row_number() OVER (PARTITION BY id ORDER BY d, near) AS k FROM n)
SELECT p.id, near, round(d, 6) AS distance FROM p LEFT JOIN (SELECT * FROM m WHERE k = 1) m USING (id)
""")
def nearest_other_within(t: Tables):
    p = points(t)
    n = P.nearest(p.withColumnRenamed("id", "a_id"), p.withColumnRenamed("id", "b_id"), 100.0, others=True)
    return n.select(F.col("a_id").alias("id"), F.col("b_id").alias("near"), F.round("distance", 6).alias("distance"))


_EDGES = " + ".join(f"CASE WHEN ({y1} > y) <> ({y2} > y) AND x < ({x2} - {x1}) * (y - {y1}) / ({y2} - {y1})::DOUBLE + {x1} THEN 1 ELSE 0 END" for (x1, y1), (x2, y2) in zip(RING, RING[1:] + RING[:1], strict=True))


@query(f"SELECT id FROM ({POINTS}) WHERE ({_EDGES}) % 2 = 1")
def point_in_polygon(t: Tables):
    return points(t).where(P.inside(F.col("x"), F.col("y"), RING)).select("id")


@query("""
WITH e AS (SELECT vec_id, label, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, embedding[3]::DOUBLE AS c FROM embeddings),
n AS (SELECT q.vec_id, p.a AS value, sqrt((q.a - p.a) ** 2 + (q.b - p.b) ** 2 + (q.c - p.c) ** 2) AS d, row_number() OVER (PARTITION BY q.vec_id ORDER BY sqrt((q.a - p.a) ** 2 + (q.b - p.b) ** 2 + (q.c - p.c) ** 2), p.vec_id) AS k
  FROM e q JOIN e p ON q.label = p.label AND q.vec_id <> p.vec_id)
SELECT vec_id, round(sum(value / (d + 1e-6)) / sum(1 / (d + 1e-6)), 6) AS estimate FROM n WHERE k <= 5 GROUP BY vec_id
""")
def knn_inverse_distance(t: Tables):
    e = t.embeddings.select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate("abc")])
    near = P.nearest_neighbours(e.withColumnRenamed("vec_id", "q_id"), e.withColumnRenamed("vec_id", "p_id").withColumn("value", F.col("a")), 5, ["label"], list("abc"))
    return near.groupBy(F.col("q_id").alias("vec_id")).agg(F.round(F.sum(F.col("value") * F.col("w")) / F.sum("w"), 6).alias("estimate"))


@query("SELECT p_partkey AS t_id, round(avg(s_acctbal), 7) AS mean, count(*) AS n FROM part JOIN supplier ON abs(p_retailprice - (s_suppkey * 37 % 2000)) <= 60 GROUP BY p_partkey")
def band_join_mean(t: Tables):
    b = P.band_mean(t.part.select(F.col("p_partkey").alias("t_id"), F.col("p_retailprice").alias("x")), t.supplier.select((F.col("s_suppkey") * 37 % 2000).cast("double").alias("x"), F.col("s_acctbal").alias("value")), 60.0)
    return b.withColumn("mean", F.round("mean", 7))


@query(f"SELECT floor(x / 1000)::INT AS zone, median(y) AS mid, count(*) AS n FROM ({POINTS}) GROUP BY 1")
def zonal_median(t: Tables):
    zoned = points(t).select(F.floor(F.col("x") / 1000).cast("int").alias("zone"), "y")
    return Q.group_medians(zoned, ["zone"], "y").withColumnRenamed("median", "mid").join(zoned.groupBy("zone").agg(F.count(F.lit(1)).alias("n")), "zone")


@query(f"SELECT (floor(x / 500) * 500)::DOUBLE AS gx, (floor(y / 500) * 500)::DOUBLE AS gy, count(*) AS n, sum(id % 7)::BIGINT AS weight, round(avg(x), 6) AS mean_x FROM ({POINTS}) GROUP BY 1, 2")
def point_density(t: Tables):
    g = lambda c: (F.floor(F.col(c) / 500) * 500).cast("double")
    return points(t).groupBy(g("x").alias("gx"), g("y").alias("gy")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("id") % 7).alias("weight"), F.round(F.avg("x"), 6).alias("mean_x"))


@query(f"""
WITH b AS (SELECT id % 3 AS tile, CASE WHEN x % 200 <> 0 AND y % 200 <> 0 THEN floor(x / 200)::INT || '_' || floor(y / 200)::INT END AS block FROM ({POINTS})),
s AS (SELECT tile, block, count(*) AS rows FROM b WHERE block IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY rows DESC, block) - 1 AS pos, least(5, count(*) OVER (PARTITION BY tile)) AS k FROM s)
SELECT tile, block, rows, (CASE WHEN (pos // k) % 2 = 0 THEN pos % k ELSE k - 1 - pos % k END)::INT AS fold FROM r
""")
def cv_block_folds(t: Tables):
    rows = points(t).select((F.col("id") % 3).alias("tile"), M.block(F.col("x"), F.col("y"), 0.0, 0.0, 200.0).alias("block"))
    return M.folds(rows, "tile", "block", 5)


@query("SELECT l_returnflag AS g, round(sqrt(avg((l_tax - l_discount) ** 2)), 8) AS rmse, round(avg(abs(l_tax - l_discount)), 8) AS mae, round(1 - sum((l_tax - l_discount) ** 2) / (var_pop(l_tax) * count(*)), 6) AS r2 FROM lineitem GROUP BY 1")
def metrics_rmse_mae_r2(t: Tables):
    m = M.metrics(t.lineitem.withColumn("g", F.col("l_returnflag")), "g", "l_tax", "l_discount")
    return m.select("g", F.round("rmse", 8).alias("rmse"), F.round("mae", 8).alias("mae"), F.round("r2", 6).alias("r2"))


@query("""
WITH v AS (SELECT 'size' AS predictor, p_size::DOUBLE AS v, p_retailprice AS t FROM part UNION ALL SELECT 'key', p_partkey, p_retailprice FROM part), s AS (SELECT predictor, min(v) AS lo, max(v) AS hi FROM v GROUP BY ALL)
SELECT predictor, greatest(ceil((v - lo) * 10 / (hi - lo)) - 1, 0)::INT AS bin, round(avg(t), 6) AS mean, min(t) AS least, max(t) AS largest FROM v JOIN s USING (predictor) GROUP BY ALL
""")
def binned_min_mean_max(t: Tables):
    tall = t.part.select("p_retailprice", F.col("p_size").cast("double").alias("size"), F.col("p_partkey").cast("double").alias("key")).unpivot(["p_retailprice"], ["size", "key"], "predictor", "v")
    return M.binned(tall, "predictor", "v", "p_retailprice", 10).withColumn("mean", F.round("mean", 6))


@query("SELECT event_type, round(corr(value, user_id), 6) AS r, round(avg(value - user_id), 6) AS diff, count(*) FILTER (abs(value - user_id) < 10) AS matches FROM events GROUP BY event_type")
def prediction_agreement(t: Tables):
    v, u = F.col("value"), F.col("user_id")
    return t.events.groupBy("event_type").agg(F.round(F.corr("value", "user_id"), 6).alias("r"), F.round(F.avg(v - u), 6).alias("diff"), F.count_if(F.abs(v - u) < 10).alias("matches"))


@query("SELECT event_id, round((value - avg(value) OVER w) / stddev_pop(value) OVER w, 6) AS z FROM events WINDOW w AS (PARTITION BY event_type)")
def standardised(t: Tables):
    s = t.events.groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    return t.events.join(s, "event_type").select("event_id", F.round((F.col("value") - F.col("m")) / F.col("s"), 6).alias("z"))


@query()
def boosted_trees_dependence(t: Tables):
    rows = t.lineitem.select(F.col("l_quantity"), F.col("l_discount"), F.col("l_linenumber").cast("double").alias("line"), F.col("l_extendedprice"))
    features = ["l_quantity", "l_discount", "line"]
    return M.partial_dependence(M.boosted(rows, features, "l_extendedprice", rounds=5), rows, features, "l_quantity")
