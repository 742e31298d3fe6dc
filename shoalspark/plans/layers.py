"""Queries over terrain forms, drainage, aligned layers, boxes, jobs, names and priorities."""

from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions import texts as X
from ..operators import grid as G
from ..operators import spatial as P
from ..operators import terrain as R
from ..operators.lineage import cut
from ..sqlpair import Tables, query
from .raster import CELLS, YEARS, _rounded, cells, years

_NINE = f"""g AS ({CELLS}), j AS (SELECT a.r, a.c, b.r - a.r AS i, b.c - a.c AS k, b.z FROM g a JOIN g b ON b.r BETWEEN a.r - 1 AND a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1),
n AS (SELECT r, c, {", ".join(f"max(z) FILTER (i = {i} AND k = {j}) AS {name}" for (i, j), name in R.NAMES.items())} FROM j GROUP BY r, c HAVING count(*) = 9)"""


@query(f"""
WITH {_NINE}, d AS (SELECT r, c, ((ne + 2 * e + se) - (nw + 2 * w + sw)) / 64 AS x, ((sw + 2 * s + se) - (nw + 2 * n + ne)) / 64 AS y FROM n), a AS (SELECT *, 90 - degrees(atan2(y, -x)) AS a FROM d)
SELECT r AS row, c AS col, round(CASE WHEN x = 0 AND y = 0 THEN -1 WHEN a < 0 THEN a + 360 ELSE a END, 6) AS aspect FROM a
""")
def aspect_stencil(t: Tables):
    return _rounded(R.aspect(cells(t), 8.0), "aspect")


@query(f"""
WITH {_NINE}, d AS (SELECT r, c, ((w + e) / 2 - z) / 64 AS d, ((n + s) / 2 - z) / 64 AS g, (ne + sw - nw - se) / 256 AS f, (e - w) / 16 AS p, (n - s) / 16 AS q FROM n)
SELECT r AS row, c AS col, round(CASE WHEN p = 0 AND q = 0 THEN 0 ELSE -2 * (d * p * p + g * q * q + f * p * q) / (p * p + q * q) END, 6) AS profile,
  round(CASE WHEN p = 0 AND q = 0 THEN 0 ELSE 2 * (d * q * q + g * p * p - f * p * q) / (p * p + q * q) END, 6) AS plan, round(-2 * (d + g), 6) AS total FROM d
""")
def curvature_stencil(t: Tables):
    return _rounded(R.curvature(cells(t), 8.0), "profile", "plan", "total")


_FLOW = f"""g AS ({CELLS}), o AS (SELECT a.r, a.c, b.r AS tr, b.c AS tc, (a.z - b.z) / sqrt(((b.r - a.r) ** 2 + (b.c - a.c) ** 2)::DOUBLE) AS d
  FROM g a JOIN g b ON b.r BETWEEN a.r - 1 AND a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1 AND b.z < a.z),
b AS (SELECT r, c, tr, tc FROM o QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY d DESC, tr, tc) = 1), f AS (SELECT g.r, g.c, tr, tc FROM g LEFT JOIN b USING (r, c))"""


@query(f"WITH {_FLOW} SELECT r AS row, c AS col, tr AS to_row, tc AS to_col FROM f")
def flow_direction(t: Tables):
    return R.flow_direction(cells(t))


@query(f"""
WITH RECURSIVE {_FLOW}, walk AS (SELECT r, c, r AS ar, c AS ac FROM f UNION ALL SELECT w.r, w.c, tr, tc FROM walk w JOIN f ON f.r = ar AND f.c = ac WHERE tr IS NOT NULL)
SELECT ar AS row, ac AS col, count(*) AS cells FROM walk GROUP BY ALL
""")
def flow_accumulation(t: Tables):
    return R.flow_accumulation(R.flow_direction(cells(t)), cut)


@query(f"""
WITH g AS ({CELLS}), k AS (SELECT r // 8 AS kr, c // 8 AS kc, avg(z) AS z FROM g GROUP BY ALL), p AS (SELECT r, c, (r + 0.5::DOUBLE) / 8 - 0.5 AS y, (c + 0.5::DOUBLE) / 8 - 0.5 AS x FROM g),
w AS (SELECT r, c, k.z, (1 - abs(y - kr)) * (1 - abs(x - kc)) AS w FROM p JOIN k ON abs(y - kr) < 1 AND abs(x - kc) < 1)
SELECT r AS row, c AS col, round(sum(w * z) / sum(w), 6) AS z FROM w GROUP BY ALL
""")
def align_bilinear(t: Tables):
    return _rounded(R.bilinear(G.coarser(cells(t), 8), cells(t).select("row", "col"), 8), "z")


@query(f"""
SELECT round(1000 + (c + 0.5) * 8, 3)::DOUBLE AS x, round(5000 - (r + 0.5) * 8, 3)::DOUBLE AS y, max(z) FILTER (layer = 1995) AS v_1995, max(z) FILTER (layer = 1996) AS v_1996, max(z) FILTER (layer = 1997) AS v_1997
FROM ({YEARS}) WHERE layer IN (1995, 1996, 1997) GROUP BY r, c
""")
def aligned_layers_wide(t: Tables):
    chosen = years(t).where(F.col("layer").isin(1995, 1996, 1997) & F.col("z").isNotNull())
    wide = chosen.groupBy("row", "col").pivot("layer", [1995, 1996, 1997]).agg(F.first("z"))
    place = [F.round(1000 + (F.col("col") + 0.5) * 8, 3).alias("x"), F.round(5000 - (F.col("row") + 0.5) * 8, 3).alias("y")]
    return wide.select(*place, *[F.col(f"`{y}`").alias(f"v_{y}") for y in (1995, 1996, 1997)])


@query(f"""
SELECT r AS row, c AS col, max(nullif(v, 0)) AS most, round(avg(nullif(v, 0)), 6) AS mean, round(sum(v), 6) AS total FROM (SELECT r, c, CASE WHEN layer % 3 = 0 THEN 0 ELSE z END AS v FROM ({YEARS})) GROUP BY ALL
""")
def cell_statistics(t: Tables):
    v = years(t).select("row", "col", F.when(F.col("layer") % 3 == 0, 0.0).otherwise(F.col("z")).alias("v"))
    some = F.nullif("v", F.lit(0.0))
    return v.groupBy("row", "col").agg(F.max(some).alias("most"), F.round(F.avg(some), 6).alias("mean"), F.round(F.sum("v"), 6).alias("total"))


@query(f"""
WITH y AS ({YEARS}), d AS (SELECT a.r, a.c, b.z - a.z AS actual, (b.z - a.z) * (1 + (a.layer % 2)) AS predicted FROM y a JOIN y b ON a.r = b.r AND a.c = b.c AND b.layer = a.layer + 1)
SELECT r AS row, c AS col, round(avg(actual), 6) + 0 AS actual, round(avg(predicted), 6) + 0 AS predicted, count(*) AS pairs FROM d GROUP BY ALL
""")
def change_over_pairs(t: Tables):
    a = years(t).select("row", "col", F.col("layer").alias("first"), F.col("z").alias("z0"))
    b = years(t).select("row", "col", (F.col("layer") - 1).alias("first"), F.col("z").alias("z1"))
    d = a.join(b, ["row", "col", "first"]).withColumn("d", F.col("z1") - F.col("z0"))
    mean = lambda x: F.round(F.avg(x), 6) + 0.0  # noqa: E731  (no negative zero)
    return d.groupBy("row", "col").agg(mean("d").alias("actual"), mean(F.col("d") * (1 + F.col("first") % 2)).alias("predicted"), F.count(F.lit(1)).alias("pairs"))


_BOXES = "SELECT c_custkey AS a_id, c_acctbal AS x0, c_custkey % 997 * 10 AS y0, c_acctbal + c_custkey % 30 AS x1, c_custkey % 997 * 10 + c_custkey % 70 AS y1 FROM customer"
_OTHERS = "SELECT s_suppkey AS b_id, s_acctbal AS x0, s_suppkey % 89 * 100 AS y0, s_acctbal + 200 AS x1, s_suppkey % 89 * 100 + 300 AS y1 FROM supplier"


@query(f"SELECT a_id, b_id FROM ({_BOXES}) a JOIN ({_OTHERS}) b ON greatest(a.x0, b.x0) <= least(a.x1, b.x1) AND greatest(a.y0, b.y0) <= least(a.y1, b.y1)")
def boxes_that_meet(t: Tables):
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    y, v = k % 997 * 10, s % 89 * 100
    a = t.customer.select(k.alias("a_id"), F.col("c_acctbal").alias("x0"), y.alias("y0"), (F.col("c_acctbal") + k % 30).alias("x1"), (y + k % 70).alias("y1"))
    b = t.supplier.select(s.alias("b_id"), F.col("s_acctbal").alias("x0"), v.alias("y0"), (F.col("s_acctbal") + 200).alias("x1"), (v + 300).alias("y1"))
    return P.box_pairs(a, b, 150.0)


_JOBS = "SELECT l_orderkey AS job, year(l_shipdate) AS yr, l_returnflag AS kind, l_suppkey AS place FROM lineitem WHERE l_returnflag IN ('A', 'R')"


@query(f"""
SELECT DISTINCT job, yr, kind, place FROM ({_JOBS}) JOIN orders ON o_orderkey = job AND year(o_orderdate) = yr WHERE NOT (coalesce(o_custkey % 3, 0) = 0 AND coalesce(o_orderkey % 2, 0) = 0)
""")
def job_places(t: Tables):
    jobs = t.orders.where(~((F.coalesce(F.col("o_custkey") % 3, F.lit(0)) == 0) & (F.coalesce(F.col("o_orderkey") % 2, F.lit(0)) == 0))).select(F.col("o_orderkey").alias("job"), F.year("o_orderdate").alias("yr"))
    places = t.lineitem.where(F.col("l_returnflag").isin("A", "R")).select(F.col("l_orderkey").alias("job"), F.year("l_shipdate").alias("yr"), F.col("l_returnflag").alias("kind"), F.col("l_suppkey").alias("place"))
    return places.join(jobs, ["job", "yr"]).select("job", "yr", "kind", "place").distinct()


@query("""
SELECT o_custkey, arg_max(o_orderkey, (pow(10, 8 - o_orderkey % 4) * (6 - (1 + o_orderkey % 5)) + year(o_orderdate), -o_orderkey)) AS pick FROM orders GROUP BY o_custkey
""")
def survey_priority(t: Tables):
    k = S.priority(F.col("o_orderkey") % 4, 4, 1 + F.col("o_orderkey") % 5, F.year("o_orderdate"))
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct(k, -F.col("o_orderkey"))).alias("pick"))


@query("""
WITH v AS (SELECT p_partkey, (p_size % 25)::DOUBLE AS storms, (p_size % 7) / 10.0::DOUBLE AS tide, CASE WHEN p_size % 4 > 0 THEN p_size % 13 END AS debris, p_partkey % 3 AS soft, CASE WHEN p_partkey % 10 > 0 THEN p_size END AS depth, (p_partkey % 6)::DOUBLE AS age FROM part),
b AS (SELECT *, CASE WHEN soft > 0 AND depth <= 40 THEN CASE WHEN storms <= 0 THEN 1 WHEN storms <= 4 THEN 2 WHEN storms <= 10 THEN 3 WHEN storms <= 20 THEN 4 ELSE 5 END ELSE 1 END AS s,
  CASE WHEN soft > 0 AND depth <= 20 THEN CASE WHEN tide * age < 0.1 THEN 1 WHEN tide * age < 0.2 THEN 2 WHEN tide * age < 0.5 THEN 3 WHEN tide * age < 1 THEN 4 ELSE 5 END ELSE 1 END AS t,
  CASE WHEN coalesce(debris, 0) <= 0 THEN 1 WHEN debris <= 1 THEN 2 WHEN debris <= 5 THEN 3 WHEN debris <= 10 THEN 4 ELSE 5 END AS d FROM v)
SELECT p_partkey, CASE WHEN depth IS NOT NULL THEN round((s + t + d - 3) * 0.022::DOUBLE / 3, 8) END AS coefficient FROM b
""")
def domain_coefficients(t: Tables):
    s, k = F.col("p_size"), F.col("p_partkey")
    c = S.domain_coefficient((s % 25).cast("double"), (s % 7) / F.lit(10.0), F.when(s % 4 > 0, s % 13), k % 3, F.when(k % 10 > 0, s), (k % 6).cast("double"))
    return t.part.select(k, F.round(c, 8).alias("coefficient"))


@query("""
WITH d AS (SELECT event_id, CASE WHEN event_id % 5 > 0 THEN value END AS d FROM events)
SELECT event_id, CASE WHEN d <= 10 THEN 5 WHEN d <= 25 THEN 4 WHEN d <= 50 THEN 3 ELSE 1 END AS ring FROM d
""")
def ring_bands(t: Tables):
    d = F.when(F.col("event_id") % 5 > 0, F.col("value"))
    return t.events.select("event_id", R.bands(d, [10, 25, 50], [5, 4, 3], 1).alias("ring"))


@query("""
WITH n AS (SELECT p_partkey, p_partkey::BIGINT * 7919 AS v FROM part)
SELECT p_partkey, string_agg(substr('BCDFGHJKLMNPQRST', (v // pow(16, k)::BIGINT % 16)::INT + 1, 1), '' ORDER BY k DESC) AS tile FROM n, range(0, 8) AS r(k) GROUP BY p_partkey
""")
def tile_names(t: Tables):
    last_digits = F.col("p_partkey") * 7919 % 16**8
    return t.part.select("p_partkey", X.in_base(last_digits, "BCDFGHJKLMNPQRST", 8).alias("tile"))


@query("""
WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'position approximate' WHEN p_partkey % 5 = 0 THEN '' ELSE 'code ' || (p_size % 14) END AS s FROM part), c AS (SELECT *, TRY_CAST(regexp_extract(s, '(\\d+)', 1) AS INT) AS code FROM s)
SELECT p_partkey, code, CASE WHEN s LIKE '%approx%' OR code BETWEEN 2 AND 9 THEN 3 WHEN code IS NULL OR code IN (1, 10, 11) THEN 1 ELSE 0 END AS weight FROM c
""")
def position_quality(t: Tables):
    k = F.col("p_partkey")
    s = F.when(k % 7 == 0, "position approximate").when(k % 5 == 0, "").otherwise(F.concat(F.lit("code "), (F.col("p_size") % 14).cast("string")))
    code = X.position_code(s)
    return t.part.select("p_partkey", code.alias("code"), X.quality_weight(code, s).alias("weight"))


@query("""
WITH s AS (SELECT o_orderkey, 'from ' || strftime(o_orderdate, '%Y') || CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '-%m') || ' to 1999-12' ELSE '' END AS s FROM orders)
SELECT o_orderkey, array_to_string(list_sort(list_distinct(CASE WHEN len(regexp_extract_all(s, '(?:18|19|20)\\d{2}-(?:0[1-9]|1[0-2])')) > 0 THEN regexp_extract_all(s, '(?:18|19|20)\\d{2}-(?:0[1-9]|1[0-2])') ELSE regexp_extract_all(s, '(?:18|19|20)\\d{2}') END)), ',') AS found FROM s
""")
def dates_in_text(t: Tables):
    d = F.col("o_orderdate")
    s = F.concat(F.lit("from "), F.date_format(d, "yyyy"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.date_format(d, "-MM"), F.lit(" to 1999-12"))).otherwise(""))
    return t.orders.select("o_orderkey", F.array_join(X.dates_in(s), ",").alias("found"))


@query("""
SELECT l_suppkey AS tile, count(*) AS n FROM lineitem WHERE l_quantity > 2 AND l_tax IS NOT NULL GROUP BY l_suppkey HAVING count(*) >= 100 AND count(DISTINCT l_quantity) > 1
""")
def tiles_fit_for_training(t: Tables):
    rows = t.lineitem.select("l_suppkey", F.when(F.col("l_quantity") > 2, F.col("l_quantity")).alias("q"), "l_tax").dropna(subset=["q", "l_tax"])
    # More than one value is a question of the least and the largest, which needs no second shuffle.
    return rows.groupBy(F.col("l_suppkey").alias("tile")).agg(F.count(F.lit(1)).alias("n"), F.min("q").alias("lo"), F.max("q").alias("hi")).where("n >= 100 and lo < hi").select("tile", "n")
