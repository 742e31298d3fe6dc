"""Scoring queries: survey scores, decay, bins, desired and present scores, gaps and risk."""

from pyspark.sql import functions as F

from ..functions import scores as S
from ..sqlpair import Tables, query

DAYS = "date_diff('day', l_shipdate::DATE, DATE '2024-01-01')"
KEYS = ("l_orderkey", "l_linenumber")


def _days():
    return F.datediff(F.lit("2024-01-01").cast("date"), F.to_date("l_shipdate"))


@query(f"""
WITH c AS (SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, p.p_size, {DAYS} / 365.0::DOUBLE AS age, l_discount, l_tax, o.o_orderstatus
  FROM lineitem l JOIN part p ON l_partkey = p_partkey JOIN orders o ON l_orderkey = o_orderkey),
b AS (SELECT *, CASE WHEN l_quantity <= 0 THEN 1 WHEN l_quantity <= 4 THEN 2 WHEN l_quantity <= 10 THEN 3 WHEN l_quantity <= 20 THEN 4 ELSE 5 END AS storms,
  CASE WHEN l_discount * 10 < 0.1 THEN 1 WHEN l_discount * 10 < 0.2 THEN 2 WHEN l_discount * 10 < 0.5 THEN 3 WHEN l_discount * 10 < 1 THEN 4 ELSE 5 END AS tide,
  CASE WHEN p_size <= 0 THEN 1 WHEN p_size <= 1 THEN 2 WHEN p_size <= 5 THEN 3 WHEN p_size <= 10 THEN 4 ELSE 5 END AS debris,
  CASE WHEN l_tax * 25 < 0.5 THEN CASE WHEN p_size < 2 THEN 100 WHEN p_size <= 20 THEN 80 WHEN p_size <= 50 THEN 30 ELSE 10 END
       WHEN l_tax * 25 < 1 THEN CASE WHEN p_size < 2 THEN 100 WHEN p_size <= 30 THEN 80 WHEN p_size <= 75 THEN 30 ELSE 10 END
       ELSE CASE WHEN p_size < 2 THEN 100 WHEN p_size <= 40 THEN 80 WHEN p_size <= 100 THEN 30 ELSE 10 END END AS dss FROM c),
s AS (SELECT o_orderstatus, dss, greatest(least(100 * exp(-((storms + tide + debris - 3) * 0.022::DOUBLE / 3) * least(age, 200)), 110), 0) AS pss FROM b)
SELECT o_orderstatus, dss, count(*) AS cells, round(avg(pss), 6) AS mean_present, round(avg(dss - pss), 6) AS mean_gap FROM s GROUP BY ALL
""")
def score_chain(t: Tables):
    c = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    coeff = S.coefficient(S.bin_storms(F.col("l_quantity")), S.bin_tide(F.col("l_discount") * 10), S.bin_debris(F.col("p_size")))
    dss = S.desired(F.lit(None).cast("double"), F.col("p_size"), F.col("l_tax") * 25)
    s = c.select("o_orderstatus", dss.alias("dss"), S.present(F.lit(100), coeff, _days() / F.lit(365.0)).alias("pss"))
    return s.groupBy("o_orderstatus", "dss").agg(F.count(F.lit(1)).alias("cells"), F.round(F.avg("pss"), 6).alias("mean_present"), F.round(F.avg(F.col("dss") - F.col("pss")), 6).alias("mean_gap"))


@query("""
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size END AS p_size, p_size % 5 = 0 AS scaled, p_retailprice FROM part),
s AS (SELECT *, CASE WHEN p_size % 2 = 0 AND p_size % 3 = 0 THEN CASE WHEN scaled THEN 110 ELSE 100 END ELSE 60 END AS feature,
  CASE WHEN p_size % 4 <> 1 THEN CASE WHEN scaled THEN 110 ELSE 100 END ELSE 60 END AS coverage,
  CASE WHEN p_size <= 5 AND p_retailprice % 10 <= 0.05 THEN 110 WHEN p_size <= 20 THEN 85 WHEN p_size <= 50 THEN 65 WHEN p_size <= 500 THEN 45 WHEN p_size IS NULL THEN NULL ELSE 25 END AS horizontal,
  CASE WHEN p_size / 20.0 <= 0.5 THEN 100 WHEN p_size / 20.0 <= 1 THEN 80 WHEN p_size / 20.0 <= 2 THEN 40 ELSE 20 END AS vertical FROM p),
m AS (SELECT p_partkey, CASE WHEN horizontal IS NOT NULL THEN least(feature, coverage, horizontal, vertical) - CASE WHEN p_partkey % 7 = 0 THEN 0.01 ELSE 0 END END AS score FROM s)
SELECT p_partkey, round(score, 4)::DOUBLE AS score, CASE WHEN score > 80 THEN 1 WHEN score > 60 THEN 2 WHEN score > 40 THEN 3 WHEN score > 20 THEN 4 WHEN score IS NOT NULL THEN 5 END AS class FROM m
""")
def supersession_score(t: Tables):
    size, yes, no = F.when(F.col("p_partkey") % 11 != 0, F.col("p_size")), F.lit(True), F.lit(False)
    scaled = F.col("p_size") % 5 == 0
    h = F.when(size.isNotNull(), S.horizontal(size, F.col("p_retailprice") % 10, yes))
    parts = S.feature(size % 2 == 0, size % 3 == 0, scaled), S.coverage(size % 4 != 1, scaled), h, S.vertical(size / 20.0, F.lit(0.0), no)
    score = S.supersession(*parts, interpolated=F.col("p_partkey") % 7 == 0)
    return t.part.select("p_partkey", F.round(score, 4).alias("score"), S.catzoc(score).alias("class"))


@query(f"SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity * exp(-0.022 * {DAYS} / 365) >= 1 THEN l_quantity * exp(-0.022 * {DAYS} / 365) END, 6) AS score FROM lineitem")
def decay_score(t: Tables):
    return t.lineitem.select(*KEYS, F.round(S.decay(F.col("l_quantity"), _days()), 6).alias("score"))


@query("""
WITH y AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN year(l_shipdate) WHEN 1 THEN year(l_shipdate) * 100 + month(l_shipdate)
  WHEN 2 THEN year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) ELSE l_quantity END::DOUBLE AS v FROM lineitem),
d AS (SELECT *, CASE WHEN v <= 1 THEN NULL WHEN v >= 10000000 THEN floor(v / 10000) WHEN v >= 10000 THEN floor(v / 100) ELSE v END AS u FROM y)
SELECT l_orderkey, l_linenumber, CASE WHEN u BETWEEN 1800 AND 2024 THEN u::INT END AS survey_year FROM d
""")
def clean_survey_years(t: Tables):
    d, k = F.col("l_shipdate"), F.col("l_linenumber") % 4
    v = F.when(k == 0, F.year(d)).when(k == 1, F.year(d) * 100 + F.month(d)).when(k == 2, F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).otherwise(F.col("l_quantity")).cast("double")
    return t.lineitem.select(*KEYS, S.clean_year(v).alias("survey_year"))


@query("""
SELECT o_orderkey, CASE WHEN n <= 0 THEN 1 WHEN n <= 4 THEN 2 WHEN n <= 10 THEN 3 WHEN n <= 20 THEN 4 ELSE 5 END AS storms, CASE WHEN n <= 0 THEN 1 WHEN n <= 1 THEN 2 WHEN n <= 5 THEN 3 WHEN n <= 10 THEN 4 ELSE 5 END AS debris,
  CASE WHEN n / 10.0 < 0.1 THEN 1 WHEN n / 10.0 < 0.2 THEN 2 WHEN n / 10.0 < 0.5 THEN 3 WHEN n / 10.0 < 1 THEN 4 ELSE 5 END AS tide,
  CASE WHEN n <= 1 THEN 100 WHEN n <= 20 THEN 80 WHEN n <= 50 THEN 30 ELSE 10 END AS clearance, CASE WHEN n < 2 THEN 100 WHEN n <= 20 THEN 80 WHEN n <= 50 THEN 30 ELSE 10 END AS depth
FROM (SELECT o_orderkey, (o_custkey % 70)::INT AS n FROM orders)
""")
def bins(t: Tables):
    n = (F.col("o_custkey") % 70).cast("int")
    return t.orders.select(
        "o_orderkey", S.bin_storms(n).alias("storms"), S.bin_debris(n).alias("debris"), S.bin_tide(n / F.lit(10.0)).alias("tide"), S.bin_clearance(n, 20, 50).alias("clearance"), S.bin_depth(n, 20, 50).alias("depth")
    )


@query("""
WITH v AS (SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE (o_custkey % 90)::DOUBLE - 5 END AS ukc, (o_custkey % 60)::DOUBLE AS depth, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE (o_orderkey % 15) / 10.0::DOUBLE END AS slope FROM orders),
l AS (SELECT *, CASE WHEN slope < 0.5 THEN 20 WHEN slope < 1 THEN 30 WHEN slope >= 1 THEN 40 END AS s, CASE WHEN slope < 0.5 THEN 50 WHEN slope < 1 THEN 75 WHEN slope >= 1 THEN 100 END AS m FROM v)
SELECT o_orderkey, CASE WHEN s IS NULL THEN NULL WHEN ukc >= 0 THEN CASE WHEN ukc <= 1 THEN 100 WHEN ukc <= s THEN 80 WHEN ukc <= m THEN 30 ELSE 10 END
  ELSE CASE WHEN depth < 2 THEN 100 WHEN depth <= s THEN 80 WHEN depth <= m THEN 30 ELSE 10 END END AS dss FROM l
""")
def desired_score(t: Tables):
    ukc = F.when(F.col("o_custkey") % 5 != 0, (F.col("o_custkey") % 90).cast("double") - 5)
    slope = F.when(F.col("o_orderkey") % 11 != 0, (F.col("o_orderkey") % 15) / F.lit(10.0))
    return t.orders.select("o_orderkey", S.desired(ukc, (F.col("o_custkey") % 60).cast("double"), slope).alias("dss"))


@query("SELECT p_partkey, round(log10(pow(10, p_size / 10.0::DOUBLE) + pow(10, (p_partkey % 5)::DOUBLE) + pow(10, 1.0)), 6) AS likelihood, round((p_partkey % 4) * log10(pow(10, p_size / 10.0::DOUBLE) + pow(10, (p_partkey % 5)::DOUBLE) + pow(10, 1.0)), 6) AS risk FROM part")
def risk_sum(t: Tables):
    x = S.likelihood(F.col("p_size") / F.lit(10.0), F.col("p_partkey") % 5, F.lit(1.0))
    return t.part.select("p_partkey", F.round(x, 6).alias("likelihood"), F.round(F.col("p_partkey") % 4 * x, 6).alias("risk"))


@query("""
SELECT p_partkey, round(pow(2, -(p_size / 5.0 - 5)), 8) AS grain, CASE WHEN g > 0 AND g < 0.0039 THEN 'Clay' WHEN g >= 0.0039 AND g < 0.0625 THEN 'Mud' WHEN g >= 0.0625 AND g < 2 THEN 'Sand' WHEN g >= 2 THEN 'Gravel' END AS sediment,
  CASE WHEN g >= 2 THEN 1 WHEN g >= 0.0625 THEN 2 WHEN g >= 0.0039 THEN 3 ELSE 4 END AS code FROM (SELECT *, pow(2, -(p_size / 5.0 - 5)) AS g FROM part)
""")
def sediment_classes(t: Tables):
    g = S.grain_mm(F.col("p_size") / F.lit(5.0) - 5)
    kind = S.sediment(F.lit(None).cast("string"), g)
    return t.part.select("p_partkey", F.round(g, 8).alias("grain"), kind.alias("sediment"), S.sediment_code(kind).alias("code"))


@query("SELECT event_id, round(sin(radians((event_id * 7 % 360)::DOUBLE)), 8) AS flow_sin, round(cos(radians((event_id * 7 % 360)::DOUBLE)), 8) AS flow_cos, round((event_id % 30) * abs(value - 50), 6) AS shear FROM events")
def flow_and_shear(t: Tables):
    deg = (F.col("event_id") * 7 % 360).cast("double")
    return t.events.select("event_id", F.round(F.sin(F.radians(deg)), 8).alias("flow_sin"), F.round(F.cos(F.radians(deg)), 8).alias("flow_cos"), F.round(F.col("event_id") % 30 * F.abs(F.col("value") - 50), 6).alias("shear"))


@query("""
WITH q AS (SELECT event_id, event_id % 90 AS wind, CASE WHEN event_id % 3 = 0 THEN -999 ELSE event_id % 4 * 30 END AS a, CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 8 * 10 END AS b FROM events),
r AS (SELECT event_id, CASE WHEN wind >= 34 AND a <= 0 AND coalesce(b, -999) <= 0 THEN 100 WHEN a <> -999 THEN a END::DOUBLE AS r_a, CASE WHEN wind >= 34 AND a <= 0 AND coalesce(b, -999) <= 0 THEN 100 WHEN b <> -999 THEN b END::DOUBLE AS r_b FROM q)
SELECT *, greatest(coalesce(r_a, 0), 0) * 1.5 AS r0_a FROM r
""")
def storm_radii(t: Tables):
    e = F.col("event_id")
    q = [F.when(e % 3 == 0, -999).otherwise(e % 4 * 30), F.when(e % 6 != 0, e % 8 * 10)]
    a, b = S.radii(e % 90, q, 34, 100)
    return t.events.select("event_id", a.cast("double").alias("r_a"), b.cast("double").alias("r_b"), S.outer_radius(a.cast("double")).alias("r0_a"))


@query("SELECT count(*) FILTER (abs(l_tax - l_discount) <= 0.00001 + 0.00001 * abs(l_discount)) AS close, count(*) AS n FROM lineitem")
def approximately_equal(t: Tables):
    return t.lineitem.agg(F.count_if(S.close_to(F.col("l_tax"), F.col("l_discount"))).alias("close"), F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey, l_linenumber, round(l_quantity * exp(-(l_linenumber - 1) * 0.022::DOUBLE / 4 * 10), 6) AS future, round(least(p_size, 50) * 2.0 - l_quantity * exp(-(l_linenumber - 1) * 0.022::DOUBLE / 4 * 10), 6) AS gap FROM lineitem JOIN part ON l_partkey = p_partkey")
def future_score_gap(t: Tables):
    future = F.col("l_quantity") * F.exp(-(F.col("l_linenumber") - 1) * F.lit(S.DECAY) / 4 * 10)
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(*KEYS, F.round(future, 6).alias("future"), F.round(F.least(F.col("p_size"), F.lit(50)) * 2.0 - future, 6).alias("gap"))


@query("SELECT user_id, round(avg(value), 6) AS trend, round(coalesce(avg(value) / 10 * 7, 0), 6) AS scaled, round(avg(value) * exp(-0.05 * (user_id % 40)), 6) AS attenuated FROM events GROUP BY user_id")
def trend_scaling(t: Tables):
    g = t.events.groupBy("user_id").agg(F.avg("value").alias("m"))
    return g.select("user_id", F.round("m", 6).alias("trend"), F.round(F.coalesce(F.col("m") / 10 * 7, F.lit(0.0)), 6).alias("scaled"), F.round(F.col("m") * F.exp(-0.05 * (F.col("user_id") % 40)), 6).alias("attenuated"))
