"""Relational queries: filters, lookups, summaries, windows, set operations, texts, tall and wide tables."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import texts as X
from ..operators import tabular as T
from ..sqlpair import Tables, query


@query("""
WITH r AS (SELECT p_size % 40 AS code, max_by(p_retailprice, p_partkey) AS score FROM part GROUP BY 1)
SELECT l_orderkey, l_linenumber, CASE WHEN code >= 0 THEN score END AS score FROM (SELECT *, (l_partkey % 50 - 3)::INT AS code FROM lineitem) LEFT JOIN r USING (code)
""")
def lookup_reclass(t: Tables):
    codes = t.part.select((F.col("p_size") % 40).alias("code"), F.col("p_retailprice").alias("score"), "p_partkey")
    cells = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 50 - 3).cast("int").alias("code"))
    return T.lookup(cells, codes, "code", "p_partkey", "score").select("l_orderkey", "l_linenumber", "score")


@query("SELECT o_custkey, arg_max(o_orderkey, (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, epoch(o_orderdate)::BIGINT, -o_orderkey)) AS pick FROM orders GROUP BY o_custkey")
def latest_survey_pick(t: Tables):
    o = t.orders.select("o_custkey", F.col("o_orderkey").alias("pick"), (F.col("o_orderstatus") == "F").cast("int").alias("m"), F.unix_timestamp("o_orderdate").alias("d"))
    return T.pick_latest(o, "o_custkey", F.col("m"), F.col("d"), "pick")


_NULLED = "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS a, CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id END AS b FROM events"


def _nulled(t: Tables):
    e = F.col("event_id")
    return t.events.select("event_id", F.when(e % 3 != 0, F.col("value")).alias("a"), F.when(e % 4 != 0, F.col("user_id")).alias("b"))


@query(f"SELECT round(100 * avg((a IS NULL)::INT), 2) AS a, round(100 * avg((b IS NULL)::INT), 2) AS b FROM ({_NULLED})")
def null_percent(t: Tables):
    return T.null_percent(_nulled(t), ["a", "b"])


@query(f"SELECT count(*) FILTER (a IS NULL AND b IS NULL) AS both_null, count(*) FILTER (a IS NULL AND b IS NOT NULL) AS only_first, count(*) FILTER (a IS NOT NULL AND b IS NULL) AS only_second, count(*) FILTER ((a IS NULL) <> (b IS NULL)) AS mismatch FROM ({_NULLED})")
def null_overlap(t: Tables):
    return T.null_overlap(_nulled(t), "a", "b")


@query("""
SELECT n_nationkey, count(s_suppkey) AS hazards, count(*) FILTER (s_acctbal < 0) AS negative, count(*) FILTER (s_acctbal > 5000) AS large, coalesce(max(s_acctbal), 0) AS most
FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY n_nationkey
""")
def conditional_grid_summary(t: Tables):
    j = t.nation.join(t.supplier, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return j.groupBy("n_nationkey").agg(F.count("s_suppkey").alias("hazards"), F.count_if(F.col("s_acctbal") < 0).alias("negative"), F.count_if(F.col("s_acctbal") > 5000).alias("large"), F.coalesce(F.max("s_acctbal"), F.lit(0.0)).alias("most"))


@query("SELECT l_partkey % 100 AS cell, year(l_shipdate) AS yr, count(*) AS storms, sum(l_quantity) AS wind FROM lineitem GROUP BY ALL")
def yearly_count_sum(t: Tables):
    return t.lineitem.groupBy((F.col("l_partkey") % 100).alias("cell"), F.year("l_shipdate").alias("yr")).agg(F.count(F.lit(1)).alias("storms"), F.sum("l_quantity").alias("wind"))


_YEARLY = "SELECT l_returnflag AS layer, (l_partkey % 50)::BIGINT AS cell, year(l_shipdate) AS year, sum(CASE WHEN l_linenumber = 1 THEN 0 ELSE l_quantity END) AS value FROM lineitem GROUP BY ALL"


def _yearly(t: Tables):
    return t.lineitem.groupBy(F.col("l_returnflag").alias("layer"), (F.col("l_partkey") % 50).alias("cell"), F.year("l_shipdate").alias("year")).agg(F.sum(F.when(F.col("l_linenumber") == 1, 0.0).otherwise(F.col("l_quantity"))).alias("value"))


@query(f"""
WITH y AS (SELECT * FROM ({_YEARLY}) WHERE year BETWEEN 1996 AND 1999), f AS (SELECT layer FROM y GROUP BY layer HAVING count(DISTINCT year) = 4)
SELECT layer, cell, round(coalesce(avg(nullif(value, 0)), 0), 6) AS mean FROM y WHERE layer IN (SELECT layer FROM f) GROUP BY ALL
""")
def year_range_mean_complete(t: Tables):
    return T.complete_years(_yearly(t), 1996, 1999).withColumn("mean", F.round("mean", 6))


@query(f"""
WITH y AS (SELECT cell, year, sum(value) AS n FROM ({_YEARLY}) GROUP BY ALL), c AS (SELECT DISTINCT cell, greatest(1995, 1990 + cell % 10) AS since FROM y)
SELECT c.cell, coalesce(sum(n), 0) AS total FROM c LEFT JOIN y ON c.cell = y.cell AND year >= since GROUP BY c.cell
""")
def suffix_sum_since_year(t: Tables):
    y = _yearly(t).groupBy("cell", "year").agg(F.sum("value").alias("n"))
    cells = y.select("cell").distinct().select("cell", (1990 + F.col("cell") % 10).alias("since"))
    return T.sum_since(cells, y, 1995).select("cell", F.col("total").cast("double").alias("total"))


@query("""
WITH v AS (SELECT event_id, user_id, CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 7 = 0 THEN -value ELSE value END AS width FROM events),
m AS (SELECT user_id, median(width) AS m FROM v WHERE width > 0 AND width <= 100 GROUP BY user_id)
SELECT event_id, round(CASE WHEN width > 0 AND width <= 100 THEN width ELSE m END, 6) AS width, NOT coalesce(width > 0 AND width <= 100, false) AND m IS NOT NULL AS corrected FROM v LEFT JOIN m USING (user_id)
""")
def median_repair(t: Tables):
    e = F.col("event_id")
    v = t.events.select("event_id", "user_id", F.when(e % 9 == 0, None).when(e % 7 == 0, -F.col("value")).otherwise(F.col("value")).alias("width"))
    valid = ~X.out_of_range(F.col("width"), 100)
    return T.repaired_by_median(v, "user_id", "width", valid).select("event_id", F.round("width", 6).alias("width"), "corrected")


@query("""
SELECT event_id, concat_ws(';', CASE WHEN event_id % 511 = 0 THEN 'Heading_511' END, CASE WHEN length(regexp_replace(props, '[A-Za-z0-9\\s]', '', 'g')) / length(props) > 0.3 THEN 'Garbage_VesselName' END,
  CASE WHEN value IS NULL OR value <= 0 OR value > 50 THEN 'Invalid_Width' END) AS flags FROM events
""")
def quality_flags(t: Tables):
    return t.events.select("event_id", X.flags(("Heading_511", F.col("event_id") % 511 == 0), ("Garbage_VesselName", X.garbage(F.col("props"))), ("Invalid_Width", X.out_of_range(F.col("value"), 50))).alias("flags"))


@query("""
WITH p AS (SELECT p_partkey, unnest([('Gravel', p_size % 7, 0), ('Sand', p_partkey % 5, 1), ('Mud', p_size % 3, 2), ('Clay', p_partkey % 2, 3)]) AS s FROM part),
r AS (SELECT p_partkey, s[1] AS name, row_number() OVER (PARTITION BY p_partkey ORDER BY s[2] DESC, s[3]) AS n FROM p)
SELECT p_partkey, max(name) FILTER (n = 1) AS first, max(name) FILTER (n = 2) AS second FROM r GROUP BY p_partkey
""")
def top2_categories(t: Tables):
    s, k = F.col("p_size"), F.col("p_partkey")
    shares = [("Gravel", s % 7), ("Sand", k % 5), ("Mud", s % 3), ("Clay", k % 2)]
    top = F.sort_array(F.array(*[F.struct(v.cast("long").alias("v"), F.lit(-i).alias("i"), F.lit(n).alias("n")) for i, (n, v) in enumerate(shares)]), False)
    return t.part.select("p_partkey", top[0]["n"].alias("first"), top[1]["n"].alias("second"))


@query("SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS fid FROM part")
def row_ids(t: Tables):
    return t.part.select("p_partkey", (F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) - 1).cast("long").alias("fid"))


_TALL = "SELECT (l_partkey % 200)::BIGINT AS cell, year(l_shipdate) AS year, sum(l_quantity) AS value FROM lineitem GROUP BY ALL"


def _tall(t: Tables):
    return t.lineitem.groupBy((F.col("l_partkey") % 200).alias("cell"), F.year("l_shipdate").alias("year")).agg(F.sum("l_quantity").alias("value"))


@query("WITH y AS (SELECT DISTINCT year(l_shipdate) AS y0 FROM lineitem) SELECT * FROM (SELECT y0, lead(y0) OVER (ORDER BY y0) AS y1 FROM y) WHERE y1 IS NOT NULL")
def consecutive_pairs(t: Tables):
    return T.year_pairs(t.lineitem.select(F.year("l_shipdate").alias("year")))


@query("WITH y AS (SELECT DISTINCT year(l_shipdate) AS y FROM lineitem) SELECT a.y AS y0, b.y AS y1 FROM y a JOIN y b ON a.y < b.y")
def all_year_pairs(t: Tables):
    return T.year_pairs(t.lineitem.select(F.year("l_shipdate").alias("year")), consecutive=False)


@query(f"WITH v AS ({_TALL}) SELECT a.cell, a.year AS y0, b.year AS y1, b.value - a.value AS delta FROM v a JOIN v b ON a.cell = b.cell WHERE (a.year, b.year) IN ((1995, 1996), (1996, 1998), (1998, 2000))")
def pair_deltas(t: Tables):
    return T.deltas(_tall(t), t.spark.createDataFrame([(1995, 1996), (1996, 1998), (1998, 2000)], "y0 int, y1 int"))


@query(f"WITH v AS ({_TALL}) SELECT cell, sum(value) FILTER (year = 1995) AS v_1995, sum(value) FILTER (year = 1996) AS v_1996, sum(value) FILTER (year = 1997) AS v_1997 FROM v WHERE year IN (1995, 1996, 1997) GROUP BY cell")
def tall_to_wide(t: Tables):
    wide = _tall(t).groupBy("cell").pivot("year", [1995, 1996, 1997]).agg(F.sum("value")).select("cell", *[F.col(f"`{y}`").alias(f"v_{y}") for y in (1995, 1996, 1997)])
    return wide.where("coalesce(v_1995, v_1996, v_1997) is not null")


@query("SELECT p_partkey, 'size' AS var, p_size::DOUBLE AS value FROM part UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part")
def wide_to_tall(t: Tables):
    return t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price")).unpivot("p_partkey", ["size", "price"], "var", "value")


@query("""
WITH c AS (SELECT c_nationkey, o.o_custkey AS id, list(DISTINCT year(o_orderdate)) AS ys FROM orders o JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT id, len(list_filter(ys, lambda y: y BETWEEN 1994 AND 1996)) AS early, len(list_filter(ys, lambda y: y BETWEEN 1997 AND 2000)) AS late, len(ys) AS years FROM c
""")
def list_range_counts(t: Tables):
    ys = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left_semi").groupBy(F.col("o_custkey").alias("id")).agg(F.collect_set(F.year("o_orderdate")).alias("ys"))
    n = lambda lo, hi: F.size(F.filter("ys", lambda y: y.between(lo, hi))).cast("long")
    return ys.select("id", n(1994, 1996).alias("early"), n(1997, 2000).alias("late"), F.size("ys").cast("long").alias("years"))


@query("SELECT p_size, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM part GROUP BY p_size")
def score_histogram_pct(t: Tables):
    return t.part.groupBy("p_size").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(t.part.agg(F.count(F.lit(1)).alias("total")))).select("p_size", "n", F.round(100 * F.col("n") / F.col("total"), 4).alias("pct"))


@query("SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'F' ELSE 'L' END AS half, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent, o_orderpriority NOT SIMILAR TO '.*(LOW|NOT).*' AS provider FROM orders WHERE o_orderstatus IN ('F', 'O') AND NOT (o_custkey % 2 = 0 AND o_orderkey % 3 = 0)")
def row_filters(t: Tables):
    o = t.orders.where(F.col("o_orderstatus").isin("F", "O") & ~((F.col("o_custkey") % 2 == 0) & (F.col("o_orderkey") % 3 == 0)))
    half = F.when(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp"), "F").otherwise("L")
    return o.select("o_orderkey", half.alias("half"), F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("urgent"), (~F.col("o_orderpriority").rlike("LOW|NOT")).alias("provider"))


@query("SELECT s_nationkey, round(sum(s_acctbal), 2) AS area FROM supplier GROUP BY s_nationkey HAVING sum(s_acctbal) >= 20000")
def min_area_filter(t: Tables):
    return t.supplier.groupBy("s_nationkey").agg(F.round(F.sum("s_acctbal"), 2).alias("area"), F.sum("s_acctbal").alias("a")).where("a >= 20000").drop("a")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def orphan_anti_join(t: Tables):
    return t.customer.join(t.orders.where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT s_suppkey AS id, s_acctbal AS bal, NULL::VARCHAR AS seg FROM supplier UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def union_missing_columns(t: Tables):
    a, b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal")), t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT DISTINCT o_custkey AS v FROM orders WHERE year(o_orderdate) = 1995 INTERSECT SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1996 EXCEPT SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def set_operations(t: Tables):
    at = lambda c: t.orders.where(c).select(F.col("o_custkey").alias("v"))
    return at(F.year("o_orderdate") == 1995).intersect(at(F.year("o_orderdate") == 1996)).subtract(at(F.col("o_orderpriority") == "1-URGENT"))


@query("SELECT isoyear(ts) AS y, week(ts) AS w, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def iso_week_groups(t: Tables):
    return t.events.groupBy(F.extract(F.lit("YEAROFWEEK"), "ts").cast("long").alias("y"), F.weekofyear("ts").cast("long").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""
WITH d AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') ELSE 'surveyed in ' || strftime(o_orderdate, '%Y') END AS s FROM orders)
SELECT o_orderkey, coalesce(try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%Y/%m/%d'), try_strptime(s, '%Y%m%d'), try_strptime(regexp_extract(s, '((?:18|19|20)\\d{2})', 1), '%Y'))::DATE AS d FROM d
""")
def parse_dates(t: Tables):
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    s = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy/MM/dd")).when(k == 2, F.date_format(d, "yyyyMMdd")).otherwise(F.concat(F.lit("surveyed in "), F.date_format(d, "yyyy")))
    return t.orders.select("o_orderkey", X.any_date(s).alias("d"))


@query("""
WITH c AS (SELECT conv_id, turn, role, length(text) AS n, CASE WHEN role = 'user' THEN turn END AS head FROM conversations)
SELECT conv_id, turn, last_value(head IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS head FROM c
""")
def header_fill(t: Tables):
    return T.headers_down(t.conversations, "conv_id", "turn", F.when(F.col("role") == "user", F.col("turn"))).select("conv_id", "turn", "head")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value ELSE -value END AS lat, CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 50 END::DOUBLE AS first_number FROM (SELECT event_id, round(value, 1) AS value FROM events)")
def coordinates_and_numbers(t: Tables):
    v = F.format_string("%.1f", F.round("value", 1))
    text = F.concat(v, F.when(F.col("event_id") % 2 == 0, "N").otherwise("S"))
    named = F.when(F.col("event_id") % 3 == 0, "none").otherwise(F.concat(F.lit("draft "), (F.col("event_id") % 50).cast("string"), F.lit(" m")))
    return t.events.select("event_id", X.coordinate(text).alias("lat"), X.number_in(named).alias("first_number"))


@query("SELECT event_id, user_id, value + coalesce(lead(value) OVER (PARTITION BY user_id, event_type ORDER BY event_id), 0) AS paired FROM events")
def lead_pairing(t: Tables):
    w = Window.partitionBy("user_id", "event_type").orderBy("event_id")
    return t.events.select("event_id", "user_id", (F.col("value") + F.coalesce(F.lead("value").over(w), F.lit(0.0))).alias("paired"))


@query("""
SELECT p_partkey, lower(regexp_replace(trim(p_name), ' ', '_', 'g')) AS name,
  CASE p_partkey % 8 WHEN 0 THEN 'bt.bathy_' || y || '_filled' WHEN 1 THEN 'bathy_' || y || '_filled' WHEN 2 THEN 'slope_' || y WHEN 3 THEN 'tsm_mean_' || y || '_' || (y + 2)
    WHEN 4 THEN 'survey_end_date' WHEN 5 THEN 'bt.' || y WHEN 6 THEN 'grain_size' ELSE 'bt.bpi_fine_' || y END AS col
FROM (SELECT *, 1998 + p_size % 20 AS y FROM part)
""")
def standard_names(t: Tables):
    k, y = F.col("p_partkey") % 8, (1998 + F.col("p_size") % 20).cast("string")
    later = (2000 + F.col("p_size") % 20).cast("string")
    forms = [("BlueTopo_bathy_", y, "0101"), ("combined2_bathy_", y, "0630"), ("bathy_slope_", y, ""), ("", y, "_", later, "_tsm_mean"), ("BlueTopo_Survey_End_Date_", y), ("bluetopo_", y, "0831"), ("_grain_size_",), ("bt.bathy__bpi_fine_", y)]
    made = [F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts]) for parts in forms]
    file = F.coalesce(*[F.when(k == i, m) for i, m in enumerate(made)])
    return t.part.select("p_partkey", F.lower(X.plain_name(F.trim("p_name"))).alias("name"), X.standard_name(file).alias("col"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_fields(t: Tables):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY event_type ORDER BY n DESC, event_type LIMIT 3")
def top_groups(t: Tables):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean")).orderBy(F.desc("n"), "event_type").limit(3)


@query("SELECT user_id, list(event_id ORDER BY ts, event_id) AS track, count(*) AS points FROM events GROUP BY user_id")
def track_lines(t: Tables):
    g = t.events.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("ts", "event_id"))).alias("p"), F.count(F.lit(1)).alias("points"))
    return g.select("user_id", F.transform("p", lambda x: x["event_id"]).alias("track"), "points")
