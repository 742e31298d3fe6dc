"""Queries over classes of risk and the selection of lidar surveys. Grids of 128 by 128 cells and file names are made from the star tables."""

from pyspark.sql import functions as F

from ..functions import scores as S
from ..operators import lidar as L
from ..operators import riskclasses as R
from ..sqlpair import Tables, query

GRID = "SELECT (range // 128)::INT AS r, (range % 128)::INT AS c FROM range(0, 16384)"


def grid(t: Tables):
    return t.spark.range(16384).select(F.floor(F.col("id") / 128).cast("int").alias("row"), (F.col("id") % 128).cast("int").alias("col"))


def _places(table, key: str, a: int, b: int):
    return table.select((F.col(key) * a % 128).cast("int").alias("row"), (F.col(key) * b % 128).cast("int").alias("col"))


def _sql_places(table: str, key: str, a: int, b: int) -> str:
    return f"SELECT ({key} * {a} % 128)::INT AS r, ({key} * {b} % 128)::INT AS c FROM {table}"


def _sql_circle(width: int) -> str:
    rows = ", ".join(f"({i - width // 2}, {cells // 2})" for i, cells in enumerate(R.CIRCLES[width]))
    return f"(VALUES {rows}) AS k{width}(dr, half)"


def _sql_count(points: str, width: int) -> str:
    """r, c, n: points in the circle round each cell that has some."""
    return f"SELECT g.r, g.c, count(*) AS n FROM ({GRID}) g JOIN {_sql_circle(width)} ON true JOIN ({points}) p ON p.r = g.r + dr AND abs(p.c - g.c) <= half GROUP BY ALL"


def _sql_near(points: str, near: dict[int, int]) -> str:
    return "SELECT r, c, max(s) AS near FROM (" + " UNION ALL ".join(f"SELECT r, c, {s} AS s FROM ({_sql_count(points, w)})" for w, s in near.items()) + ") GROUP BY ALL"


_DENSITY = "CASE WHEN n > 4 THEN 5 WHEN n >= 2 THEN 4 WHEN n >= 1 THEN 2 ELSE 1 END"
_A, _B = _sql_places("supplier", "s_suppkey", 6007, 3001), _sql_places("nation", "n_nationkey", 47, 91)


@query(f"""
WITH d AS ({_sql_count(_A, 17)}), s AS ({_sql_near(_A, {3: 5, 5: 4, 9: 3, 17: 2})})
SELECT r AS row, c AS col, greatest({_DENSITY}, coalesce(near, 0))::INT AS class FROM ({GRID}) LEFT JOIN d USING (r, c) LEFT JOIN s USING (r, c)
""")
def grounding_classes(t: Tables):
    return R.groundings(grid(t), _places(t.supplier, "s_suppkey", 6007, 3001))


@query(f"""
WITH d1 AS (SELECT r, c, n AS n1 FROM ({_sql_count(_A, 17)})), d2 AS (SELECT r, c, n AS n2 FROM ({_sql_count(_B, 31)})),
s1 AS (SELECT r, c, near AS near1 FROM ({_sql_near(_A, {3: 5, 5: 4, 9: 3, 17: 2})})), s2 AS (SELECT r, c, near AS near2 FROM ({_sql_near(_B, {5: 5, 9: 4, 17: 3, 31: 2})})),
j AS (SELECT r, c, coalesce(n1, 0) + coalesce(n2, 0) AS n, near1, near2 FROM ({GRID}) LEFT JOIN d1 USING (r, c) LEFT JOIN d2 USING (r, c) LEFT JOIN s1 USING (r, c) LEFT JOIN s2 USING (r, c))
SELECT r AS row, c AS col, greatest({_DENSITY}, coalesce(near1, 0), coalesce(near2, 0))::INT AS class FROM j
""")
def reported_error_classes(t: Tables):
    return R.reported_errors(grid(t), _places(t.supplier, "s_suppkey", 6007, 3001), _places(t.nation, "n_nationkey", 47, 91))


@query(f"""
WITH f AS (SELECT c_nationkey AS feature, (c_custkey * 7 % 128)::INT AS r, (c_custkey * 11 % 131)::INT AS c FROM customer)
SELECT g.r AS row, g.c AS col, count(DISTINCT feature) AS n FROM ({GRID}) g JOIN {_sql_circle(17)} ON true JOIN f ON f.r = g.r + dr AND abs(f.c - g.c) <= half GROUP BY ALL
""")
def known_hazard_density(t: Tables):
    cells = t.customer.select(F.col("c_nationkey").alias("feature"), (F.col("c_custkey") * 7 % 128).cast("int").alias("row"), (F.col("c_custkey") * 11 % 131).cast("int").alias("col"))
    return R.features_around(cells).join(grid(t), ["row", "col"], "left_semi")


@query("""
WITH v AS (SELECT o_orderkey, o_totalprice * 5 AS m, CASE WHEN o_custkey % 7 > 0 THEN (o_custkey % 7 - 2)::INT END AS l, (o_custkey % 120)::INT AS k FROM orders),
s AS (SELECT *, coalesce(CASE WHEN m <= 138900 THEN -3 WHEN m <= 277800 THEN -2 WHEN m <= 555600 THEN -1 WHEN m <= 1111000 THEN 0 ELSE 1 END + l, -5) AS total FROM v)
SELECT o_orderkey, (CASE WHEN total <= -4 THEN 0 WHEN total <= 0 THEN total + 4 ELSE 5 END)::INT AS rescue, CASE WHEN k = 0 THEN 1 WHEN k = 1 THEN 2 WHEN k <= 10 THEN 3 WHEN k <= 100 THEN 4 ELSE 5 END AS boaters,
  CASE WHEN k <= 4 THEN 3 WHEN k <= 20 THEN 4 WHEN k <= 50 THEN 3 WHEN k <= 100 THEN 2 ELSE 1 END AS depth, CASE WHEN k <= 1 THEN k * 3 + 1 WHEN k <= 100 THEN 5 END AS current,
  greatest(CASE WHEN k > 60 THEN 100 ELSE 1 END, l) AS complexity FROM s
""")
def risk_classes(t: Tables):
    k, length = (F.col("o_custkey") % 120).cast("int"), F.when(F.col("o_custkey") % 7 > 0, (F.col("o_custkey") % 7 - 2).cast("int"))
    return t.orders.select(
        "o_orderkey", R.rescue_class(F.col("o_totalprice") * 5, length).alias("rescue"), R.boaters_class(k).alias("boaters"), R.depth_class(k).alias("depth"),
        R.current_class(k).alias("current"), R.complexity(k, 60, length).alias("complexity"),
    )


@query("""
WITH b AS (SELECT p_partkey, list_extract(['SAND', 'MUD', 'HARD', 'ROCK', 'SOFT', 'CINDER', 'PEAT'], (p_partkey % 7)::INT + 1) AS name FROM part)
SELECT p_partkey, CASE name WHEN 'SAND' THEN 11 WHEN 'MUD' THEN 7 WHEN 'HARD' THEN 6 WHEN 'CINDER' THEN 17 END AS one, CASE name WHEN 'SAND' THEN 2 WHEN 'MUD' THEN 1 WHEN 'ROCK' THEN 5 END AS two,
  CASE name WHEN 'HARD' THEN 5 WHEN 'SOFT' THEN 2 END AS three FROM b
""")
def bottom_types(t: Tables):
    name = F.get(F.array(*map(F.lit, ["SAND", "MUD", "HARD", "ROCK", "SOFT", "CINDER", "PEAT"])), (F.col("p_partkey") % 7).cast("int"))
    return t.part.select("p_partkey", *[R.bottom_code(name, codes).alias(k) for k, codes in (("one", R.BOTTOM_1), ("two", R.BOTTOM_2), ("three", R.BOTTOM_3))])


@query("SELECT o_orderkey, (o_custkey % 5 + 1)::INT AS class, year(o_orderdate)::INT AS year, (2018 - year(o_orderdate))::INT AS age, o_custkey % 5 > 1 AS doubtful FROM orders")
def decoded_priorities(t: Tables):
    key = S.priority(F.col("o_custkey") % 3 + 1, 3, F.col("o_custkey") % 5 + 1, F.year("o_orderdate"))
    return t.orders.select("o_orderkey", *[c.alias(k) for k, c in R.decoded(key).items()])


def _lidar_names(t: Tables):
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey") % 4
    body = F.when(c == 0, F.concat(F.lit("FL_2015_USACE_NCMP_"), k)).when(c == 1, F.concat(F.lit("GA_2010_Topo_"), k)).when(c == 2, F.concat(F.lit("SC_Survey_"), k)).otherwise(F.concat(F.lit("NCEI_2016_"), k))
    return t.orders.select("o_orderkey", body.alias("body"), F.concat(body, F.lit("_resampled.tif")).alias("name"), "o_orderstatus")


@query("""
WITH n AS (SELECT o_orderkey AS k, o_custkey % 4 AS c, o_orderstatus AS s FROM orders)
SELECT CASE c WHEN 0 THEN 'FL_2015_USACE_NCMP_' WHEN 1 THEN 'GA_2010_Topo_' ELSE 'SC_Survey_' END || k || '_resampled.tif' AS name, CASE WHEN c = 0 THEN '2015' WHEN c = 1 THEN '2010' WHEN k BETWEEN 1800 AND 2099 THEN k::VARCHAR ELSE 'No Year Found' END AS year,
  k::VARCHAR AS id, CASE c WHEN 0 THEN 'USACE' WHEN 1 THEN 'Topo' ELSE 'Survey' END AS dataset, c = 2 AS manual, c <> 1 AS used FROM n WHERE s <> 'O' AND c < 3
""")
def lidar_selection(t: Tables):
    names = _lidar_names(t)
    mosaics = names.where("o_orderstatus <> 'O'").select(F.concat("body", F.lit(".vrt")).alias("name"))
    return L.chosen(names.select("name"), mosaics, {"GA_2010": {"use": "No"}, "SC_": {"use": True, "manual": "yes"}, "FL": {}})


@query("""
SELECT o_orderkey, 'ER_' || o_custkey % 3 AS region FROM orders WHERE (o_custkey % 3 = 1 AND o_orderstatus = 'F') OR (o_custkey % 3 = 2 AND o_orderstatus <> 'F')
""")
def approved_providers(t: Tables):
    files = t.orders.select("o_orderkey", F.concat(F.lit("ER_"), F.col("o_custkey") % 3).alias("region"), F.concat(F.lit("a/b/mosaic_2015_X_Lidar_"), "o_orderstatus", F.lit(".vrt")).alias("path"))
    providers = t.spark.createDataFrame([("ER_1", "LIDAR_f"), ("ER_2", "lidar_O"), ("ER_2", "Lidar_P"), ("ER_9", "lidar_F")], "region string, provider string")
    return L.approved(files, providers, 3).select("o_orderkey", "region")


@query("""
SELECT p_partkey::VARCHAR || CASE WHEN p_size % 2 = 0 THEN '_lidar_' || (1990 + p_size) ELSE '_none' END AS folder, CASE WHEN p_partkey >= 1000 THEN left(p_partkey::VARCHAR, 4)::INT WHEN p_size % 2 = 0 THEN 1990 + p_size ELSE 0 END AS year,
  CASE WHEN p_size % 3 = 0 THEN 'metadata.txt not found' WHEN p_size % 3 = 1 THEN 'Date not found' ELSE '2004-05, 2004-05-06, ' || (2005 + p_size) END AS date FROM part
""")
def folder_settings(t: Tables):
    size, k = F.col("p_size"), F.col("p_partkey").cast("string")
    folder = F.concat(k, F.when(size % 2 == 0, F.concat(F.lit("_lidar_"), (1990 + size).cast("string"))).otherwise("_none"))
    text = F.when(size % 3 == 1, "Description: none 12345").when(size % 3 == 2, F.concat(F.lit("from 2004-05 to 2004-05-06, 2004-05 and "), (2005 + size).cast("string"), F.lit(".")))
    return L.folder_years(t.part.select(folder.alias("folder"), text.alias("metadata")))


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 3 > 0 THEN 'part ' || k ELSE o_orderstatus END AS description, strftime(o_orderdate, '%Y-%m-%d') AS start, strftime(o_orderdate + k * INTERVAL 1 DAY, '%Y-%m-%d') AS end
FROM orders, range(1, 3) AS r(k) WHERE o_custkey % 3 > 0 OR k = 1
""")
def metadata_time_frames(t: Tables):
    day = lambda d: F.date_format(d, "yyyy-MM-dd")
    frame = lambda k, name: F.concat(F.lit("<time-frame>"), F.lit(name), F.lit("<start-date-time>"), day("o_orderdate"), F.lit("</start-date-time><end-date-time>"), day(F.date_add("o_orderdate", k)), F.lit("</end-date-time></time-frame>"))
    named = lambda k: frame(k, f"<description>part {k}</description>")
    xml = F.concat(F.lit("<item><when>"), F.when(F.col("o_custkey") % 3 > 0, F.concat(named(1), named(2))).otherwise(frame(1, "")), F.lit("</when></item>"))
    return t.orders.select("o_orderkey", F.explode(L.time_frames(xml, F.col("o_orderstatus"))).alias("f")).select("o_orderkey", "f.*")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN v < 0 THEN round(CASE WHEN l_returnflag = 'N' THEN v ELSE v * 0.3048006096::DOUBLE END, 9) END AS depth, CASE WHEN l_shipdate < TIMESTAMP '1995-01-01' THEN 0 ELSE 1 END AS mask FROM (SELECT *, 20 - l_quantity AS v FROM lineitem)")
def lidar_depths(t: Tables):
    tile = F.when(F.col("l_shipdate") < "1995-01-01", F.concat(F.lit("tile_bh4"), F.col("l_orderkey").cast("string"))).when(F.col("l_returnflag") != "N", "BH3")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(L.seabed(20 - F.col("l_quantity"), F.col("l_returnflag") == "N"), 9).alias("depth"), L.mask_value(tile).alias("mask"))


@query("SELECT 'o_orderstatus' AS \"column\", o_orderstatus AS value, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL")
def counts_of_values(t: Tables):
    return L.value_counts(t.orders, ["o_orderstatus", "o_orderpriority"])
