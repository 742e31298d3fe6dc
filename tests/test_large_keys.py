"""Queries against their SQL on keys beyond those of the small tables."""

import duckdb
import pytest

from shoalspark import catalogue

ORDERS = "SELECT k AS o_orderkey, c AS o_custkey, 'F' AS o_orderstatus FROM (VALUES (2010123, 1), (201512, 0), (2010, 1), (1900, 2), (190012, 2), (77, 5)) v(k, c)"
PARTS = "SELECT k::BIGINT AS p_partkey FROM (VALUES (1), (542356), (542357), (1200000)) v(k)"


@pytest.mark.parametrize(("name", "table", "sql"), [("lidar_selection", "orders", ORDERS), ("tile_names", "part", PARTS)])
def test_large_keys_against_sql(spark, tmp_path, name, table, sql):
    db = duckdb.connect()
    db.execute(f"COPY ({sql}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
    db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    wanted = db.execute(catalogue.oracle_sql()[name])
    columns = [c[0] for c in wanted.description]
    got = catalogue.queries()[name](spark, str(tmp_path))
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(wanted.fetchall())
