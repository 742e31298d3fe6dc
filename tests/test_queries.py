"""Every query with SQL is held against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

CHECKED = sorted(entry_module.oracle_sql())


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object).where(df.notna(), None)
    key = df.map(lambda v: f"{v:.4f}" if isinstance(v, float) else str(v.tolist()) if hasattr(v, "tolist") else str(v))
    return df.loc[key.sort_values(list(df.columns)).index].reset_index(drop=True)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sf, name):
    ours = _sorted(entry_module.queries()[name](spark, sf).toPandas())
    with duckdb.connect() as c:
        c.execute("SET timezone = 'UTC'")
        for f in os.listdir(sf):
            c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
        theirs = _sorted(c.execute(entry_module.oracle_sql()[name]).fetchdf())
    assert list(ours.columns) == list(theirs.columns) and len(ours) == len(theirs)
    for column in ours:
        for a, b in zip(ours[column], theirs[column], strict=True):
            if isinstance(a, float) or isinstance(b, float):
                assert (a is None and b is None) or float(a) == pytest.approx(float(b), rel=1e-6, abs=1e-6), (column, a, b)
            elif hasattr(a, "date") or hasattr(b, "date"):
                assert pd.Timestamp(a) == pd.Timestamp(b)
            else:
                assert (list(a) if hasattr(a, "__len__") and not isinstance(a, str) else a) == (list(b) if hasattr(b, "__len__") and not isinstance(b, str) else b), (column, a, b)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
