"""Registered queries against their SQL in DuckDB over the smallest tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

from gridloom.plans import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def rows(frame):
    def plain(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
            return "NULL"
        return round(float(x), 9) if isinstance(x, (int, float)) or hasattr(x, "dtype") and x.dtype.kind in "iuf" else str(x)

    return sorted((tuple(map(plain, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, db, name):
    have = registry.queries()[name](spark, FOLDER).toPandas()
    want = db.sql(registry.oracle_sql()[name]).df()
    assert sorted(have.columns) == sorted(want.columns)
    assert rows(have) == rows(want)
