"""Every registered query against its DuckDB oracle on sf0.001 (stream = batch included)."""

import hashlib
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tidepool.plans.catalog import QUERIES as CATALOG

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def _digest(df):
    cols = sorted(df.columns)
    return sorted(hashlib.sha1("|".join(str(_norm(x)) for x in r).encode()).hexdigest()
                  for r in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF001).toPandas()
    want = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _digest(got) == _digest(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "swapCount" in df.columns
