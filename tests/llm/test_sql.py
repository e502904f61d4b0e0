"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

from llm.queries import ORACLE, QUERIES
from tests.llm.helpers import SMALL

TABLES = ("documents", "benchmark", "conversations", "embeddings", "labels")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.sql(ORACLE[name]).df()
    got = QUERIES[name](spark, SMALL).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda df: sorted(map(repr, df[sorted(df.columns)].astype(object).values.tolist()))
    assert key(got) == key(want)
