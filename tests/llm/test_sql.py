"""Operators that SQL can express, compared with it on the smallest tables."""

import duckdb
import pytest

from conftest import SMALL
from orderlens.llm import queries


@pytest.mark.parametrize("name", ["op2_top_k", "op5_substring_dedup", "op7_jaccard", "op9_suffix_dedup"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    found = queries.QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == sorted(columns)
    got = sorted(tuple(r) for r in found.select(*columns).collect())
    assert got == sorted(result.fetchall())
