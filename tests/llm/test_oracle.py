"""Queries with SQL equal their DuckDB SQL on the driver's tables; the others are in test_operators and test_pipeline."""

from __future__ import annotations

import os

import duckdb
import pytest

from ripplecast.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(want)
    assert want
