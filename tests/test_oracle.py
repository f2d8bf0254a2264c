"""Every registered query against its DuckDB oracle on the sf0.001 tables,
and the entry() smoke contract."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from tools.check_oracle import canon, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data missing")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 30
    assert df.columns == ["window_minutes", "hashtag", "event_count", "rank", "window_start", "window_end"]


def test_every_query_has_an_oracle_or_is_listed():
    missing = set(E._reference_queries()) - set(E.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(E._reference_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) >= 0
        return
    res = con.execute(sql)
    c1, r1 = canon(df.columns, rows)
    c2, r2 = canon([d[0] for d in res.description], res.fetchall())
    assert c1 == c2
    assert r1 == r2
