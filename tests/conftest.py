from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ripplecast.session import local_session

    s = local_session(cores=4, shuffle_partitions=8, app="ripplecast-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ripplecast-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="ripplecast-test-")


def feed_count(key: str, sf_dir: str = "/root/testdata/sf0.001") -> int:
    """Rows of a query's oracle SQL on the driver tables."""
    import duckdb

    from oracle_queries import oracle_sql

    con = duckdb.connect()
    for table in ("events", "nation"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con.execute(f"SELECT count(*) FROM ({oracle_sql()[key]})").fetchone()[0]


def event(**overrides):
    """A well-formed social event message (dict), overridable per field."""
    base = {
        "event_id": "ev_1",
        "event_type": "like",
        "user_id": "user_25",
        "username": "user_025",
        "country": "Germany",
        "user_created_at": "2026-01-15T10:00:00+00:00",
        "target_user_id": "user_10",
        "target_username": "user_010",
        "post_id": "post_1",
        "post_creator_user_id": "user_10",
        "post_created_at": "2026-02-10T12:00:00+00:00",
        "hashtag": "#travel",
        "comment_text": None,
        "timestamp": "2026-09-03T17:30:00.123456+00:00",
    }
    base.update(overrides)
    return base


def messages_df(spark, items):
    """DataFrame(value string) from dicts (serialised) or raw strings / None."""
    rows = [(json.dumps(x) if isinstance(x, dict) else x,) for x in items]
    return spark.createDataFrame(rows, "value string")


def curated_df(spark, rows):
    """Curated-shaped DataFrame from dicts with defaults."""
    import datetime as dt

    from ripplecast.schema import CURATED_COLUMNS

    schema = (
        "event_id string, event_type string, user_id string, username string, country string, "
        "target_user_id string, target_username string, post_id string, post_creator_user_id string, "
        "hashtag string, comment_text string, event_timestamp timestamp_ntz"
    )
    out = []
    for i, r in enumerate(rows):
        d = {c: None for c in CURATED_COLUMNS}
        d["event_id"] = f"c{i}"
        d.update(r)
        if isinstance(d["event_timestamp"], str):
            d["event_timestamp"] = dt.datetime.fromisoformat(d["event_timestamp"])
        out.append(tuple(d[c] for c in CURATED_COLUMNS))
    return spark.createDataFrame(out, schema)
