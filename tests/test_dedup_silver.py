"""Dedup, first-seen dimensions and the curated joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import event, feed_count, messages_df
from ripplecast.functions.parsing import parse_messages
from ripplecast.operators.dedup import dedup_any, dedup_earliest
from ripplecast.operators.silver import curated_events, post_dim, user_dim
from ripplecast.operators.validate import valid_events


def _valid(spark, msgs):
    return valid_events(parse_messages(messages_df(spark, msgs)))


def test_exact_duplicates_collapse(spark):
    df = _valid(spark, [event(event_id="a"), event(event_id="a"), event(event_id="b")])
    assert dedup_earliest(df).count() == 2
    assert dedup_any(df).count() == 2


def test_differing_bodies_keep_the_earliest(spark):
    df = _valid(
        spark,
        [
            event(event_id="a", timestamp="2026-01-01T00:00:02+00:00", username="late"),
            event(event_id="a", timestamp="2026-01-01T00:00:01+00:00", username="early"),
            event(event_id="a", timestamp=None, username="no-time"),
        ],
    )
    # The row without timestamp is invalid; among the valid ones the earliest wins.
    rows = dedup_earliest(df).collect()
    assert [r.username for r in rows] == ["early"]


def test_dedup_earliest_nulls_last_and_repeatable(spark):
    schema = "event_id string, event_timestamp timestamp_ntz, v string"
    df = spark.createDataFrame(
        [("a", None, "n"), ("a", dt.datetime(2026, 1, 1), "z"), ("a", dt.datetime(2026, 1, 1), "b")], schema
    )
    out = dedup_earliest(df).collect()
    assert out[0].v == "b"  # earliest time, then by the rest of the row


def test_hot_id_with_many_copies_is_combined_map_side(spark):
    """One id with a third of all rows: the plan limits each group map-side
    (partial WindowGroupLimit below the exchange), and the result is one row."""
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("id"), F.col("id").cast("string"))).alias(
            "event_id"
        ),
        F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz").alias("event_timestamp"),
        (F.col("id") % 7).cast("string").alias("v"),
    )
    out = dedup_earliest(hot)
    assert out.count() == 20001
    plan = out._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_exchange


def _bronze(spark, rows):
    schema = (
        "event_id string, event_type string, user_id string, username string, country string, "
        "user_created_at timestamp_ntz, target_user_id string, target_username string, post_id string, "
        "post_creator_user_id string, post_created_at timestamp_ntz, hashtag string, comment_text string, "
        "event_timestamp timestamp_ntz"
    )
    cols = [f.split()[0] for f in schema.split(", ")]
    out = []
    for r in rows:
        d = dict.fromkeys(cols)
        d.update(r)
        out.append(tuple(d[c] for c in cols))
    return spark.createDataFrame(out, schema)


T0 = dt.datetime(2026, 1, 1, 12, 0, 0)


def test_user_dim_takes_first_seen_row_with_tie_break(spark):
    b = _bronze(
        spark,
        [
            dict(event_id="e2", user_id="u1", username="second", event_timestamp=T0),
            dict(event_id="e1", user_id="u1", username="first", event_timestamp=T0),  # tie → event_id
            dict(event_id="e0", user_id="u1", username="no-time", event_timestamp=None),  # NULLs last
            dict(event_id="e3", user_id=None, username="nobody", event_timestamp=T0),
        ],
    )
    rows = user_dim(b).collect()
    assert len(rows) == 1 and rows[0].username == "first" and rows[0].user_id == "u1"


def test_post_dim_renames(spark):
    b = _bronze(
        spark,
        [
            dict(event_id="e1", post_id="p1", post_creator_user_id="u9", hashtag="#x", post_created_at=T0, event_timestamp=T0),
            dict(event_id="e2", post_id="p1", post_creator_user_id="u8", hashtag="#y", event_timestamp=T0 + dt.timedelta(1)),
        ],
    )
    r = post_dim(b).collect()[0]
    assert (r.post_id, r.user_id, r.hashtag, r.created_at) == ("p1", "u9", "#x", T0)


def test_curated_reenriches_from_dims(spark):
    b = _bronze(
        spark,
        [
            dict(event_id="e1", event_type="post_created", user_id="u1", username="alice", post_id="p1",
                 post_creator_user_id="u1", hashtag="#a", event_timestamp=T0),
            # later event with a different (ignored) hashtag and an unknown target
            dict(event_id="e2", event_type="like", user_id="u2", username="bob", target_user_id="u404",
                 target_username="ghost", post_id="p1", post_creator_user_id="uX", hashtag="#other",
                 event_timestamp=T0 + dt.timedelta(minutes=1)),
        ],
    )
    users, posts = user_dim(b), post_dim(b)
    rows = {r.event_id: r for r in curated_events(b, users, posts).collect()}
    assert rows["e2"].hashtag == "#a"  # from the first-seen post row
    assert rows["e2"].post_creator_user_id == "u1"
    assert rows["e2"].target_username is None  # target never acted → NULL
    assert rows["e2"].username == "bob"


def test_rebuilding_layers_is_idempotent(spark, scratch):
    from ripplecast.plans.lakehouse import Lakehouse

    lake = Lakehouse(spark, scratch)
    lake.write_landing(messages_df(spark, [event(event_id="a"), event(event_id="b", user_id="user_26")]))
    lake.build_bronze()
    lake.build_silver()
    first = lake.curated().count(), lake.users().count()
    lake.build_silver()
    lake.build_silver()
    assert (lake.curated().count(), lake.users().count()) == first == (2, 2)


def test_curated_bounds_manifest_matches_the_table(spark, scratch):
    from pyspark.sql import functions as F

    from ripplecast.plans.lakehouse import Lakehouse
    from ripplecast.sources.driver_feed import driver_messages

    lake = Lakehouse(spark, scratch)
    lake.write_landing(driver_messages(spark, "/root/testdata/sf0.001"))
    lake.build_bronze()
    lake.build_silver()
    b = spark.read.parquet(lake.path("silver", "curated_bounds")).collect()
    cur = lake.curated().agg(
        F.max("event_timestamp").alias("mx"), F.min("event_timestamp").alias("mn"), F.count(F.lit(1)).alias("n")
    ).collect()[0]
    assert len(b) == 1
    assert (b[0].max_event_timestamp, b[0].min_event_timestamp, b[0].row_count) == (cur.mx, cur.mn, cur.n)
    # the latest time used by the gold queries is the manifest's
    assert spark.range(1).select(lake.latest_event_time().alias("t")).collect()[0].t == cur.mx


def test_single_pass_ingest_equals_lazy_layers(spark, scratch):
    from ripplecast.plans.lakehouse import Lakehouse
    from ripplecast.schema import PARSED_COLUMNS
    from ripplecast.sources.driver_feed import driver_messages

    lake = Lakehouse(spark, scratch)
    lake.write_landing(driver_messages(spark, "/root/testdata/sf0.001", 3))
    lake.build_bronze()
    written, lazy = lake.bronze().select(*PARSED_COLUMNS), lake.deduplicated()
    assert written.count() == feed_count("dedup_events")
    assert written.exceptAll(lazy).count() == 0 and lazy.exceptAll(written).count() == 0
    rej_written, rej_lazy = lake.rejects(), lake.rejected()
    assert rej_written.count() == feed_count("rejected_events")
    assert rej_written.exceptAll(rej_lazy).count() == 0 and rej_lazy.exceptAll(rej_written).count() == 0
