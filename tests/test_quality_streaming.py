"""Quality checks on seeded faults; streaming ingest equals batch, survives a
failing sink (replay) and a restart (no duplicates)."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from conftest import curated_df, event
from ripplecast.operators import quality as Q

T = dt.datetime(2026, 5, 1, 12, 0, 0)


def test_quality_checks_find_seeded_faults(spark):
    cur = curated_df(
        spark,
        [
            dict(event_id="d", user_id="u1", post_id="p1", event_type="like", event_timestamp=T),
            dict(event_id="d", user_id="u1", post_id="p1", event_type="like", event_timestamp=T),
            dict(event_id="x", user_id="u_orphan", post_id="p_orphan", event_type="poke", event_timestamp=None),
            dict(event_id="y", user_id=None, event_type=None, event_timestamp=T),
        ],
    )
    users = spark.createDataFrame(
        [("u1", "a", "DE", T), ("u1", "b", None, T)], "user_id string, username string, country string, created_at timestamp_ntz"
    )
    posts = spark.createDataFrame([("p1", "u1", "#a", None)], "post_id string, user_id string, hashtag string, created_at timestamp_ntz")
    assert [(r.event_id, r.duplicate_count) for r in Q.duplicate_events(cur).collect()] == [("d", 2)]
    m = Q.missing_fields(cur).collect()[0]
    assert (m.null_event_id, m.null_event_type, m.null_user_id, m.null_event_timestamp) == (0, 1, 1, 1)
    assert [r.event_type for r in Q.invalid_types(cur).collect()] == ["poke"]  # NULL type not reported
    assert [r.user_id for r in Q.orphan_users(cur, users).collect()] == ["u_orphan"]
    assert [r.post_id for r in Q.orphan_posts(cur, posts).collect()] == ["p_orphan"]
    assert [(r.user_id, r.duplicate_count) for r in Q.duplicate_users(users).collect()] == [("u1", 2)]
    assert Q.duplicate_posts(posts).count() == 0
    un = Q.user_dim_nulls(users).collect()[0]
    assert (un.null_user_id, un.null_username, un.null_country) == (0, 0, 1)
    pn = Q.post_dim_nulls(posts).collect()[0]
    assert pn.null_created_at == 1
    dist = Q.event_type_distribution(cur).collect()
    assert dist[0].event_type == "like" and dist[0].event_count == 2
    rep = {r.check: r.violations for r in Q.quality_report(cur, users, posts).collect()}
    assert rep["duplicate_events"] == 1 and rep["orphan_users"] == 1 and rep["duplicate_posts"] == 0
    assert rep["missing_fields"] == 3


def test_previews_are_ordered_and_capped(spark):
    cur = curated_df(spark, [dict(event_timestamp=T + dt.timedelta(seconds=i)) for i in range(25)])
    rows = Q.preview_curated(cur).collect()
    assert len(rows) == 10 and rows[0].event_timestamp == T


def _write_lines(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_equals_batch_and_restart_adds_nothing(spark, scratch):
    import json

    from ripplecast.operators.dedup import dedup_earliest
    from ripplecast.functions.parsing import parse_messages
    from ripplecast.operators.validate import valid_events
    from ripplecast.schema import PARSED_COLUMNS
    from ripplecast.streaming.ingest import file_messages, read_batches, start_ingest

    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    msgs1 = [json.dumps(event(event_id=f"e{i}", timestamp=f"2026-01-01T00:00:{i:02d}+00:00")) for i in range(10)]
    msgs2 = [json.dumps(event(event_id=f"e{i}", timestamp=f"2026-01-01T00:00:{i:02d}+00:00")) for i in range(5, 15)]
    _write_lines(os.path.join(land, "a.json"), msgs1 + msgs1[:2])  # duplicate in the same file
    _write_lines(os.path.join(land, "b.json"), msgs2 + ["{broken"])  # duplicates in a later file
    bronze, ck = os.path.join(scratch, "bronze"), os.path.join(scratch, "ck")

    def run():
        q = start_ingest(file_messages(spark, land, 1), bronze, ck, trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None
        return q

    q1 = run()
    got = read_batches(spark, bronze).select(*PARSED_COLUMNS)
    assert got.count() == 15
    batch = dedup_earliest(valid_events(parse_messages(spark.read.text(land))))
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    q2 = run()  # restart on the same checkpoint: nothing new
    assert q2.id == q1.id
    assert read_batches(spark, bronze).count() == 15


def test_failed_batch_is_replayed_without_duplicates(spark, scratch):
    import json

    from ripplecast.functions.parsing import parse_messages
    from ripplecast.operators.dedup import dedup_stream_exact
    from ripplecast.operators.validate import valid_events
    from ripplecast.streaming.ingest import batch_folder, file_messages, idempotent_batch_sink, read_batches

    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    _write_lines(os.path.join(land, "a.json"), [json.dumps(event(event_id=f"e{i}")) for i in range(8)])
    bronze, ck = os.path.join(scratch, "bronze"), os.path.join(scratch, "ck")
    sink = idempotent_batch_sink(bronze)
    state = {"fail": True}

    def flaky(df, batch_id):
        sink(df, batch_id)  # output written ...
        if state["fail"]:
            state["fail"] = False
            raise RuntimeError("injected failure after write, before commit")

    def start():
        stream = dedup_stream_exact(valid_events(parse_messages(file_messages(spark, land))))
        return (
            stream.writeStream.foreachBatch(flaky)
            .option("checkpointLocation", ck)
            .trigger(availableNow=True)
            .start()
        )

    q = start()
    with pytest.raises(Exception):
        q.awaitTermination()
    q = start()  # restart replays batch 0 into the same folder
    q.awaitTermination()
    assert os.path.isdir(batch_folder(bronze, q.id, 0))
    assert read_batches(spark, bronze, columns=("event_id",)).count() == 8


def test_watermark_dedup_forgets_old_ids_and_drops_late_rows(spark, scratch):
    import json

    from ripplecast.schema import PARSED_COLUMNS
    from ripplecast.streaming.ingest import file_messages, read_batches, start_ingest

    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    bronze, ck = os.path.join(scratch, "bronze"), os.path.join(scratch, "ck")

    def step(name, items):
        _write_lines(os.path.join(land, name), [json.dumps(event(event_id=i, timestamp=t)) for i, t in items])
        q = start_ingest(file_messages(spark, land), bronze, ck, dedup="watermark", watermark_delay="10 minutes",
                         trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None

    step("1.json", [("a", "2026-01-01T00:00:00+00:00"), ("a", "2026-01-01T00:00:00+00:00")])
    step("2.json", [("b", "2026-01-01T01:00:00+00:00")])  # watermark → 00:50
    step("3.json", [("a", "2026-01-01T00:55:00+00:00"),  # id a expired: emitted again
                    ("c", "2026-01-01T00:10:00+00:00")])  # older than watermark: dropped as late
    ids = sorted(r.event_id for r in read_batches(spark, bronze).select(*PARSED_COLUMNS).collect())
    assert ids == ["a", "a", "b"]


def test_kafka_options_builder():
    from ripplecast.streaming.ingest import kafka_options

    o = kafka_options("localhost:9092", "social_media_events")
    assert o == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "social_media_events",
        "startingOffsets": "latest",
    }


def test_empty_micro_batch_writes_nothing(spark, scratch):
    import json

    from ripplecast.streaming.ingest import committed_batches, file_messages, start_ingest

    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    bronze, ck = os.path.join(scratch, "bronze"), os.path.join(scratch, "ck")
    _write_lines(os.path.join(land, "a.json"), [json.dumps(event(event_id="a"))])
    _write_lines(os.path.join(land, "b.json"), [json.dumps(event(event_id=None)), "{broken"])  # all invalid
    _write_lines(os.path.join(land, "c.json"), [json.dumps(event(event_id="a"))])  # only a duplicate
    q = start_ingest(file_messages(spark, land, 1), bronze, ck, trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    assert len(committed_batches(spark, bronze)) == 1
