"""Incremental silver maintenance equals a full rebuild, including late events
that move a first-seen row and a target user who starts acting later."""

from __future__ import annotations

import json
import os

import pytest

from conftest import event
from ripplecast.plans.lakehouse import Lakehouse
from ripplecast.streaming.ingest import file_messages, start_ingest


def _write(path, items):
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(x) for x in items) + "\n")


def _like(eid, user, name, ts, post="post_1", creator="u_creator"):
    return event(event_id=eid, event_type="like", user_id=user, username=name, post_id=post,
                 post_creator_user_id=creator, hashtag="#a", timestamp=ts)


def _follow(eid, user, target, ts):
    return event(event_id=eid, event_type="follow", user_id=user, username=f"name_{user}", target_user_id=target,
                 post_id=None, post_creator_user_id=None, hashtag=None, post_created_at=None, timestamp=ts)


def _snapshot(lake):
    return (
        sorted(map(tuple, lake.users().collect())),
        sorted(map(tuple, lake.posts().collect())),
        sorted(map(tuple, lake.curated().collect())),
        tuple(lake.spark.read.parquet(lake.path("silver", "curated_bounds")).collect()[0]),
    )


def test_update_silver_equals_full_rebuild(spark, scratch):
    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    lake = Lakehouse(spark, os.path.join(scratch, "lake"))

    def ingest():
        q = start_ingest(file_messages(spark, land), lake.path("bronze"), lake.path("_ck"),
                         trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None

    # round 1: two days of events; u_target is only a target so far
    _write(os.path.join(land, "1.json"), [
        _like("a1", "u1", "first_name", "2026-01-01T10:00:00+00:00"),
        _like("a2", "u2", "two", "2026-01-01T11:00:00+00:00", post="post_2"),
        _follow("a3", "u2", "u_target", "2026-01-02T09:00:00+00:00"),
        _like("a4", "u3", "three", "2026-01-03T09:00:00+00:00"),
    ])
    ingest()
    lake.build_silver()
    assert lake.update_silver() is False  # nothing new
    before = {r.event_id: r for r in lake.curated().collect()}
    assert before["a3"].target_username is None

    # round 2: a late event moves u1's first-seen row earlier (new name), the
    # target starts acting, a duplicate of a1 arrives again, new events today
    _write(os.path.join(land, "2.json"), [
        _like("b1", "u1", "earlier_name", "2025-12-31T23:00:00+00:00"),
        _like("b2", "u_target", "the_target", "2026-01-04T08:00:00+00:00", post="post_3", creator="u3"),
        _like("a1", "u1", "first_name", "2026-01-01T10:00:00+00:00"),
        _like("b3", "u4", "four", "2026-01-04T09:00:00+00:00"),
    ])
    ingest()
    assert lake.update_silver() is True
    after = {r.event_id: r for r in lake.curated().collect()}
    assert after["a1"].username == "earlier_name"  # re-enriched old row
    assert after["a3"].target_username == "the_target"  # target now known
    assert after["a4"].username == "three"

    # round 3: one more event on a new day
    _write(os.path.join(land, "3.json"), [_like("c1", "u2", "two", "2026-01-05T12:00:00+00:00", post="post_2")])
    ingest()
    assert lake.update_silver() is True
    incremental = _snapshot(lake)

    lake.build_silver()  # full rebuild from all of bronze
    assert _snapshot(lake) == incremental
    assert len(incremental[2]) == 8  # a1 arrived twice


def test_cli_update_without_new_batches_is_a_no_op(spark, scratch):
    from ripplecast.jobs import update_batch

    lake = Lakehouse(spark, os.path.join(scratch, "lake"))
    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    _write(os.path.join(land, "1.json"), [_like("a1", "u1", "one", "2026-01-01T10:00:00+00:00")])
    q = start_ingest(file_messages(spark, land), lake.path("bronze"), lake.path("_ck"), trigger={"availableNow": True})
    q.awaitTermination()
    assert update_batch(lake) is True  # no silver yet: full build
    assert update_batch(lake) is False
    assert lake.gold("comment_sentiment").count() == 0 and lake.curated().count() == 1


def test_update_gold_equals_full_gold(spark, scratch):
    from ripplecast.plans.lakehouse import GoldParams

    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    params = GoldParams(trending_windows_minutes=(60, 1440, 4320), viral_window_minutes=1440, viral_threshold=1,
                        run_ts="2026-02-01 00:00:00")
    lake = Lakehouse(spark, os.path.join(scratch, "lake"), params)

    def ingest():
        q = start_ingest(file_messages(spark, land), lake.path("bronze"), lake.path("_ck"),
                         trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None

    def comment(eid, user, text, ts, post="post_1"):
        return event(event_id=eid, event_type="comment", user_id=user, comment_text=text, post_id=post,
                     post_creator_user_id="u_creator", hashtag="#a", timestamp=ts)

    _write(os.path.join(land, "1.json"), [
        _like("a1", "u1", "one", "2026-01-01T10:00:00+00:00"),
        comment("a2", "u2", "Amazing!", "2026-01-01T11:00:00+00:00"),
        _like("a3", "u3", "three", "2026-01-02T09:00:00+00:00", post="post_2", creator="u9"),
    ])
    ingest()
    lake.build_silver()
    lake.build_gold()
    # a late post_created moves post_2's first-seen row: its creator changes for old likes
    _write(os.path.join(land, "2.json"), [
        event(event_id="b0", event_type="post_created", user_id="u7", post_id="post_2", post_creator_user_id="u7",
              hashtag="#b", timestamp="2025-12-31T08:00:00+00:00"),
        comment("b1", "u4", "noted.", "2026-01-03T12:00:00+00:00"),
        _like("b2", "u5", "five", "2026-01-03T13:00:00+00:00", post="post_2", creator="u7"),
    ])
    ingest()
    assert lake.update_silver()
    lake.update_gold()

    def gold_snapshot():
        return {n: sorted(map(tuple, lake.gold(n).collect()))
                for n in ("trending_hashtags", "viral_posts", "influencer_ranking", "comment_sentiment")}

    incremental = gold_snapshot()
    ranking = {r[0]: r for r in incremental["influencer_ranking"]}
    assert "u7" in ranking and "u9" not in ranking  # post_2's likes moved to its earlier creator
    lake.build_silver()
    lake.build_gold()
    assert gold_snapshot() == incremental


def test_gold_repairs_every_date_of_a_failed_update(spark, scratch, monkeypatch):
    """Gold that fails at any of its writes loses no date, also when silver goes on meanwhile."""
    from ripplecast import jobs
    from ripplecast.plans.lakehouse import GoldParams

    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    lake = Lakehouse(spark, os.path.join(scratch, "lake"), GoldParams(run_ts="2026-02-01 00:00:00"))
    monkeypatch.setattr(jobs, "register_catalog", lambda lake: None)

    def arrive(n, day):
        _write(os.path.join(land, f"{n}.json"), [
            _like(f"l{n}", "u1", "one", f"2026-01-0{day}T10:00:00+00:00"),
            event(event_id=f"c{n}", event_type="comment", user_id="u2", comment_text="Amazing!", post_id="post_1",
                  post_creator_user_id="u_creator", hashtag="#a", timestamp=f"2026-01-0{day}T11:00:00+00:00"),
        ])
        q = start_ingest(file_messages(spark, land), lake.path("bronze"), lake.path("_ck"), trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None

    def gold():
        return {n: sorted(map(tuple, lake.gold(n).collect())) for n in ("influencer_ranking", "comment_sentiment")}

    arrive(1, 1)
    lake.build_silver()
    lake.build_gold()
    for n, step in enumerate(("_write_dated", "_write_ranking", "_settle"), start=2):
        arrive(n, n)
        with monkeypatch.context() as m:
            def fail(*_, **__):
                raise RuntimeError("lost")
            m.setattr(lake, step, fail)
            with pytest.raises(RuntimeError):
                jobs.update_batch(lake)
    arrive(5, 5)
    assert jobs.update_batch(lake)
    assert not lake.gold_pending()
    updated = gold()
    assert len(updated["comment_sentiment"]) == 5
    lake.build_silver()
    lake.build_gold()
    assert gold() == updated


def test_silver_update_that_fails_at_any_write_is_made_good(spark, scratch, monkeypatch):
    """After a failure at each write the next update gives a full build's tables; an id in two batches stays twice."""
    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    lake = Lakehouse(spark, os.path.join(scratch, "lake"))
    arrived = 0

    def arrive():
        nonlocal arrived
        arrived += 1
        _write(os.path.join(land, f"{arrived}.json"), [
            _like("same", "u1", "one", "2026-01-01T10:00:00+00:00"),
            _like(f"l{arrived}", f"u{arrived}", f"name{arrived}", f"2026-01-{arrived:02d}T10:00:00+00:00"),
        ])
        # A checkpoint of its own for each arrival: ids repeat across batches.
        q = start_ingest(file_messages(spark, os.path.join(land, f"{arrived}.json*")), lake.path("bronze"),
                         lake.path(f"_ck{arrived}"), trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None

    arrive()
    lake.build_silver()
    for step in ("_write_bounds", "_write_progress", "_write_curated", "_delete"):
        arrive()
        with monkeypatch.context() as m:
            done = getattr(lake, step)

            def then_fail(*args, **kwargs):
                done(*args, **kwargs)
                if step == "_write_curated":  # an overwrite that fails has already removed its table
                    lake._delete(lake.path("silver", "user_dim"))
                raise RuntimeError("lost")

            m.setattr(lake, step, then_fail)
            with pytest.raises(RuntimeError):
                lake.update_silver()
        assert lake.update_silver() is (step != "_delete")
        assert lake.update_silver() is False
        assert lake._children(lake.path("silver", "_staging")) == []
        assert lake.curated().where("event_id = 'same'").count() == arrived
    updated = _snapshot(lake)
    lake.build_silver()
    assert _snapshot(lake) == updated
    assert updated[3][2] == 2 * arrived


def test_catalog_shows_committed_batches_only(spark, scratch):
    from ripplecast.plans.lakehouse import register_catalog
    from ripplecast.streaming.ingest import batch_folder

    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    lake = Lakehouse(spark, os.path.join(scratch, "lake"))
    _write(os.path.join(land, "1.json"), [_like("a1", "u1", "one", "2026-01-01T10:00:00+00:00")])
    q = start_ingest(file_messages(spark, land), lake.path("bronze"), lake.path("_ck"), trigger={"availableNow": True})
    q.awaitTermination()
    torn = batch_folder(lake.path("bronze"), "torn", 7)
    lake.bronze().write.parquet(torn)
    os.remove(os.path.join(torn, "_SUCCESS"))

    def rows():
        assert "cat_bronze.raw_events" in register_catalog(lake, "cat_")
        return spark.sql("SELECT count(*) FROM cat_bronze.raw_events").first()[0]

    assert rows() == 1
    open(os.path.join(torn, "_SUCCESS"), "w").close()
    assert rows() == 2
    os.remove(os.path.join(torn, "_SUCCESS"))
    assert rows() == 1
    spark.sql("DROP DATABASE cat_bronze CASCADE")


def test_bronze_read_sees_new_batches_after_update(spark, scratch):
    lake = Lakehouse(spark, os.path.join(scratch, "lake"))
    land = os.path.join(scratch, "landing")
    os.makedirs(land)

    def ingest():
        q = start_ingest(file_messages(spark, land), lake.path("bronze"), lake.path("_ck"),
                         trigger={"availableNow": True})
        q.awaitTermination()

    _write(os.path.join(land, "1.json"), [_like("a1", "u1", "one", "2026-01-01T10:00:00+00:00")])
    ingest()
    lake.build_silver()
    assert lake.bronze().count() == 1
    _write(os.path.join(land, "2.json"), [_like("a2", "u2", "two", "2026-01-02T10:00:00+00:00")])
    ingest()
    assert lake.update_silver()
    assert lake.bronze().count() == 2 and lake.curated().count() == 2


def test_dated_gold_writes_one_small_file_a_date(spark, scratch):
    """Rows of two dates in eight partitions each: a date folder gets one file, not eight."""
    lake = Lakehouse(spark, os.path.join(scratch, "lake"))
    rows = spark.range(0, 80, 1, 8).selectExpr(
        "concat('u', id) AS user_id", "id AS n", "date_add(DATE '2026-01-01', cast(id % 2 AS int)) AS event_date"
    )
    lake._write_dated(rows, "dated", dynamic=False)
    folder = lake.path("gold", "dated")
    dates = [d for d in os.listdir(folder) if d.startswith("event_date=")]
    assert len(dates) == 2
    assert all(sum(f.endswith(".parquet") for f in os.listdir(os.path.join(folder, d))) == 1 for d in dates)
    assert spark.read.parquet(folder).count() == 80
