"""Streaming dimensions, two-tier ingest and exact viral peaks: late events, late copies, replays, bounded state."""

from __future__ import annotations

import json
import os
import random

import pytest
from conftest import curated_df, event

from ripplecast.operators import gold as G
from ripplecast.operators import silver as S
from ripplecast.plans import driver as D
from ripplecast.streaming import two_tier as T
from ripplecast.streaming import viral as V
from ripplecast.streaming.analytics import start_append, top_per_window, user_sessions
from ripplecast.streaming.dimensions import dimension_changes, read_dimension, start_dimension
from ripplecast.streaming.ingest import clean_stream, file_messages, read_batches

HOUR = 3600
SMOKE = "/root/testdata/sf0.001"


class Topic:
    """A landing folder whose files arrive an hour apart."""

    def __init__(self, folder):
        self.folder, self.n = folder, 0
        os.makedirs(folder)

    def arrive(self, *items):
        self.n += 1
        path = os.path.join(self.folder, f"{self.n:04d}.json")
        with open(path, "w") as f:
            f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in items) + "\n")
        os.utime(path, (1_700_000_000 + self.n * HOUR,) * 2)


def _at(minute, **fields):
    return event(timestamp=f"2026-01-01T10:{minute:02d}:00+00:00", **fields)


def _done(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


ONCE = {"availableNow": True}


# ------------------------------------------------------------------ dimensions
def test_dimension_emits_first_sights_and_corrections_only(spark, scratch):
    topic, out = Topic(f"{scratch}/in"), f"{scratch}/out"

    def run():
        _done(start_dimension(file_messages(spark, topic.folder, 1), "user_dim", out, f"{scratch}/ck", ONCE))
        names = {r["user_id"]: (r["username"], r["country"]) for r in read_dimension(spark, out, "user_dim").collect()}
        return names, dimension_changes(spark, out, "user_dim").count()

    topic.arrive(_at(30, event_id="e1", user_id="u1", username="late", country="A"), _at(5, event_id="e2", user_id="u2", username="b"))
    assert run() == ({"u1": ("late", "A"), "u2": ("b", "Germany")}, 2)
    # a later event and a redelivered copy change nothing
    topic.arrive(_at(40, event_id="e3", user_id="u1", username="later"), _at(5, event_id="e2", user_id="u2", username="b"))
    assert run() == ({"u1": ("late", "A"), "u2": ("b", "Germany")}, 2)
    # an earlier event corrects the row; an equal time goes by event id
    topic.arrive(_at(10, event_id="e4", user_id="u1", username="first", country="C"), _at(5, event_id="e1x", user_id="u2", username="tie"))
    assert run() == ({"u1": ("first", "C"), "u2": ("tie", "Germany")}, 4)
    assert run()[1] == 4  # nothing new on a rerun


def test_dimension_over_many_batches_equals_batch(spark, scratch):
    rng = random.Random(3)
    items = [
        _at(rng.randrange(60), event_id=f"e{i}", post_id=f"p{rng.randrange(8)}", hashtag=f"#{rng.randrange(5)}", post_creator_user_id=f"c{i}")
        for i in range(80)
    ]
    topic = Topic(f"{scratch}/in")
    for k in range(8):
        topic.arrive(*items[k::8])
    query = _done(start_dimension(file_messages(spark, topic.folder, 1), "post_dim", f"{scratch}/out", f"{scratch}/ck", ONCE))
    assert sum(p["numInputRows"] > 0 for p in map(lambda p: json.loads(p.json), query.recentProgress)) == 8
    from ripplecast.functions.parsing import parse_messages
    from ripplecast.operators.validate import valid_events

    batch = S.post_dim(valid_events(parse_messages(spark.read.text(topic.folder))))
    got = read_dimension(spark, f"{scratch}/out", "post_dim")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.select(*got.columns).collect()))


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver data not present")
def test_feed_tells_first_from_last(spark):
    """A dimension of last instead of first events differs from the right one on the driver feed."""
    bronze = D.driver_lake(spark, SMOKE, "bronze").bronze()
    for key, right, columns in (("user_id", S.user_dim, ("username", "country")), ("post_id", S.post_dim, ("hashtag",))):
        source = {c: c for c in columns}
        rows = sorted(
            (r for r in bronze.select(key, "event_timestamp", "event_id", *source).collect() if r[key]), key=lambda r: r[1:3]
        )
        last = {r[key]: tuple(r[c] for c in columns) for r in rows}
        first = {r[key]: tuple(r[c] for c in columns) for r in right(bronze).collect()}
        assert sum(last[k] != first[k] for k in first) > len(first) // 3


# -------------------------------------------------------------------- two tiers
def _two_tier(spark, topic, root, same_time=False):
    return _done(
        T.start_two_tier(T.arrivals(spark, topic.folder, 1), root, f"{root}/_ck", ttl="90 minutes", same_time=same_time, trigger=ONCE)
    )


@pytest.mark.parametrize("same_time", [False, True])
def test_copies_are_found_in_both_tiers_and_state_is_bounded(spark, scratch, same_time):
    topic, root = Topic(f"{scratch}/in"), f"{scratch}/out"
    items = [_at(i % 60, event_id=f"e{i}") for i in range(90)]
    bad = _at(1, event_id="bad", user_id=None)
    for k in range(9):
        old = [items[k * 10 - 70]] if k >= 7 else []  # a copy seven hours later
        recent = [items[k * 10 - 1]] if k else []
        topic.arrive(*items[k * 10 : k * 10 + 10], *recent, *old, bad, bad, "no json {")
    query = _two_tier(spark, topic, root, same_time)
    assert sorted(r["event_id"] for r in T.read_bronze(spark, root).collect()) == sorted(f"e{i}" for i in range(90))
    assert T.read_rejects(spark, root).count() == 27  # every copy of a reject is kept
    assert not any(files for _, _, files in os.walk(f"{root}/_late"))  # nothing but the committed folders stays
    commits = {r["batch_id"]: r for r in T.read_commits(spark, root).collect()}
    assert [commits[k]["late_copies"] for k in sorted(commits)] == [0] * 7 + [1, 1]
    state = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert len(state) >= 9 and max(state) <= 5 * 13 < 90 + 27  # at most the rows of some hours
    assert state[-1] < 90


def test_an_id_with_another_time_is_a_copy_unless_times_are_trusted(spark, scratch):
    topic, root = Topic(f"{scratch}/in"), f"{scratch}/out"
    topic.arrive(_at(1, event_id="x"))
    for k in range(5):
        topic.arrive(_at(2, event_id=f"filler{k}"))
    topic.arrive(event(event_id="x", timestamp="2026-02-02T00:00:00+00:00"))
    _two_tier(spark, topic, root)
    assert T.read_bronze(spark, root).where("event_id = 'x'").count() == 1


@pytest.mark.parametrize("kind", ["bronze", "ids", "rejects", "_commits"])
def test_a_failed_batch_is_invisible_and_replayed(spark, scratch, monkeypatch, kind):
    topic, root = Topic(f"{scratch}/in"), f"{scratch}/out"
    topic.arrive(_at(1, event_id="a"), _at(1, event_id="b", user_id=None))
    _two_tier(spark, topic, root)
    topic.arrive(_at(2, event_id="c"), _at(1, event_id="a"), _at(2, event_id="d", user_id=None))
    good = T.batch_folder

    def failing(path, query_id, batch_id):
        if path.endswith(f"/{kind}") and batch_id > 0:
            raise OSError("disk gone")
        return good(path, query_id, batch_id)

    monkeypatch.setattr(T, "batch_folder", failing)
    query = T.start_two_tier(T.arrivals(spark, topic.folder, 1), root, f"{root}/_ck", ttl="90 minutes", trigger=ONCE)
    with pytest.raises(Exception, match="disk gone"):
        query.awaitTermination()
    monkeypatch.setattr(T, "batch_folder", good)
    assert [r["event_id"] for r in T.read_bronze(spark, root).collect()] == ["a"]
    assert T.read_rejects(spark, root).count() == 1
    _two_tier(spark, topic, root)
    assert sorted(r["event_id"] for r in T.read_bronze(spark, root).collect()) == ["a", "c"]
    assert sorted(r["event_id"] for r in T.read_rejects(spark, root).collect()) == ["b", "d"]


def test_processing_time_stands_in_for_arrival(spark, scratch):
    topic, root = Topic(f"{scratch}/in"), f"{scratch}/out"
    topic.arrive(_at(1, event_id="a"), _at(1, event_id="a"))
    topic.arrive(_at(1, event_id="a"), _at(3, event_id="b"))
    messages = T.stamped(file_messages(spark, topic.folder, 1))
    _done(T.start_two_tier(messages, root, f"{root}/_ck", ttl="1 hour", trigger=ONCE))
    assert sorted(r["event_id"] for r in T.read_bronze(spark, root).collect()) == ["a", "b"]


# ------------------------------------------------------------------ viral peaks
@pytest.mark.parametrize("seed", [1, 2])
def test_peaks_on_a_stream_equal_batch(spark, scratch, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(160):
        post = "hot" if i % 3 == 0 else f"p{rng.randrange(5)}"
        day, minute = rng.choice([(1, rng.randrange(60)), (2, 0), (1, 59)]), rng.randrange(60)
        rows.append({"event_id": f"e{i}", "event_type": "like", "post_id": post, "event_timestamp": f"2026-01-0{day[0]}T{day[1] % 24:02d}:{minute:02d}:00"})
    rng.shuffle(rows)
    landing = f"{scratch}/in"
    schema = curated_df(spark, rows[:1]).schema
    for k in range(4):  # in disorder: likes of any age in every micro-batch
        curated_df(spark, rows[k::4]).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    _done(V.start_peaks(stream, f"{scratch}/out", f"{scratch}/ck", 90, 3, ONCE))
    got = V.read_peaks(spark, f"{scratch}/out", 90)
    want = G.viral_posts_any_window(curated_df(spark, rows), 90, 3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert got.count() > 1


def test_no_likes_no_peaks(spark, scratch):
    topic = Topic(f"{scratch}/in")
    topic.arrive(_at(1, event_type="comment", event_id="c", comment_text="x"))
    events = clean_stream(file_messages(spark, topic.folder))
    _done(V.start_peaks(events, f"{scratch}/out", f"{scratch}/ck", 5, 0, ONCE))
    assert V.read_peaks(spark, f"{scratch}/out", 5).collect() == []


# --------------------------------------------------------------- closed windows
def test_sessions_close_with_the_watermark(spark, scratch):
    topic = Topic(f"{scratch}/in")
    topic.arrive(_at(0, event_id="a", user_id="u"), _at(4, event_id="b", user_id="u"))
    topic.arrive(_at(12, event_id="c", user_id="u"), _at(30, event_id="d", user_id="v"))
    stream = user_sessions(clean_stream(file_messages(spark, topic.folder, 1)), 5, "1 minute")
    _done(start_append(stream, f"{scratch}/out", f"{scratch}/ck", ONCE))
    schema = "user_id string, session_start timestamp_ntz, session_end timestamp_ntz, event_count bigint"
    rows = read_batches(spark, f"{scratch}/out", [x.split()[0] for x in schema.split(", ")], schema).collect()
    assert sorted((r["user_id"], r["session_start"].minute, r["session_end"].minute, r["event_count"]) for r in rows) == [
        ("u", 0, 4, 2), ("u", 12, 12, 1),
    ]


def test_top_per_window_breaks_ties_by_hashtag(spark):
    rows = [("#b", 1, 2, 3), ("#a", 1, 2, 3), ("#c", 1, 2, 9), ("#z", 5, 6, 1)]
    counts = spark.createDataFrame(rows, "hashtag string, window_start int, window_end int, event_count long")
    got = sorted((r["window_start"], r["rank"], r["hashtag"]) for r in top_per_window(counts, 2).collect())
    assert got == [(1, 1, "#c"), (1, 2, "#a"), (5, 1, "#z")]
