"""What is exchanged and written on the way: no more than later steps read, with the same rows."""

from __future__ import annotations

import collections
import datetime as dt
import os

import numpy as np
from conftest import curated_df, event, messages_df

from ripplecast.operators import gold as G
from ripplecast.plans import driver as D
from ripplecast.plans.lakehouse import Lakehouse
from ripplecast.sources.driver_feed import social_messages
from ripplecast.streaming import two_tier as T
from ripplecast.streaming import viral as V
from ripplecast.streaming.ingest import (
    clean_stream,
    committed_batches,
    file_messages,
    idempotent_batch_sink,
    read_batches,
)

ONCE = {"availableNow": True}


def _tables(spark, folder, n=260):
    t0 = dt.datetime(2024, 1, 1)
    kinds = ("click", "view", "purchase", "signup", "error")
    rows = [(i, t0 + dt.timedelta(minutes=i), i % 9, kinds[i % 5], 1.0, '{"k": %d}' % (i % 100)) for i in range(n)]
    rows += [(None, None, None, None, None, None), rows[20]]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    events = spark.createDataFrame(rows, schema)
    nation = spark.createDataFrame([(i, f"n{i}") for i in range(25)], "n_nationkey int, n_name string")
    events.write.parquet(f"{folder}/events.parquet")
    nation.write.parquet(f"{folder}/nation.parquet")
    return events, nation


def _files(folder):
    return [f for _, _, names in os.walk(folder) for f in names if f.startswith("part-")]


# ------------------------------------------------------------- landing (F1-F7)
def test_messages_are_composed_after_the_exchange_into_segments(spark, scratch):
    events, nation = _tables(spark, scratch)
    for late_by in (None, 100):
        topic = social_messages(events, nation, 4, late_by)
        above, below = topic._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression", 1)
        assert "AS _json#" in above and "AS _json#" not in below
        assert topic.rdd.getNumPartitions() == 4
        plain = social_messages(events, nation)
        assert collections.Counter(topic.collect()) == collections.Counter(plain.collect())


def test_landing_is_compressed_and_reads_back_whole(spark, scratch):
    messages = messages_df(spark, [event(event_id=f"e{i}") for i in range(50)] + ["no json {", ""])
    lake = Lakehouse(spark, scratch)
    lake.write_landing(messages)
    assert _files(lake.path("landing")) and all(f.endswith(".gz") for f in _files(lake.path("landing")))
    assert collections.Counter(lake.landing().collect()) == collections.Counter(messages.collect())


def test_batch_ingest_packs_its_stage_bronze_and_rejects(spark, scratch):  # F3, F4
    lake = Lakehouse(spark, scratch)
    lake.write_landing(messages_df(spark, [event(event_id="a"), event(event_id="a"), event(event_id="b", user_id=None)]))
    lake.build_bronze()
    for part, rows in (("_stage", 3), ("bronze", 1), ("rejects", 1)):
        assert all(f.endswith(".zstd.parquet") for f in _files(lake.path(part)))
        assert spark.read.parquet(lake.path(part)).count() == rows


def test_a_micro_batch_is_written_without_being_held(spark, scratch, monkeypatch):  # F5, F6
    def held(*_):
        raise AssertionError("the micro-batch is persisted")

    batch = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    monkeypatch.setattr(type(batch), "persist", held)
    runs = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            runs.add(1)
            yield row

    once = spark.createDataFrame(batch.rdd.mapPartitions(counted), batch.schema)
    sink = idempotent_batch_sink(scratch)
    sink(once, 0)
    sink(batch.where("n > 5"), 1)
    assert runs.value == 2
    assert [p[-10:] for p in committed_batches(spark, scratch)] == ["batch_id=0"]
    assert sorted(map(tuple, read_batches(spark, scratch, ("n", "s")).collect())) == [(1, "a"), (2, "b")]


# ------------------------------------------------------- two tiers (F1, F6, F7)
def test_streams_of_the_disordered_topic_write_no_topic_in_order(spark, scratch):
    _tables(spark, scratch)
    assert D.stream_rejects_two_tier(spark, scratch).count() > 0
    assert D.stream_dimension("user_dim")(spark, scratch).count() == 9
    assert not os.path.exists(D.driver_lake(spark, scratch, "root").path("landing").removeprefix("file:"))


def test_only_rejects_take_their_raw_text_through_the_exchange(spark, scratch):
    messages_df(spark, [event(), event(event_id="b", user_id=None), "no json {"]).coalesce(1).write.text(f"{scratch}/in")
    rows = []
    stream = T.judged_once(T.arrivals(spark, f"{scratch}/in"), "1 hour").writeStream
    stream = stream.foreachBatch(lambda df, _: rows.extend(df.collect())).option("checkpointLocation", f"{scratch}/ck")
    stream.trigger(**ONCE).start().awaitTermination()
    assert len(rows) == 3
    assert all((r["value"] is None) == (r["outcome"] == "bronze") for r in rows)


# ------------------------------------------------------------- viral peaks (F2)
def _likes():
    return [("p", "10:00"), ("p", "10:00"), ("p", "10:00"), ("p", "10:05"), ("p", "10:06"), ("q", "10:00"), ("q", "11:00")]


def test_likes_of_an_instant_are_counted_as_one_row(spark, monkeypatch):
    rows = [{"event_type": "like", "post_id": p, "event_timestamp": f"2026-01-01T{t}:00"} for p, t in _likes()]
    seen = []
    real = G.global_running_sum
    monkeypatch.setattr(G, "global_running_sum", lambda df, *a, **k: (seen.append(df.count()), real(df, *a, **k))[1])
    got = G.viral_posts_any_window(curated_df(spark, rows), 5, 2).collect()
    at = lambda m: dt.datetime(2026, 1, 1, 10, m)
    assert [(r["post_id"], r["like_count"], r["window_end"]) for r in got] == [("p", 4, at(5))]
    assert seen == [6]  # two rows for each of the three instants of p


def test_the_log_of_likes_counts_copies_of_an_instant_over_micro_batches(spark, scratch):
    for k in range(2):  # p: two likes at 10:00 in each file, of other ids
        items = [event(event_id=f"{k}{i}", post_id="p", timestamp="2026-01-01T10:00:00+00:00") for i in range(2)]
        messages_df(spark, items).coalesce(1).write.mode("append").text(f"{scratch}/in")
    events = clean_stream(file_messages(spark, f"{scratch}/in", 1), columns=V.LIKE_COLUMNS)
    assert tuple(events.columns) == V.LIKE_COLUMNS
    V.start_peaks(events, f"{scratch}/out", f"{scratch}/ck", 5, 3, ONCE).awaitTermination()
    assert [r["n"] for r in V.read_likes(spark, f"{scratch}/out").collect()] == [2, 2]
    assert [r["like_count"] for r in V.read_peaks(spark, f"{scratch}/out", 5).collect()] == [4]


# ------------------------------------------------------------- packing (op6)
def test_cached_words_are_looked_up():
    from ripplecast.llm.packing import WordIds

    coder = WordIds.__new__(WordIds)
    coder._clear()
    some = np.array([1, 3, 9, 10], np.uint64)
    assert coder._knows(some).tolist() == [False] * 4
    coder.known = np.array([3, 7, 9], np.uint64)
    assert coder._knows(some).tolist() == [False, True, True, False]
    assert coder._knows(some[:0]).tolist() == []
