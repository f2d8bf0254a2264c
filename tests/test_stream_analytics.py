"""Streaming windowed analytics: alerts only for closed windows, late rows
dropped by the watermark, batch and stream forms agree on closed windows."""

from __future__ import annotations

import datetime as dt
import json
import os

from conftest import event
from ripplecast.streaming.analytics import hashtag_counts, start_append, viral_alerts
from ripplecast.streaming.ingest import clean_stream, file_messages, read_batches


def _write(path, items):
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(x) for x in items) + "\n")


def _like(i, when, post="p1", tag="#a"):
    return event(event_id=f"{post}-{i}-{when}", post_id=post, hashtag=tag, timestamp=when)


def test_viral_alerts_emit_closed_windows_and_drop_late_rows(spark, scratch):
    land, out, ck = (os.path.join(scratch, x) for x in ("landing", "out", "ck"))
    os.makedirs(land)

    def run():
        stream = viral_alerts(clean_stream(file_messages(spark, land)), window_minutes=5, slide_minutes=5,
                              threshold=3, watermark_delay="1 minute")
        q = start_append(stream, out, ck, trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None
        cols = ("post_id", "window_start", "window_end", "like_count")
        schema = "post_id string, window_start timestamp_ntz, window_end timestamp_ntz, like_count bigint"
        return sorted((r.post_id, r.window_start, r.like_count)
                      for r in read_batches(spark, out, columns=cols, schema=schema).collect())

    # 4 likes in [10:00, 10:05), 2 likes in [10:05, 10:10)
    _write(os.path.join(land, "1.json"),
           [_like(i, f"2026-01-01T10:0{i}:00+00:00") for i in range(4)]
           + [_like(9, "2026-01-01T10:06:00+00:00"), _like(8, "2026-01-01T10:07:00+00:00")])
    # watermark after the data: 10:07 - 1 min = 10:06, so [10:00, 10:05) is closed and alerted
    alert = [("p1", dt.datetime(2026, 1, 1, 10, 0), 4)]
    assert run() == alert
    # an event at 10:20 moves the watermark to 10:19: [10:05, 10:10) closes with 2 likes, no alert
    _write(os.path.join(land, "2.json"), [_like(20, "2026-01-01T10:20:00+00:00", post="p2")])
    got = run()
    assert got == alert
    # five late likes for the closed window [10:05, 10:10) are dropped: still no alert for it
    _write(os.path.join(land, "3.json"), [_like(i, "2026-01-01T10:08:00+00:00") for i in range(10, 15)])
    assert run() == got


def test_hashtag_counts_batch_form(spark):
    from pyspark.sql import functions as F

    from conftest import curated_df

    rows = [dict(hashtag="#a", event_timestamp=dt.datetime(2026, 1, 1, 10, m)) for m in (1, 2, 59)]
    rows += [dict(hashtag="#a", event_timestamp=dt.datetime(2026, 1, 1, 11, 0))]
    out = hashtag_counts(curated_df(spark, rows), bucket_minutes=60).orderBy("window_start").collect()
    assert [(r.window_start.hour, r.event_count) for r in out] == [(10, 3), (11, 1)]
    assert not curated_df(spark, rows).where(F.col("hashtag").isNull()).count()
