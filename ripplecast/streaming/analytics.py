"""Streaming analytics on the clean event stream: event-time windows with a
watermark, append mode (each window is emitted once, when it is closed).

* `viral_alerts`: likes per post in sliding windows (length w, slide s); a
  (window, post) with more than `threshold` likes is an alert. Windows start on
  multiples of the slide, so this is the streaming approximation of "more than N
  likes within any w minutes"; the exact batch answer is
  `operators.gold.viral_posts_any_window`.
* `hashtag_counts`: events per hashtag in tumbling windows (the streaming form
  of the hashtag trend over time).

Both aggregate per (window, key) with Spark's state store; state for a window is
dropped once the watermark passes its end, so state stays bounded. Partial
aggregation runs before the state-store shuffle, so a hot post or hashtag is
pre-counted per input partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ripplecast.streaming.ingest import idempotent_batch_sink


def _event_time(events: DataFrame, session_tz: str = "UTC") -> DataFrame:
    # Watermarks need an instant; event_timestamp holds the UTC wall clock.
    return events.withColumn(
        "event_time", F.convert_timezone(F.lit("UTC"), F.lit(session_tz), F.col("event_timestamp")).cast("timestamp")
    )


def _utc_wall(instant, session_tz: str):
    local = instant.cast("timestamp_ntz")
    if session_tz.upper() in ("UTC", "GMT", "Z", "ETC/UTC"):
        return local
    return F.convert_timezone(F.lit(session_tz), F.lit("UTC"), local)


def _window_bounds(session_tz: str, col: str = "w") -> list:
    return [
        _utc_wall(F.col(f"{col}.start"), session_tz).alias("window_start"),
        _utc_wall(F.col(f"{col}.end"), session_tz).alias("window_end"),
    ]


def viral_alerts(
    events: DataFrame,
    window_minutes: int = 5,
    slide_minutes: int = 1,
    threshold: int = 500,
    watermark_delay: str = "10 minutes",
    session_tz: str = "UTC",
) -> DataFrame:
    """(post_id, window_start, window_end, like_count) for every sliding window
    with more than `threshold` likes. Works on streams and on batch frames."""
    likes = _event_time(events, session_tz).where(
        (F.col("event_type") == "like") & F.col("post_id").isNotNull() & F.col("event_time").isNotNull()
    )
    if likes.isStreaming:
        likes = likes.withWatermark("event_time", watermark_delay)
    counts = likes.groupBy(
        F.window("event_time", f"{int(window_minutes)} minutes", f"{int(slide_minutes)} minutes").alias("w"),
        "post_id",
    ).agg(F.count(F.lit(1)).alias("like_count"))
    return counts.where(F.col("like_count") > threshold).select("post_id", *_window_bounds(session_tz), "like_count")


def hashtag_counts(
    events: DataFrame,
    bucket_minutes: int = 60,
    watermark_delay: str = "10 minutes",
    session_tz: str = "UTC",
    slide_minutes: int | None = None,
) -> DataFrame:
    """(hashtag, window_start, window_end, event_count) per tumbling window, or per sliding one."""
    tagged = _event_time(events, session_tz).where(F.col("hashtag").isNotNull() & F.col("event_time").isNotNull())
    if tagged.isStreaming:
        tagged = tagged.withWatermark("event_time", watermark_delay)
    slide = int(slide_minutes or bucket_minutes)
    window = F.window("event_time", f"{int(bucket_minutes)} minutes", f"{slide} minutes").alias("w")
    counts = tagged.groupBy(window, "hashtag").agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return counts.select("hashtag", *_window_bounds(session_tz), "event_count")


def top_per_window(counts: DataFrame, top: int = 10) -> DataFrame:
    """The `top` hashtags of every window of `hashtag_counts`, ties by hashtag. In append mode all counts of
    a window are emitted in the one micro-batch in which it closes, so as the sink's `prepare`
    this ranks whole windows; the ranking is pruned to `top` rows per task before the exchange."""
    order = Window.partitionBy("window_start").orderBy(F.desc("event_count"), "hashtag")
    ranked = counts.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("window_start", "window_end", "hashtag", "event_count", "rank")


def user_sessions(
    events: DataFrame, gap_minutes: int = 30, watermark_delay: str = "10 minutes", session_tz: str = "UTC"
) -> DataFrame:
    """(user_id, session_start, session_end, event_count) of every session that the watermark has closed;
    session_end is the last event's time, as in `operators.activity.user_activity_sessions`."""
    timed = _event_time(events, session_tz).where(F.col("user_id").isNotNull() & F.col("event_time").isNotNull())
    if timed.isStreaming:
        timed = timed.withWatermark("event_time", watermark_delay)
    sessions = timed.groupBy(F.session_window("event_time", f"{int(gap_minutes)} minutes").alias("w"), "user_id").agg(
        F.count(F.lit(1)).alias("event_count"), F.max("event_timestamp").alias("session_end")
    )
    start = _window_bounds(session_tz)[0].alias("session_start")
    return sessions.select("user_id", start, "session_end", "event_count")


def start_append(
    stream: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write closed windows (through `prepare`) with the idempotent per-batch sink."""
    return (
        stream.writeStream.foreachBatch(idempotent_batch_sink(out_path, prepare))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )
