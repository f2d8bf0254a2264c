"""User activity over time: sessions and their change, and how many users come, return and lapse.

Both start from an aggregation per (user, time bucket), which runs partially before
the exchange: a user with a third of all events ships one row per bucket and input
partition, and every later step sees at most one row per user and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplecast.constants import ENGAGEMENT_WEIGHTS

SESSION_GAP_MINUTES = 30

SESSION_COLUMNS = (
    "user_id", "session_no", "session_start", "session_end", "event_count", "engagement_count", "duration_seconds",
    "idle_seconds", "prev_event_count", "count_change",
)
TREND_COLUMNS = (
    "window_start", "window_end", "event_count", "active_users", "new_users", "returning_users", "resumed_users",
    "lapsed_users", "active_change", "event_change",
)

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts)


def _bucket(minutes: int) -> Column:
    return F.floor(_micros(F.col("event_timestamp")) / F.lit(int(minutes) * 60_000_000)).cast("long")


def _of_users(curated: DataFrame) -> DataFrame:
    return curated.where(F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull())


def _seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def user_activity_sessions(curated: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Sessions of every user, each with its change against the user's session before.

    A session ends when more than `gap_minutes` pass without an event (one exactly that long after
    the last event still belongs to it, as `session_window` has it). Events of one bucket of that length are less than the gap apart
    and so belong to one session: they are summed up first, and `session_window` joins the
    sums, each with the gap running from its last event.
    """
    width = int(gap_minutes)
    engaged = F.col("event_type").isin(*ENGAGEMENT_WEIGHTS)
    buckets = (
        _of_users(curated).select("user_id", "event_type", "event_timestamp", _bucket(width).alias("bucket"))
        .groupBy("user_id", "bucket")
        .agg(
            F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last"),
            F.count(F.lit(1)).alias("n"), F.count_if(engaged).alias("engaged"),
        )
    )
    length = (F.timestamp_diff("MICROSECOND", F.col("first"), F.col("last")) + F.lit(width * 60_000_000)) / F.lit(1_000_000)
    gap = F.make_interval(secs=length.cast("decimal(18,6)"))
    sessions = buckets.groupBy("user_id", F.session_window("first", gap).alias("session")).agg(
        F.min("first").alias("session_start"), F.max("last").alias("session_end"),
        F.sum("n").alias("event_count"), F.sum("engaged").alias("engagement_count"),
    )
    by_user = Window.partitionBy("user_id").orderBy("session_start")
    before = F.coalesce(F.lag("event_count").over(by_user), F.lit(0))
    return sessions.select(
        "user_id",
        F.row_number().over(by_user).cast("long").alias("session_no"),
        "session_start",
        "session_end",
        "event_count",
        "engagement_count",
        _seconds(F.col("session_start"), F.col("session_end")).alias("duration_seconds"),
        _seconds(F.lag("session_end").over(by_user), F.col("session_start")).alias("idle_seconds"),
        before.alias("prev_event_count"),
        (F.col("event_count") - before).alias("count_change"),
    ).select(*SESSION_COLUMNS)


def user_activity_trend(curated: DataFrame, bucket_minutes: int = 60) -> DataFrame:
    """Per tumbling bucket: events, active users, and among these the new ones (no activity
    before), the returning ones (active in the bucket before) and the resumed ones (active before, but not
    then); users who lapsed (active in the bucket before, not in this one); changes against the
    bucket before (0 where it had no activity). The bucket behind the last activity is left out."""
    width = int(bucket_minutes)
    active = _of_users(curated).groupBy("user_id", _bucket(width).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    by_user = Window.partitionBy("user_id").orderBy("bucket")
    steps = active.select(
        "bucket", "n", F.lag("bucket").over(by_user).alias("before"), F.lead("bucket").over(by_user).alias("after")
    )
    one = lambda c: F.when(c, 1).otherwise(0)
    here = F.struct(
        F.col("bucket"), F.col("n"), F.lit(1).alias("active"), one(F.col("before").isNull()).alias("new"),
        one(F.col("before") == F.col("bucket") - 1).alias("returning"),
        one(F.col("before") < F.col("bucket") - 1).alias("resumed"), F.lit(0).alias("lapsed"),
    )
    gone = F.struct(
        (F.col("bucket") + 1).alias("bucket"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("active"),
        F.lit(0).alias("new"), F.lit(0).alias("returning"), F.lit(0).alias("resumed"), F.lit(1).alias("lapsed"),
    )
    stays = F.col("after") == F.col("bucket") + 1
    rows = steps.select(F.explode(F.when(stays, F.array(here)).otherwise(F.array(here, gone))).alias("r")).select("r.*")
    names = {"n": "event_count", "active": "active_users", "new": "new_users", "returning": "returning_users"}
    names |= {"resumed": "resumed_users", "lapsed": "lapsed_users"}
    totals = rows.groupBy("bucket").agg(*(F.sum(c).alias(name) for c, name in names.items()))
    earlier = totals.select(
        (F.col("bucket") + 1).alias("bucket"), F.col("active_users").alias("_active"), F.col("event_count").alias("_events")
    )
    start = F.timestamp_add("MICROSECOND", F.col("bucket") * F.lit(width * 60_000_000), F.expr(_EPOCH))
    end = F.timestamp_add("MICROSECOND", (F.col("bucket") + 1) * F.lit(width * 60_000_000), F.expr(_EPOCH))
    last = totals.where("active_users > 0").agg(F.max("bucket")).scalar()
    return (
        totals.where(F.col("bucket") <= last).join(earlier, "bucket", "left")
        .select(
            start.alias("window_start"), end.alias("window_end"), *names.values(),
            (F.col("active_users") - F.coalesce("_active", F.lit(0))).alias("active_change"),
            (F.col("event_count") - F.coalesce("_events", F.lit(0))).alias("event_change"),
        )
        .select(*TREND_COLUMNS)
    )
