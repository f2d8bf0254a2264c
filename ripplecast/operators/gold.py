"""GOLD: trending hashtags, viral posts, influencer ranking, comment sentiment,
plus two further analyses of the same data (hashtag trend over time, viral posts in
any window).

All functions take the curated DataFrame (columns of CURATED_EVENTS) and return
DataFrames; nothing is collected. "Latest" means the maximum event time over
*all* curated events, computed as a scalar subquery so the time bound is a plain
filter next to the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplecast.constants import (
    ENGAGEMENT_WEIGHTS,
    TRENDING_TOP_N,
    TRENDING_WINDOWS_MINUTES,
    VIRAL_LIKE_THRESHOLD,
    VIRAL_WINDOW_MINUTES,
)
from ripplecast.functions.sentiment import lexicon_sentiment
from ripplecast.operators.joins import lookup_left_join
from ripplecast.operators.ranking import global_row_number, global_running_sum
from ripplecast.schema import INFLUENCER_COLUMNS, SENTIMENT_COLUMNS, TRENDING_COLUMNS, VIRAL_COLUMNS

def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def minutes(n: int | Column) -> Column:
    n_col = n if isinstance(n, Column) else F.lit(int(n))
    return F.make_dt_interval(F.lit(0), F.lit(0), n_col.cast("int"))


def run_timestamp(run_ts=None, session_tz: str = "UTC") -> Column:
    """Processing-time stamp as UTC TIMESTAMP_NTZ. Pass a fixed value to make
    results repeatable; default is the query's current time."""
    if run_ts is None:
        now = F.current_timestamp().cast("timestamp_ntz")
        if session_tz.upper() in ("UTC", "GMT", "Z", "ETC/UTC"):
            return now
        return F.convert_timezone(F.lit(session_tz), F.lit("UTC"), now)
    if isinstance(run_ts, Column):
        return run_ts.cast("timestamp_ntz")
    if isinstance(run_ts, _dt.datetime):
        run_ts = run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(run_ts)).cast("timestamp_ntz")


EVENT_DATE = "event_date"


def latest_event_time(curated: DataFrame) -> Column:
    """MAX(event_timestamp) over all curated events, as a scalar subquery.

    When the input carries the `event_date` partition column (written curated
    table), the maximum is read from the last date folder only: the inner
    subquery touches partition values, the outer one prunes to one partition.
    """
    if EVENT_DATE in curated.columns:
        last_day = curated.select(F.max(EVENT_DATE)).scalar()
        return curated.where(F.col(EVENT_DATE) == last_day).select(F.max("event_timestamp")).scalar()
    return curated.select(F.max("event_timestamp")).scalar()


def time_range(curated: DataFrame, lo: Column, hi: Column) -> Column:
    """lo <= event_timestamp <= hi, plus the implied `event_date` bounds when the
    input is date-partitioned, so Spark prunes folders at run time."""
    ts = F.col("event_timestamp")
    cond = (ts >= lo) & (ts <= hi)
    if EVENT_DATE in curated.columns:
        cond = cond & (F.col(EVENT_DATE) >= F.to_date(lo)) & (F.col(EVENT_DATE) <= F.to_date(hi))
    return cond


# --------------------------------------------------------------------------
# Trending hashtags
# --------------------------------------------------------------------------
def trending_hashtags(
    curated: DataFrame,
    windows_minutes: tuple[int, ...] = TRENDING_WINDOWS_MINUTES,
    top_n: int = TRENDING_TOP_N,
    latest: Column | None = None,
) -> DataFrame:
    """Top-`top_n` hashtags by event count in each trailing window
    [latest - w, latest] (both ends closed), ranked by count desc, hashtag asc.
    `latest` defaults to the maximum event time of `curated` (a scalar
    subquery); a caller holding a manifest of the table can pass its own.

    One pass: events older than the widest window are filtered next to the
    scan; each remaining event is counted for every window it falls in with
    conditional counts, so the aggregation emits one row per hashtag (partial
    aggregation absorbs hot hashtags) and no event × window join is formed.
    """
    latest = latest_event_time(curated) if latest is None else latest
    ws = sorted(set(int(w) for w in windows_minutes))
    widest = max(ws)
    ts = F.col("event_timestamp")
    recent = curated.where(F.col("hashtag").isNotNull() & time_range(curated, latest - minutes(widest), latest))
    per_tag = recent.groupBy("hashtag").agg(
        *[F.count_if(ts >= latest - minutes(w)).alias(f"c{w}") for w in ws]
    )
    stacked = per_tag.select(
        "hashtag",
        F.explode(
            F.array(*[F.struct(F.lit(w).cast("long").alias("w"), F.col(f"c{w}").alias("n")) for w in ws])
        ).alias("x"),
    ).select(F.col("x.w").alias("window_minutes"), "hashtag", F.col("x.n").alias("event_count"))
    counted = stacked.where(F.col("event_count") > 0)
    rank = F.row_number().over(
        Window.partitionBy("window_minutes").orderBy(F.desc("event_count"), F.asc_nulls_last("hashtag"))
    )
    ranked = counted.select("*", rank.cast("long").alias("rank")).where(F.col("rank") <= top_n)
    return ranked.select(
        "window_minutes",
        "hashtag",
        "event_count",
        "rank",
        (latest - minutes(F.col("window_minutes"))).alias("window_start"),
        latest.alias("window_end"),
    ).select(*TRENDING_COLUMNS)


# --------------------------------------------------------------------------
# Viral posts (latest window)
# --------------------------------------------------------------------------
def viral_posts(
    curated: DataFrame,
    window_minutes: int = VIRAL_WINDOW_MINUTES,
    threshold: int = VIRAL_LIKE_THRESHOLD,
    run_ts=None,
    session_tz: str = "UTC",
    latest: Column | None = None,
) -> DataFrame:
    """Posts with more than `threshold` likes in [latest - w, latest].
    `latest` defaults to the maximum event time of `curated`."""
    latest = latest_event_time(curated) if latest is None else latest
    ts = F.col("event_timestamp")
    likes = curated.where(
        (F.col("event_type") == "like")
        & F.col("post_id").isNotNull()
        & time_range(curated, latest - minutes(window_minutes), latest)
    )
    counts = likes.groupBy("post_id").agg(F.count(F.lit(1)).alias("like_count")).where(F.col("like_count") > threshold)
    return counts.select(
        "post_id",
        "like_count",
        F.lit(int(window_minutes)).cast("long").alias("window_minutes"),
        (latest - minutes(window_minutes)).alias("window_start"),
        latest.alias("window_end"),
        run_timestamp(run_ts, session_tz).alias("viral_detected_at"),
    ).select(*VIRAL_COLUMNS)


# --------------------------------------------------------------------------
# Influencer ranking
# --------------------------------------------------------------------------
def engagement_counts(
    curated: DataFrame,
    by: tuple[str, ...] = (),
    weights: dict[str, int] = ENGAGEMENT_WEIGHTS,
) -> DataFrame:
    """Likes / comments / shares received per post creator (and per `by`
    columns, e.g. a daily rollup). Partial aggregation before the shuffle."""
    t = F.col("event_type")
    engaged = curated.where(F.col("post_creator_user_id").isNotNull() & t.isin(*weights.keys()))
    return engaged.groupBy(F.col("post_creator_user_id").alias("user_id"), *by).agg(
        F.count_if(t == "like").alias("like_count"),
        F.count_if(t == "comment").alias("comment_count"),
        F.count_if(t == "share").alias("share_count"),
    )


def rank_creators(
    counts: DataFrame,
    users: DataFrame,
    weights: dict[str, int] = ENGAGEMENT_WEIGHTS,
    run_ts=None,
    session_tz: str = "UTC",
) -> DataFrame:
    """INFLUENCER_RANKING from per-creator counts (one row per creator)."""
    scored = counts.select(
        "user_id",
        "like_count",
        "comment_count",
        "share_count",
        (F.col("like_count") + F.col("comment_count") + F.col("share_count")).alias("total_engagement"),
        (
            F.col("like_count") * weights.get("like", 0)
            + F.col("comment_count") * weights.get("comment", 0)
            + F.col("share_count") * weights.get("share", 0)
        )
        .cast("decimal(10,2)")
        .alias("engagement_score"),
    )
    named = scored.join(
        users.select(F.col("user_id").alias("__uid"), F.col("username")),
        F.col("user_id") == F.col("__uid"),
        "left",
    ).drop("__uid")
    ranked = global_row_number(named, [F.desc("engagement_score"), F.asc("user_id")], "rank")
    return ranked.select("*", run_timestamp(run_ts, session_tz).alias("calculated_at")).select(*INFLUENCER_COLUMNS)


def influencer_ranking(
    curated: DataFrame,
    users: DataFrame,
    weights: dict[str, int] = ENGAGEMENT_WEIGHTS,
    run_ts=None,
    session_tz: str = "UTC",
) -> DataFrame:
    """Creators ranked by weighted engagement received on their posts
    (like·1 + comment·2 + share·3 by default), rank by score desc, user_id asc.
    Self-engagement counts. The global rank is computed distributed."""
    return rank_creators(engagement_counts(curated, weights=weights), users, weights, run_ts, session_tz)


def influencer_ranking_from_daily(
    daily: DataFrame,
    users: DataFrame,
    weights: dict[str, int] = ENGAGEMENT_WEIGHTS,
    run_ts=None,
    session_tz: str = "UTC",
) -> DataFrame:
    """The same ranking from a daily rollup (`engagement_counts(curated,
    by=(event_date,))`): sums per creator over days (creators × days rows)."""
    totals = daily.groupBy("user_id").agg(
        F.sum("like_count").alias("like_count"),
        F.sum("comment_count").alias("comment_count"),
        F.sum("share_count").alias("share_count"),
    )
    return rank_creators(totals, users, weights, run_ts, session_tz)


# --------------------------------------------------------------------------
# Comment sentiment
# --------------------------------------------------------------------------
def comment_sentiment(curated: DataFrame, run_ts=None, session_tz: str = "UTC") -> DataFrame:
    """Every comment with text, labelled Positive / Neutral / Negative by lexicon."""
    return curated.where((F.col("event_type") == "comment") & F.col("comment_text").isNotNull()).select(
        "event_id",
        "post_id",
        "user_id",
        "comment_text",
        lexicon_sentiment(F.col("comment_text")).alias("sentiment"),
        "event_timestamp",
        run_timestamp(run_ts, session_tz).alias("calculated_at"),
    ).select(*SENTIMENT_COLUMNS)


# --------------------------------------------------------------------------
# Hashtag trend over time (tumbling buckets + change to the previous bucket)
# --------------------------------------------------------------------------
def hashtag_trend_over_time(curated: DataFrame, bucket_minutes: int = 60) -> DataFrame:
    """Events per (hashtag, tumbling bucket aligned to the epoch), with the
    count of the immediately preceding bucket (0 when it had none) and the change.
    Aggregation first (partial), so the window only sees one row per bucket."""
    counts = (
        curated.where(F.col("hashtag").isNotNull() & F.col("event_timestamp").isNotNull())
        .groupBy("hashtag", F.window("event_timestamp", f"{int(bucket_minutes)} minutes").alias("b"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select("hashtag", F.col("b.start").alias("window_start"), F.col("b.end").alias("window_end"), "event_count")
    )
    w = Window.partitionBy("hashtag").orderBy("window_start")
    prev_start = F.lag("window_start").over(w)
    prev_count = F.lag("event_count").over(w)
    adjacent = prev_start == F.col("window_start") - minutes(bucket_minutes)
    prev = F.when(adjacent, prev_count).otherwise(F.lit(0)).cast("long")
    return counts.select(
        "hashtag",
        "window_start",
        "window_end",
        "event_count",
        prev.alias("prev_event_count"),
        (F.col("event_count") - prev).alias("count_change"),
    )


# --------------------------------------------------------------------------
# Viral posts in any trailing window (not only the latest)
# --------------------------------------------------------------------------
def viral_posts_any_window(
    curated: DataFrame,
    window_minutes: int = VIRAL_WINDOW_MINUTES,
    threshold: int = VIRAL_LIKE_THRESHOLD,
) -> DataFrame:
    """Posts that received more than `threshold` likes within some window of
    `window_minutes` (frame [t - w, t], both ends closed, at any like time t).
    Returns the peak count and the earliest window reaching it.

    Exact and skew-proof, from prefix counts instead of per-post windows:
    the frame count of a like at t is  #likes(post, <= t) - #likes(post, < t - w).
    Both terms are read off one global running count of likes in
    (post, time) order, at two rows per post and instant of likes: a marker at (t - w) sorting
    before the likes of that instant, and their number at t. The running count is
    computed over range partitions (`global_running_sum`), so neither a hot post
    nor a hot time bucket is ever gathered into one task. Posts whose total
    likes do not exceed the threshold cannot qualify and are pruned exactly
    first (a hot post is split by `lookup_left_join`).
    """
    instants = likes_per_instant(like_times(curated))
    return peak_rows(like_peaks(instants, window_minutes, threshold), window_minutes)


def like_times(events: DataFrame) -> DataFrame:
    """(post_id, t, rid): the time of every like in microseconds, with its event id."""
    return events.where(
        (F.col("event_type") == "like") & F.col("post_id").isNotNull() & F.col("event_timestamp").isNotNull()
    ).select(
        "post_id",
        F.timestamp_diff("MICROSECOND", _epoch(), F.col("event_timestamp")).alias("t"),
        F.coalesce(F.col("event_id"), F.lit("")).alias("rid"),
    )


def likes_per_instant(likes: DataFrame) -> DataFrame:
    """(post_id, t, n): the likes of every post and microsecond of `like_times` rows."""
    return likes.groupBy("post_id", "t").agg(F.count(F.lit(1)).alias("n"))


def like_peaks(instants: DataFrame, window_minutes: int, threshold: int) -> DataFrame:
    """(post_id, like_count, end_us) of `likes_per_instant` rows, one per post and instant: the peak of every
    post above `threshold` and the earliest like time that reaches it (see `viral_posts_any_window`)."""
    width_us = int(window_minutes) * 60 * 1_000_000
    totals = (
        instants.groupBy(F.col("post_id").alias("__tp"))
        .agg(F.sum("n").alias("__total"))
        .where(F.col("__total") > threshold)
    )
    cand = lookup_left_join(instants, totals, "post_id", "__tp", salt_col="t").where(F.col("__total").isNotNull())
    # n is NULL at the marker t - w, which comes before the likes of that instant.
    rows = cand.select(
        "post_id",
        F.explode(
            F.array(
                F.struct(
                    (F.col("t") - F.lit(width_us)).alias("at"), F.lit(None).cast("long").alias("n")
                ),
                F.struct(F.col("t").alias("at"), F.col("n").alias("n")),
            )
        ).alias("m"),
    ).select("post_id", F.col("m.at").alias("at"), F.col("m.n").alias("n"))
    run = global_running_sum(
        rows,
        [F.col("post_id"), F.col("at"), F.col("n").asc_nulls_first()],
        F.coalesce(F.col("n"), F.lit(0)),
        "run",
    )
    end = F.when(F.col("n").isNull(), F.col("at") + F.lit(width_us)).otherwise(F.col("at"))
    framed = run.groupBy("post_id", end.alias("t0")).agg(
        (F.max(F.when(F.col("n").isNotNull(), F.col("run"))) - F.max(F.when(F.col("n").isNull(), F.col("run")))).alias(
            "cnt"
        )
    )
    return framed.where(F.col("cnt") > threshold).groupBy("post_id").agg(
        F.max("cnt").alias("like_count"),
        F.min_by("t0", F.struct(-F.col("cnt"), F.col("t0"))).alias("end_us"),
    )


def peak_rows(peaks: DataFrame, window_minutes: int) -> DataFrame:
    """Result columns of `like_peaks` rows."""
    end_ts = F.timestamp_add("MICROSECOND", F.col("end_us"), _epoch())
    return peaks.select(
        "post_id",
        F.col("like_count").cast("long").alias("like_count"),
        F.lit(int(window_minutes)).cast("long").alias("window_minutes"),
        (end_ts - minutes(window_minutes)).alias("window_start"),
        end_ts.alias("window_end"),
    )
