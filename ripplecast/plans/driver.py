"""Pipeline over the driver's test tables (`<sf_dir>/events.parquet`, `nation.parquet`).

The adapter output is written once per session as the landing folder (the
"topic"); bronze, silver and gold are then built from it exactly as for real
messages. Driver events span 30 days, so the analytical windows are scaled
from minutes to days (1/5/15 days for trending, 5 days for viral); thresholds
are set so that the results are selective at the test scales.
"""

from __future__ import annotations

import hashlib
import math
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.plans.lakehouse import GoldParams, Lakehouse, write_messages
from ripplecast.schema import PARSED_COLUMNS
from ripplecast.session import work_dir
from ripplecast.sources.driver_feed import driver_messages

DAY = 24 * 60

DRIVER_GOLD = GoldParams(
    trending_windows_minutes=(1 * DAY, 5 * DAY, 15 * DAY),
    trending_top_n=10,
    viral_window_minutes=5 * DAY,
    viral_threshold=6,
    run_ts="2024-02-01 00:00:00",
)
ANY_WINDOW_MINUTES = 5 * DAY
STREAM_ALERT_SLIDE_MINUTES = DAY
STREAM_WATERMARK = "1 day"
ANY_WINDOW_THRESHOLD = 10
TREND_BUCKET_MINUTES = DAY
SESSION_GAP = DAY
#: Log segments that late messages of the disordered topic lie behind, of STREAM_DEMO_BATCHES; segments
#: arrive an hour apart, and recent ids are kept for less than that distance.
LATE_SEGMENTS = 5
RECENT_IDS_TTL = "90 minutes"

_LAKES: dict[tuple[str, str], Lakehouse] = {}


MESSAGES_PER_SEGMENT = 500_000
STREAM_DEMO_BATCHES = 8


def landing_segments(spark: SparkSession, sf_dir: str) -> int:
    """Number of landing files: at least 8, about 500k messages each."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()  # footer metadata
    return max(8, math.ceil(events / MESSAGES_PER_SEGMENT))


def files_per_trigger(spark: SparkSession, folder: str) -> int:
    """Files per micro-batch so that replaying `folder` takes ~8 micro-batches."""
    return max(1, math.ceil(len(_data_files(spark, folder)) / STREAM_DEMO_BATCHES))


def driver_lake(spark: SparkSession, sf_dir: str, upto: str = "gold") -> Lakehouse:
    """The (memoised) lakehouse for one driver data folder, built up to `upto` ("root": nothing is built)."""
    sf_dir = os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir
    key = (spark.sparkContext.applicationId, sf_dir)
    lake = _LAKES.get(key)
    if lake is None:
        tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
        lake = Lakehouse(spark, f"{work_dir(spark)}/ripplecast-lake/{tag}", DRIVER_GOLD)
        _LAKES[key] = lake
    if upto == "root":
        return lake
    # The topic as log segments (one file each, ~500k messages), so streams
    # see several micro-batches and scans of the landing stay parallel.
    lake.ensure_landing(lambda: driver_messages(spark, sf_dir, landing_segments(spark, sf_dir)))
    if upto != "landing":
        lake.ensure(upto)
    return lake


def stream_bronze(
    spark: SparkSession,
    sf_dir: str,
    dedup: str = "exact",
    max_files_per_trigger: int | None = None,
    watermark_delay: str = "1 hour",
) -> DataFrame:
    """Run the streaming ingest over the landing folder to completion
    (`availableNow`) and read back the committed bronze batches.

    Rerunning on the same checkpoint processes nothing new, so the result is
    stable (exactly-once output).
    """
    from ripplecast.streaming.ingest import file_messages, read_batches, start_ingest

    lake = driver_lake(spark, sf_dir, "landing")
    if max_files_per_trigger == -1:
        max_files_per_trigger = files_per_trigger(spark, _in_arrival_order(spark, lake.path("landing")))
    tag = f"{dedup}-{max_files_per_trigger or 'all'}"
    root = lake.path("stream", tag)
    query = start_ingest(
        file_messages(spark, lake.path("landing"), max_files_per_trigger),
        root + "/bronze",
        root + "/_checkpoint",
        dedup=dedup,
        watermark_delay=watermark_delay,
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return read_batches(spark, root + "/bronze").select(*PARSED_COLUMNS)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages of the landing folder by the rejects stream, over several micro-batches."""
    from ripplecast.streaming.ingest import file_messages, read_batches, start_rejects

    lake = driver_lake(spark, sf_dir, "landing")
    root = lake.path("stream", "rejects")
    messages = file_messages(spark, lake.path("landing"), files_per_trigger(spark, lake.path("landing")))
    query = start_rejects(messages, root + "/out", root + "/_checkpoint", trigger={"availableNow": True})
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    columns = ("value", *PARSED_COLUMNS, "failed_rules")
    return read_batches(spark, root + "/out", columns=columns, schema=", ".join(f"{c} string" for c in columns))


def _run_stream_to_completion(stream: DataFrame, root: str, columns, schema, prepare=None) -> DataFrame:
    from ripplecast.streaming.analytics import start_append
    from ripplecast.streaming.ingest import read_batches

    spark = stream.sparkSession
    query = start_append(stream, root + "/out", root + "/_checkpoint", {"availableNow": True}, prepare)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return read_batches(spark, root + "/out", columns=columns, schema=schema)


def _in_arrival_order(spark: SparkSession, path: str) -> str:
    """Give the segments of a landing folder file times in their order, an hour between micro-batches: tasks
    write them at the same time, but a file stream takes them, and `two_tier.arrivals` dates them, by file time."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = _data_files(spark, path)
    per = files_per_trigger(spark, path)
    for i, name in enumerate(files):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(name), 1_700_000_000_000 + i // per * 3_600_000 + i % per * 1000, -1)
    return path


def disordered_landing(spark: SparkSession, sf_dir: str) -> str:
    """A second landing folder with the same messages in disorder: late events and copies arrive
    `LATE_SEGMENTS` segments behind their place. The file times tell the arrival."""
    from ripplecast.plans.lakehouse import is_complete

    path = driver_lake(spark, sf_dir, "root").path("landing_disordered")
    if not is_complete(spark, path):
        events = spark.read.parquet(f"{sf_dir}/events.parquet").count()  # footer metadata
        late_by = max(1, events * LATE_SEGMENTS // STREAM_DEMO_BATCHES)
        write_messages(driver_messages(spark, sf_dir, landing_segments(spark, sf_dir), late_by), path)
    return _in_arrival_order(spark, path)


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def two_tier_root(spark: SparkSession, sf_dir: str) -> str:
    """Bronze and rejects of the disordered topic by the two-tier ingest, over about 8 micro-batches."""
    from ripplecast.streaming.two_tier import arrivals, start_two_tier

    path = disordered_landing(spark, sf_dir)
    root = driver_lake(spark, sf_dir, "root").path("stream", "two-tier")
    messages = arrivals(spark, path, files_per_trigger(spark, path))
    _finish(start_two_tier(messages, root, root + "/_checkpoint", ttl=RECENT_IDS_TTL, trigger={"availableNow": True}))
    return root


def stream_dedup_two_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ripplecast.streaming.two_tier import read_bronze

    return read_bronze(spark, two_tier_root(spark, sf_dir))


def stream_rejects_two_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ripplecast.streaming.two_tier import read_rejects

    return read_rejects(spark, two_tier_root(spark, sf_dir))


def stream_dimension(dimension: str):
    """The dimension from the disordered topic: late events correct rows of earlier micro-batches."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ripplecast.streaming.dimensions import read_dimension, start_dimension
        from ripplecast.streaming.ingest import file_messages

        path = disordered_landing(spark, sf_dir)
        root = driver_lake(spark, sf_dir, "root").path("stream", dimension)
        messages = file_messages(spark, path, files_per_trigger(spark, path))
        _finish(start_dimension(messages, dimension, root + "/out", root + "/_checkpoint", {"availableNow": True}))
        return read_dimension(spark, root + "/out", dimension)

    return run


def stream_viral_any_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact peaks of the disordered topic, over four micro-batches."""
    from ripplecast.session import session_time_zone
    from ripplecast.streaming.ingest import clean_stream, file_messages
    from ripplecast.streaming.viral import LIKE_COLUMNS, read_peaks, start_peaks

    path = disordered_landing(spark, sf_dir)
    root = driver_lake(spark, sf_dir, "root").path("stream", "viral-any-window")
    messages = file_messages(spark, path, 2 * files_per_trigger(spark, path))
    events = clean_stream(messages, session_tz=session_time_zone(spark), columns=LIKE_COLUMNS)
    done = start_peaks(
        events, root, root + "/_checkpoint", ANY_WINDOW_MINUTES, ANY_WINDOW_THRESHOLD, {"availableNow": True}
    )
    _finish(done)
    return read_peaks(spark, root, ANY_WINDOW_MINUTES)


def _clean_in_order(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The ingested stream of the landing folder, over four micro-batches, and the session's time zone."""
    from ripplecast.session import session_time_zone
    from ripplecast.streaming.ingest import clean_stream, file_messages

    path = _in_arrival_order(spark, driver_lake(spark, sf_dir, "landing").path("landing"))
    tz = session_time_zone(spark)
    return clean_stream(file_messages(spark, path, 2 * files_per_trigger(spark, path)), session_tz=tz), tz


def stream_user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that the final watermark has closed, from the ingested stream."""
    from ripplecast.streaming.analytics import user_sessions

    events, tz = _clean_in_order(spark, sf_dir)
    return _run_stream_to_completion(
        user_sessions(events, SESSION_GAP, STREAM_WATERMARK, tz),
        driver_lake(spark, sf_dir, "landing").path("stream", "user-sessions"),
        ("user_id", "session_start", "session_end", "event_count"),
        "user_id string, session_start timestamp_ntz, session_end timestamp_ntz, event_count bigint",
    )


def stream_trending_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 hashtags of every closed window of 5 days, a window a day."""
    from ripplecast.streaming.analytics import hashtag_counts, top_per_window

    events, tz = _clean_in_order(spark, sf_dir)
    counts = hashtag_counts(events, DRIVER_GOLD.viral_window_minutes, STREAM_WATERMARK, tz, STREAM_ALERT_SLIDE_MINUTES)
    return _run_stream_to_completion(
        counts,
        driver_lake(spark, sf_dir, "landing").path("stream", "trending"),
        ("window_start", "window_end", "hashtag", "event_count", "rank"),
        "window_start timestamp_ntz, window_end timestamp_ntz, hashtag string, event_count bigint, rank bigint",
        prepare=lambda df: top_per_window(df, DRIVER_GOLD.trending_top_n),
    )


def stream_viral_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming viral alerts over the landing folder: ingest (parse, validate,
    exact dedup) → likes per post in sliding windows of 5 days every day with a
    1-day watermark, append mode, run to completion and read back. Windows that
    close by the final watermark are emitted."""
    from ripplecast.streaming.analytics import viral_alerts

    lake = driver_lake(spark, sf_dir, "landing")
    events, tz = _clean_in_order(spark, sf_dir)
    alerts = viral_alerts(
        events,
        window_minutes=DRIVER_GOLD.viral_window_minutes,
        slide_minutes=STREAM_ALERT_SLIDE_MINUTES,
        threshold=DRIVER_GOLD.viral_threshold,
        watermark_delay=STREAM_WATERMARK,
        session_tz=tz,
    )
    return _run_stream_to_completion(
        alerts,
        lake.path("stream", "viral-alerts"),
        ("post_id", "window_start", "window_end", "like_count"),
        "post_id string, window_start timestamp_ntz, window_end timestamp_ntz, like_count bigint",
    )


def stream_hashtag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming hashtag counts per 1-day tumbling window (1-day watermark,
    append mode) over the ingested stream, run to completion and read back."""
    from ripplecast.streaming.analytics import hashtag_counts

    lake = driver_lake(spark, sf_dir, "landing")
    events, tz = _clean_in_order(spark, sf_dir)
    counts = hashtag_counts(
        events,
        bucket_minutes=TREND_BUCKET_MINUTES,
        watermark_delay=STREAM_WATERMARK,
        session_tz=tz,
    )
    return _run_stream_to_completion(
        counts,
        lake.path("stream", "hashtag-counts"),
        ("hashtag", "window_start", "window_end", "event_count"),
        "hashtag string, window_start timestamp_ntz, window_end timestamp_ntz, event_count bigint",
    )


def comment_sentiment_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment by a lexicon table, in the form for lexicons beyond the broadcast threshold: the fixed phrases
    and one for every post of the data, compared with white space trimmed and collapsed."""
    from ripplecast.operators.lexicon import comment_sentiment_by_table, lexicon_table, loose_phrase

    lake = driver_lake(spark, sf_dir, "silver")
    own = lake.posts().select(
        F.concat(F.lit("Love  "), "post_id").alias("phrase"), F.lit("Positive").alias("sentiment"), F.lit(4).alias("priority")
    )
    return comment_sentiment_by_table(
        lake.curated_partitioned(), lexicon_table(spark).unionByName(own), loose_phrase, DRIVER_GOLD.run_ts, lake.tz,
        rows_per_split=100, force_split=True,
    )


def _twice(df: DataFrame, which: Column) -> DataFrame:
    copies = F.when(which, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")


def faulted(curated: DataFrame, users: DataFrame, posts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The silver tables with faults seeded by the number in each id, so that every
    check has something to find: repeated rows, missing and unknown values, and
    dimension rows that are gone."""
    n = F.expr("CAST(substr(event_id, 2) AS BIGINT)")
    u, p = F.expr("CAST(substr(user_id, 6) AS BIGINT)"), F.expr("CAST(substr(post_id, 6) AS BIGINT)")
    kind = F.when(n % 29 == 5, F.lit("unknown_event")).when(n % 37 != 6, F.col("event_type"))
    return (
        _twice(curated, n % 50 == 3).withColumns({"event_type": kind, "user_id": F.when(n % 31 != 4, F.col("user_id"))}),
        _twice(users.where(u % 7 != 3), u % 5 == 1).withColumn("username", F.when(u % 6 != 2, F.col("username"))),
        _twice(posts.where(p % 7 != 3), p % 5 == 1).withColumn("created_at", F.when(p % 6 != 2, F.col("created_at"))),
    )


def dq_report_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on silver tables with seeded faults, from states folded over four arrivals of dates."""
    from ripplecast.operators.quality_states import day_of, fold, report_from_states

    lake = driver_lake(spark, sf_dir, "silver")
    curated, users, posts = faulted(lake.curated_partitioned(), lake.users(), lake.posts())
    root = lake.path("quality-states")
    rows = lake.curated_partitioned().select(day_of(F.col("event_timestamp")).alias("day")).distinct().collect()  # days
    days = sorted(r["day"] for r in rows)
    for k in range(min(4, len(days))):
        fold(curated, root, days[k::4])
    return report_from_states(spark, root, users, posts)


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    """Data files of a written folder, sorted (paths only, listed on the driver)."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().toString() for st in fs.listStatus(base) if st.isFile()]
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", ".")))


def incremental_lake(spark: SparkSession, sf_dir: str):
    """A lake maintained incrementally while messages keep arriving.

    The first landing segment arrives in a live folder, the stream ingests it,
    silver and gold are built in full; then the remaining segments arrive, the
    stream ingests them as new micro-batches and `update_silver` /
    `update_gold` fold only those in. Rerunning processes nothing new."""
    from ripplecast.plans.lakehouse import Lakehouse, is_complete
    from ripplecast.streaming.ingest import file_messages, start_ingest

    base = driver_lake(spark, sf_dir, "landing")
    lake = Lakehouse(spark, base.path("incremental"), DRIVER_GOLD)
    segments = _data_files(spark, base.path("landing"))

    def arrive(name: str, paths: list[str]) -> None:
        out = lake.path("live", name)
        if paths and not is_complete(spark, out):
            write_messages(spark.read.text(paths), out)

    def ingest() -> None:
        q = start_ingest(
            file_messages(spark, lake.path("live", "*")),  # each arrival: one micro-batch
            lake.path("bronze"),
            lake.path("_checkpoint"),
            trigger={"availableNow": True},
        )
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))

    arrive("p1", segments[:1])
    ingest()
    if lake._read_progress() is None:
        lake.build_silver()
        lake.build_gold()
    if segments[1:]:
        arrive("p2", segments[1:])
        ingest()
        lake.update_silver()
        if lake.gold_pending():
            lake.update_gold()
    return lake


def curated_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated of the incrementally maintained lake (equal to a full build)."""
    from ripplecast.schema import CURATED_COLUMNS

    return incremental_lake(spark, sf_dir).curated().select(*CURATED_COLUMNS)


def influencer_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INFLUENCER_RANKING of the incrementally maintained lake (daily rollup)."""
    return incremental_lake(spark, sf_dir).gold("influencer_ranking")


def sentiment_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COMMENT_SENTIMENT of the incrementally maintained lake (touched dates)."""
    return incremental_lake(spark, sf_dir).gold("comment_sentiment")
