"""Posts with more than N likes in any trailing window, exactly, on a stream.

A like at time t raises only the frames that end in [t, t + w], and these read only likes
in [t - w, t + w]. So each micro-batch appends its likes, counted per post and instant, to a log (a folder a
micro-batch, by day), reads back the likes around its own, post by post, and counts their frames with
the batch operator (`gold.like_peaks`: range partitions, so neither a hot post nor a
hot instant is gathered in a task). Frames at the rim of what was read miss likes and count
too low, never too high, and were counted in full before. The peaks found go to a folder
a micro-batch; a post's peak is the greatest of them, at the earliest end. Late
likes of any age count like all others; the stream keeps no state but the deduplication's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ripplecast.constants import VIRAL_LIKE_THRESHOLD, VIRAL_WINDOW_MINUTES
from ripplecast.operators.gold import like_peaks, like_times, likes_per_instant, peak_rows
from ripplecast.streaming.ingest import batch_folder, committed_batches

DAY_US = 86_400_000_000
LIKE_SCHEMA = "post_id string, t long, n long, day long"
#: What `peak_sink` reads of an event: its input needs no more, whatever goes through a deduplication before it.
LIKE_COLUMNS = ("event_id", "event_type", "post_id", "event_timestamp")
PEAK_SCHEMA = "post_id string, like_count long, end_us long"


def peak_sink(root: str, window_minutes: int, threshold: int):
    """foreachBatch function: the micro-batch's likes to the log, the peaks around them to a folder."""
    width = int(window_minutes) * 60_000_000

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "adhoc"
        own = batch_folder(f"{root}/likes", query_id, batch_id)
        likes = likes_per_instant(like_times(batch_df)).withColumn("day", F.floor(F.col("t") / DAY_US))
        likes.write.mode("overwrite").partitionBy("day").parquet(own)
        new = spark.read.schema(LIKE_SCHEMA).parquet(own)
        around = new.groupBy("post_id", "day").agg((F.min("t") - width).alias("lo"), (F.max("t") + width).alias("hi"))
        days = around.agg(F.min("lo"), F.max("hi")).first()
        if days[0] is None:
            return
        log = read_likes(spark, root).where(F.col("day").between(days[0] // DAY_US, days[1] // DAY_US))
        ranges = around.select(F.col("post_id").alias("of"), "lo", "hi")
        inside = (F.col("post_id") == F.col("of")) & F.col("t").between(F.col("lo"), F.col("hi"))
        near = log.join(ranges, inside, "left_semi")
        instants = near.groupBy("post_id", "t").agg(F.sum("n").alias("n"))  # over the micro-batches
        peaks = like_peaks(instants, window_minutes, threshold)
        peaks.write.mode("overwrite").parquet(batch_folder(f"{root}/peaks", query_id, batch_id))

    return write


def read_likes(spark: SparkSession, root: str) -> DataFrame:
    paths = committed_batches(spark, f"{root}/likes")
    return spark.read.schema(LIKE_SCHEMA).option("basePath", f"{root}/likes").parquet(*paths)


def start_peaks(
    events: DataFrame, root: str, checkpoint: str, window_minutes: int = VIRAL_WINDOW_MINUTES,
    threshold: int = VIRAL_LIKE_THRESHOLD, trigger: dict | None = None,
) -> StreamingQuery:
    """Maintain the peaks of a clean event stream (`ingest.clean_stream`)."""
    return (
        events.writeStream.foreachBatch(peak_sink(root.rstrip("/"), window_minutes, threshold))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def read_peaks(spark: SparkSession, root: str, window_minutes: int = VIRAL_WINDOW_MINUTES) -> DataFrame:
    """The columns of `gold.viral_posts_any_window`, as of the last micro-batch."""
    paths = committed_batches(spark, f"{root}/peaks")
    found = spark.read.schema(PEAK_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], PEAK_SCHEMA)
    greatest = F.struct(-F.col("like_count"), F.col("end_us"))
    best = found.groupBy("post_id").agg(
        F.max("like_count").alias("like_count"), F.min_by("end_us", greatest).alias("end_us")
    )
    return peak_rows(best, window_minutes)
