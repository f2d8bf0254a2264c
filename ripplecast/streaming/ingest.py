"""Structured Streaming ingest: messages → parse → validate → dedup → BRONZE.

The stream uses the same column functions as the batch ingest. The sink is a
`foreachBatch` function that writes each micro-batch, distributed, to

    <bronze>/query_id=<stream query id>/batch_id=<micro-batch id>

with `mode("overwrite")`. Spark replays a micro-batch after a failure with the
same id and the same input offsets, so a replay replaces its own folder and
never duplicates rows (exactly-once output on top of at-least-once delivery).
The query id is stable across restarts from one checkpoint and keeps separate
queries (a new checkpoint restarts at batch 0) from overwriting each other.
Errors are raised, so Spark marks the batch failed and replays it on restart.

Readers see only committed batch folders (those with `_SUCCESS`), see
`committed_batches`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ripplecast.functions.parsing import parse_messages
from ripplecast.operators.dedup import dedup_stream_exact, dedup_stream_within_watermark
from ripplecast.operators.validate import rejected_events, valid_events
from ripplecast.schema import BRONZE_COLUMNS, PARSED_COLUMNS
from ripplecast.session import session_time_zone


# --------------------------------------------------------------------- sources
def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    **extra: str,
) -> dict[str, str]:
    """Options of the Kafka source: one subscribed topic; a new query starts at
    the latest offsets (a restarted one resumes from its checkpoint)."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    opts.update(extra)
    return opts


def kafka_messages(spark: SparkSession, bootstrap_servers: str, topic: str, **options: str) -> DataFrame:
    """Streaming DataFrame of Kafka records (needs the spark-sql-kafka connector
    on the classpath). Downstream only `value` is parsed; topic / partition /
    offset stay available for tracing rejects."""
    return spark.readStream.format("kafka").options(**kafka_options(bootstrap_servers, topic, **options)).load()


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame with column `value`: one message per line of the
    text files arriving in `path` (the file-based stand-in for a topic)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


# -------------------------------------------------------------- transformation
def clean_stream(
    messages: DataFrame,
    dedup: str = "exact",
    watermark_delay: str = "1 hour",
    session_tz: str = "UTC",
    columns: tuple[str, ...] = PARSED_COLUMNS,
) -> DataFrame:
    """Valid, de-duplicated events with the 14 typed columns, or those of `columns`
    (`event_id` among them): what is not read later need not go through the state exchange.

    dedup="exact": state keeps every id forever (the original job's semantics).
    dedup="watermark": ids are forgotten once the event-time watermark passes
    them by `watermark_delay`; bounded state, but a copy arriving later than the
    delay is emitted again and rows older than the watermark are dropped.
    """
    valid = valid_events(parse_messages(messages), session_tz).select(*columns)
    if dedup == "exact":
        return dedup_stream_exact(valid)
    if dedup == "watermark":
        # Watermarks need an instant (TIMESTAMP); the NTZ column holds UTC.
        with_time = valid.withColumn(
            "event_time", F.convert_timezone(F.lit("UTC"), F.lit(session_tz), F.col("event_timestamp")).cast("timestamp")
        )
        return dedup_stream_within_watermark(with_time, watermark_delay, event_time="event_time").drop("event_time")
    raise ValueError(f"unknown dedup mode {dedup!r}")


# ------------------------------------------------------------------------ sink
def batch_folder(root: str, query_id: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/query_id={query_id}/batch_id={batch_id}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def idempotent_batch_sink(
    root: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    skip_empty: bool = True,
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function writing each micro-batch to its own folder with
    overwrite (replay-safe). `prepare` maps the batch before writing.

    With `skip_empty`, a micro-batch without rows (all invalid or duplicate)
    leaves no folder: an empty one is removed again. The stateful upstream runs once,
    in the write; the batch is not held in memory or on the executors' disks."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "adhoc"
        out = prepare(batch_df) if prepare else batch_df
        folder = batch_folder(root, query_id, batch_id)
        out.write.mode("overwrite").parquet(folder)
        if skip_empty and spark.read.schema(out.schema).parquet(folder).isEmpty():
            _delete(spark, folder)

    return write


def _bronze_prepare(df: DataFrame) -> DataFrame:
    return df.withColumn("ingested_at", F.current_timestamp()).select(*BRONZE_COLUMNS)


def start_ingest(
    messages: DataFrame,
    bronze_path: str,
    checkpoint: str,
    dedup: str = "exact",
    watermark_delay: str = "1 hour",
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the bronze ingest stream; the caller decides how long to wait
    (`awaitTermination`, `processAllAvailable`, `spark.streams.awaitAnyTermination`)."""
    tz = session_time_zone(messages.sparkSession)
    clean = clean_stream(messages, dedup=dedup, watermark_delay=watermark_delay, session_tz=tz)
    writer = (
        clean.writeStream.foreachBatch(idempotent_batch_sink(bronze_path, _bronze_prepare))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(**(trigger or {"processingTime": "0 seconds"}))
    return writer.start()


def start_rejects(
    messages: DataFrame,
    rejects_path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Second, stateless query on the same source: rejected messages with the
    names of the failed rules (own checkpoint, same idempotent sink)."""
    rejects = rejected_events(parse_messages(messages, keep_value=True))
    writer = (
        rejects.writeStream.foreachBatch(idempotent_batch_sink(rejects_path))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
    )
    return writer.start()


# --------------------------------------------------------------------- readers
def committed_batches(spark: SparkSession, root: str) -> list[str]:
    """Folders `query_id=*/batch_id=*` under `root` whose write committed.
    Only paths are listed on the driver (metadata), never rows."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(conf)
    if not fs.exists(base):
        return []
    out: list[str] = []
    for q in fs.listStatus(base):
        if not q.isDirectory() or not q.getPath().getName().startswith("query_id="):
            continue
        for b in fs.listStatus(q.getPath()):
            p = b.getPath()
            if b.isDirectory() and p.getName().startswith("batch_id=") and fs.exists(
                jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")
            ):
                out.append(p.toString())
    return sorted(out)


def read_batches(spark: SparkSession, root: str, columns=BRONZE_COLUMNS, schema=None) -> DataFrame:
    """All committed micro-batch folders as one DataFrame (declared columns).
    With no committed batch yet: an empty frame of `schema` (default BRONZE)."""
    paths = committed_batches(spark, root)
    if not paths:
        from ripplecast.schema import BRONZE_SCHEMA

        return spark.createDataFrame([], schema or BRONZE_SCHEMA).select(*columns)
    return spark.read.option("basePath", root).parquet(*paths).select(*columns)
