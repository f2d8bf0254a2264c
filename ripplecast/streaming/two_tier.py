"""One pass over a message stream: exact deduplication with bounded state, bronze and rejects together.

Every message is parsed once and judged once. Two tiers decide whether an event id is new:

* *Recent ids* are in the state store. They are forgotten when `ttl` has passed since their
  arrival: processing time (`stamped`), or the time of a file or broker, where `ttl` must exceed
  the disorder of arrivals. Unlike event time it never makes a late event too late.
  Rejects pass with a key of their own, so no copy of a reject is lost.
* *Older ids* are in an index beside bronze: per micro-batch and event date, the id and its
  64-bit hash. What passes the first tier is looked up there by hash and id, reading only
  micro-batches that the state may have forgotten, and with `same_time` (copies carry their original's
  event time, as redelivered messages do) only the event dates at hand.

A micro-batch is written in this order: its outcome (one job runs the stateful plan, once),
then bronze, rejects and ids from that, at last one commit row. Readers take only
micro-batches with a commit row, so bronze, rejects and ids always agree. A replayed
micro-batch overwrites its own folders and reads none of its own ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ripplecast.functions.parsing import parse_messages
from ripplecast.functions.rules import failed_rules, is_valid, validation_rules
from ripplecast.operators.validate import typed_events
from ripplecast.schema import BRONZE_COLUMNS, PARSED_COLUMNS
from ripplecast.session import session_time_zone
from ripplecast.streaming.ingest import _delete, batch_folder, committed_batches

ARRIVED = "arrived_at"
COMMIT_SCHEMA = (
    "query_id string, batch_id long, bronze_rows long, late_copies long, reject_rows long, "
    "first_arrival timestamp, last_arrival timestamp"
)


def arrivals(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File messages with their arrival time: the file's time stands in for a broker's `timestamp`."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select("value", F.col("_metadata.file_modification_time").alias(ARRIVED))


def stamped(messages: DataFrame) -> DataFrame:
    """Any message stream with its processing time, which never runs backwards."""
    return messages.withColumn(ARRIVED, F.current_timestamp())


def judged_once(messages: DataFrame, ttl: str) -> DataFrame:
    """Parsed messages with `failed_rules` ('' for valid ones), without the copies of recent ids. Only rejects
    take their raw text through the state exchange and the outcome: bronze has no use for it."""
    parsed = parse_messages(messages, keep_value=True, carry=(ARRIVED,))
    rules = validation_rules()
    valid = is_valid(rules)
    key = F.when(valid, F.concat(F.lit("id:"), F.col("event_id"))).otherwise(F.concat(F.lit("reject:"), F.expr("uuid()")))
    judged = parsed.select(
        ARRIVED, F.when(~valid, F.col("value")).alias("value"), *PARSED_COLUMNS,
        F.when(valid, F.lit("")).otherwise(failed_rules(rules)).alias("failed_rules"),
        F.when(valid, F.lit("bronze")).otherwise(F.lit("rejects")).alias("outcome"), key.alias("dedup_key"),
    )
    return judged.withWatermark(ARRIVED, ttl).dropDuplicatesWithinWatermark(["dedup_key"]).drop("dedup_key")


def _ids(events: DataFrame) -> DataFrame:
    return events.select(
        F.xxhash64("event_id").alias("id_hash"), "event_id", F.to_date("event_timestamp").alias("event_date")
    )


def known_ids(spark: SparkSession, root: str, events: DataFrame, batches: list[str], same_time: bool) -> DataFrame:
    """Ids of `events` that the index of `batches` holds."""
    older = spark.read.option("basePath", f"{root}/ids").parquet(*batches)
    probe = _ids(events)
    if same_time:  # at most one row per day of event time
        days = [r[0] for r in probe.select("event_date").distinct().collect()]
        older = older.where(F.col("event_date").isin(days))
    return older.select("id_hash", "event_id").join(probe.drop("event_date"), ["id_hash", "event_id"], "left_semi")


def two_tier_sink(root: str, ttl: str, same_time: bool, session_tz: str):
    """foreachBatch function of `start_two_tier`."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "adhoc"

        def folder(kind: str) -> str:
            return batch_folder(f"{root}/{kind}", query_id, batch_id)

        stage = folder("_stage")
        batch_df.write.mode("overwrite").partitionBy("outcome").parquet(stage, compression="zstd")
        staged = spark.read.schema(batch_df.schema).parquet(stage)
        events = typed_events(staged.where("outcome = 'bronze'"), session_tz)
        commits = read_commits(spark, root)
        rejected = F.count_if(F.col("outcome") == "rejects")
        ranges = staged.agg(F.min(ARRIVED).alias("first"), F.max(ARRIVED).alias("last"), rejected.alias("rejects")).first()
        if ranges["first"] is None:
            return
        # The state still holds what arrived within `ttl` before this micro-batch.
        forgotten = commits.where(
            (F.col("first_arrival") < F.lit(ranges["first"]) - F.expr(f"INTERVAL {ttl}"))
            & ~((F.col("query_id") == query_id) & (F.col("batch_id") == batch_id))
        ).select("query_id", "batch_id").collect()
        batches = [batch_folder(f"{root}/ids", r["query_id"], r["batch_id"]) for r in forgotten]
        late = 0
        if batches:
            copies = known_ids(spark, root, events, batches, same_time).select("event_id").distinct()
            copies.write.mode("overwrite").parquet(folder("_late"))
            copies = spark.read.schema("event_id string").parquet(folder("_late"))
            late = copies.count()
            events = events.join(copies, "event_id", "left_anti")
        bronze = events.withColumn("ingested_at", F.current_timestamp()).select(*BRONZE_COLUMNS)
        bronze.write.mode("overwrite").parquet(folder("bronze"))
        written = spark.read.schema(bronze.schema).parquet(folder("bronze"))
        _ids(written).write.mode("overwrite").partitionBy("event_date").parquet(folder("ids"))
        rejects = staged.where("outcome = 'rejects'").select("value", *PARSED_COLUMNS, "failed_rules")
        rejects.write.mode("overwrite").parquet(folder("rejects"))
        commit = (query_id, batch_id, written.count(), late, ranges["rejects"], ranges["first"], ranges["last"])
        spark.createDataFrame([commit], COMMIT_SCHEMA).write.mode("overwrite").parquet(folder("_commits"))
        for kind in ("_stage", "_late"):  # a replay writes them again
            _delete(spark, folder(kind))

    return write


def start_two_tier(
    messages: DataFrame, root: str, checkpoint: str, ttl: str = "24 hours", same_time: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Bronze and rejects of a stream with column `arrived_at`, exactly once, in one query."""
    tz = session_time_zone(messages.sparkSession)
    return (
        judged_once(messages, ttl)
        .writeStream.foreachBatch(two_tier_sink(root.rstrip("/"), ttl, same_time, tz))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed micro-batch."""
    paths = committed_batches(spark, f"{root}/_commits")
    if not paths:
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).parquet(*paths)


def _committed(spark: SparkSession, root: str, kind: str, schema: str) -> DataFrame:
    rows = read_commits(spark, root).select("query_id", "batch_id").collect()  # one per micro-batch
    paths = [batch_folder(f"{root}/{kind}", r["query_id"], r["batch_id"]) for r in rows]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    from ripplecast.schema import BRONZE_SCHEMA

    return _committed(spark, root, "bronze", BRONZE_SCHEMA).select(*PARSED_COLUMNS)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    columns = ("value", *PARSED_COLUMNS, "failed_rules")
    return _committed(spark, root, "rejects", ", ".join(f"{c} string" for c in columns))
