"""First-seen dimensions on a stream.

A dimension row is the least (event time, event id, attributes) of its key: a streaming
aggregation keeps it in the state store, one row a key, and reduces each micro-batch before the
state exchange, so a key of a third of all events ships one row per input partition. The row
also carries the time of the micro-batch that brought it. A key's row has changed in a
micro-batch exactly when it carries that micro-batch's time: only then it is emitted,
as a new row or as the correction that a late event makes necessary.

The sink appends what is emitted, one folder a micro-batch; the dimension is the least
row of each key over the folders. Redelivered copies change nothing, so no deduplication is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ripplecast.functions.parsing import parse_messages
from ripplecast.operators.silver import ORDER_COLUMNS, POST_DIM_COLUMNS, USER_DIM_COLUMNS, first_per_key
from ripplecast.operators.validate import valid_events
from ripplecast.session import session_time_zone
from ripplecast.streaming.ingest import idempotent_batch_sink, read_batches

#: dimension -> (key, event column of each further dimension column)
DIMENSIONS = {
    "user_dim": ("user_id", {"username": "username", "country": "country", "created_at": "user_created_at"}),
    "post_dim": ("post_id", {"user_id": "post_creator_user_id", "hashtag": "hashtag", "created_at": "post_created_at"}),
}
COLUMNS = {"user_dim": USER_DIM_COLUMNS, "post_dim": POST_DIM_COLUMNS}


def first_seen_changes(events: DataFrame, dimension: str) -> DataFrame:
    """Rows of `dimension` that the micro-batch adds or corrects (update mode), with their ordering key."""
    key, values = DIMENSIONS[dimension]
    row = F.struct(
        F.col("event_timestamp").isNull().alias("untimed"),  # NULL times last
        F.col("event_timestamp").alias("first_seen_at"),
        F.col("event_id").alias("first_event_id"),
        *(F.col(source).alias(name) for name, source in values.items()),
        F.col("brought_at"),
    )
    brought = events.where(F.col(key).isNotNull()).withColumn("brought_at", F.current_timestamp())
    first = brought.groupBy(key).agg(F.min(row).alias("first"))
    changed = first.where(F.col("first.brought_at") == F.current_timestamp())
    return changed.select(key, *(F.col(f"first.{c}").alias(c) for c in (*values, *ORDER_COLUMNS)))


def start_dimension(
    messages: DataFrame, dimension: str, out_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Maintain `dimension` from a message stream; each micro-batch's changes go to a folder of its own."""
    events = valid_events(parse_messages(messages), session_time_zone(messages.sparkSession))
    return (
        first_seen_changes(events, dimension)
        .writeStream.foreachBatch(idempotent_batch_sink(out_path))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def dimension_changes(spark: SparkSession, out_path: str, dimension: str) -> DataFrame:
    """All emitted rows: first sights and corrections."""
    columns = (*COLUMNS[dimension], *ORDER_COLUMNS)
    times = ("created_at", "first_seen_at")
    schema = ", ".join(f"{c} {'timestamp_ntz' if c in times else 'string'}" for c in columns)
    return read_batches(spark, out_path, columns=columns, schema=schema)


def read_dimension(spark: SparkSession, out_path: str, dimension: str) -> DataFrame:
    """The dimension as of the last committed micro-batch."""
    key = DIMENSIONS[dimension][0]
    columns = COLUMNS[dimension]
    values = tuple(c for c in columns if c != key)
    return first_per_key(dimension_changes(spark, out_path, dimension), key, ORDER_COLUMNS, values).select(*columns)
