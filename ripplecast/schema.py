"""Declared schemas of every layer. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
TS = T.TimestampNTZType()  # UTC wall clock; see README "Semantic decisions"

# JSON message as sent by producers: 14 string fields, all nullable.
EVENT_MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", S),
        T.StructField("event_type", S),
        T.StructField("user_id", S),
        T.StructField("username", S),
        T.StructField("country", S),
        T.StructField("user_created_at", S),
        T.StructField("target_user_id", S),
        T.StructField("target_username", S),
        T.StructField("post_id", S),
        T.StructField("post_creator_user_id", S),
        T.StructField("post_created_at", S),
        T.StructField("hashtag", S),
        T.StructField("comment_text", S),
        T.StructField("timestamp", S),
    ]
)

CORRUPT_COLUMN = "_corrupt_record"

# Same fields plus the column PERMISSIVE parsing fills for unparseable text.
EVENT_MESSAGE_SCHEMA_WITH_CORRUPT = T.StructType(
    EVENT_MESSAGE_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, S)]
)

# Flattened parse output: the JSON key `timestamp` becomes `event_timestamp`.
PARSED_COLUMNS: tuple[str, ...] = (
    "event_id",
    "event_type",
    "user_id",
    "username",
    "country",
    "user_created_at",
    "target_user_id",
    "target_username",
    "post_id",
    "post_creator_user_id",
    "post_created_at",
    "hashtag",
    "comment_text",
    "event_timestamp",
)

TIMESTAMP_COLUMNS: tuple[str, ...] = ("user_created_at", "post_created_at", "event_timestamp")

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField(c, TS if c in TIMESTAMP_COLUMNS else S)
        for c in PARSED_COLUMNS
    ]
    + [T.StructField("ingested_at", T.TimestampType())]
)

BRONZE_COLUMNS: tuple[str, ...] = tuple(f.name for f in BRONZE_SCHEMA.fields)

USER_DIM_COLUMNS: tuple[str, ...] = ("user_id", "username", "country", "created_at")
POST_DIM_COLUMNS: tuple[str, ...] = ("post_id", "user_id", "hashtag", "created_at")

CURATED_COLUMNS: tuple[str, ...] = (
    "event_id",
    "event_type",
    "user_id",
    "username",
    "country",
    "target_user_id",
    "target_username",
    "post_id",
    "post_creator_user_id",
    "hashtag",
    "comment_text",
    "event_timestamp",
)

TRENDING_COLUMNS = ("window_minutes", "hashtag", "event_count", "rank", "window_start", "window_end")
VIRAL_COLUMNS = (
    "post_id",
    "like_count",
    "window_minutes",
    "window_start",
    "window_end",
    "viral_detected_at",
)
INFLUENCER_COLUMNS = (
    "user_id",
    "username",
    "like_count",
    "comment_count",
    "share_count",
    "total_engagement",
    "engagement_score",
    "rank",
    "calculated_at",
)
SENTIMENT_COLUMNS = (
    "event_id",
    "post_id",
    "user_id",
    "comment_text",
    "sentiment",
    "event_timestamp",
    "calculated_at",
)
