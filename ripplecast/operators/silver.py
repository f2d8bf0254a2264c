"""SILVER: first-seen dimensions and the curated (enriched) event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplecast.operators.joins import fits_broadcast, heavy_keys, lookup_left_join
from ripplecast.schema import CURATED_COLUMNS


def first_per_key(df: DataFrame, key: str, order: tuple[str, ...], values: tuple[str, ...]) -> DataFrame:
    """For each non-NULL `key`, the `values` of its first row by `order`
    (ascending, NULLs last). Callers end `order` with a unique column
    (e.g. `event_id`) so ties are broken the same way on every run.

    `row_number() = 1` plans as a partial `WindowGroupLimit` before the shuffle
    and a final one after it, so a hot key (one user with a third of all
    events) contributes one row per input partition to the exchange.
    """
    w = Window.partitionBy(key).orderBy(*[F.asc_nulls_last(c) for c in order])
    return (
        df.where(F.col(key).isNotNull())
        .select(key, *order, *[v for v in values if v not in order])
        .withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") == 1)
        .select(key, *values)
    )


# First-seen rows keep the key of their ordering, so a later batch of events can
# be merged without rereading old events: the first row of (old ∪ new) is the
# first of (old first row, new first row).
ORDER_COLUMNS = ("first_seen_at", "first_event_id")
USER_DIM_COLUMNS = ("user_id", "username", "country", "created_at")
POST_DIM_COLUMNS = ("post_id", "user_id", "hashtag", "created_at")


def user_first_seen(bronze: DataFrame) -> DataFrame:
    """USER_DIM columns plus `first_seen_at`, `first_event_id` of the row."""
    first = first_per_key(
        bronze,
        "user_id",
        ("event_timestamp", "event_id"),
        ("username", "country", "user_created_at", "event_timestamp", "event_id"),
    )
    return first.select(
        "user_id",
        "username",
        "country",
        F.col("user_created_at").alias("created_at"),
        F.col("event_timestamp").alias("first_seen_at"),
        F.col("event_id").alias("first_event_id"),
    )


def post_first_seen(bronze: DataFrame) -> DataFrame:
    """POST_DIM columns plus `first_seen_at`, `first_event_id` of the row."""
    first = first_per_key(
        bronze,
        "post_id",
        ("event_timestamp", "event_id"),
        ("post_creator_user_id", "hashtag", "post_created_at", "event_timestamp", "event_id"),
    )
    return first.select(
        "post_id",
        F.col("post_creator_user_id").alias("user_id"),
        "hashtag",
        F.col("post_created_at").alias("created_at"),
        F.col("event_timestamp").alias("first_seen_at"),
        F.col("event_id").alias("first_event_id"),
    )


def merge_first_seen(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """First-seen rows of old ∪ new events, from the two first-seen tables."""
    values = tuple(c for c in old.columns if c != key)
    return first_per_key(old.unionByName(new), key, ORDER_COLUMNS, values)


def user_dim(bronze: DataFrame) -> DataFrame:
    """USER_DIM(user_id, username, country, created_at): the attributes of each
    user's earliest event."""
    return user_first_seen(bronze).select(*USER_DIM_COLUMNS)


def post_dim(bronze: DataFrame) -> DataFrame:
    """POST_DIM(post_id, user_id, hashtag, created_at) from each post's earliest event."""
    return post_first_seen(bronze).select(*POST_DIM_COLUMNS)


def curated_events(
    bronze: DataFrame,
    users: DataFrame,
    posts: DataFrame,
    rows_per_split: int = 2_000_000,
    force_split: bool = False,
) -> DataFrame:
    """CURATED_EVENTS: every bronze row, re-enriched from the dimensions.

    Three left equi-joins (actor, target, post), each a `lookup_left_join`:
    a dimension under the broadcast threshold is broadcast by the planner; a
    larger one is sort-merge joined with hot keys (a viral post, a bot user, the
    NULL target of most events) split over several tasks.
    """
    events = bronze.select(
        "event_id", "event_type", "user_id", "target_user_id", "post_id", "comment_text", "event_timestamp"
    )
    actors = users.select(
        F.col("user_id").alias("actor_id"), F.col("username").alias("actor_name"), F.col("country").alias("actor_country")
    )
    targets = users.select(F.col("user_id").alias("target_id"), F.col("username").alias("target_name"))
    post_info = posts.select(
        F.col("post_id").alias("dim_post_id"), F.col("user_id").alias("creator_id"), F.col("hashtag").alias("post_tag")
    )
    lookups = (
        (actors, "user_id", "actor_id"),
        (targets, "target_user_id", "target_id"),
        (post_info, "post_id", "dim_post_id"),
    )
    large = tuple(key for dim, key, _ in lookups if force_split or not fits_broadcast(dim))
    # Counted over the input before any join: the joins below each read their fact once.
    heavy = heavy_keys(events, large, rows_per_split) if large else {}
    joined = events
    for dim, key, dim_key in lookups:
        joined = lookup_left_join(joined, dim, key, dim_key, salt_col="event_id", heavy=heavy.get(key))
    out = joined.select(
        "event_id",
        "event_type",
        "user_id",
        F.col("actor_name").alias("username"),
        F.col("actor_country").alias("country"),
        "target_user_id",
        F.col("target_name").alias("target_username"),
        "post_id",
        F.col("creator_id").alias("post_creator_user_id"),
        F.col("post_tag").alias("hashtag"),
        "comment_text",
        "event_timestamp",
    )
    assert tuple(out.columns) == CURATED_COLUMNS
    return out
