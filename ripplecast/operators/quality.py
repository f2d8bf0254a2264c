"""The eighteen data-quality / inspection checks, each a DataFrame function,
plus a report that unions (check, violations).

Preview checks order by a full key so their ten rows are repeatable (the
un-ordered LIMIT of the original returns arbitrary rows).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplecast.constants import EVENT_TYPES, GOLD_TABLE_NAMES, PREVIEW_ROWS


def _null_counts(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(alias) for alias, c in spec.items()])


def _duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("duplicate_count")).where(F.col("duplicate_count") > 1)


# 1
def duplicate_events(curated: DataFrame) -> DataFrame:
    return _duplicates(curated, "event_id")


# 2
def missing_fields(curated: DataFrame) -> DataFrame:
    return _null_counts(
        curated,
        {
            "null_event_id": "event_id",
            "null_event_type": "event_type",
            "null_user_id": "user_id",
            "null_event_timestamp": "event_timestamp",
        },
    )


# 3
def invalid_types(curated: DataFrame) -> DataFrame:
    """Distinct unknown types; NULL types are not reported (NOT IN is NULL)."""
    return curated.where(~F.col("event_type").isin(*EVENT_TYPES)).select("event_type").distinct()


# 4
def orphan_users(curated: DataFrame, users: DataFrame) -> DataFrame:
    """Actor ids missing from USER_DIM. Distinct first (partial aggregation),
    then an anti join, so the join sees one row per id."""
    ids = curated.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    return ids.join(users.select("user_id"), "user_id", "left_anti")


# 5
def orphan_posts(curated: DataFrame, posts: DataFrame) -> DataFrame:
    ids = curated.where(F.col("post_id").isNotNull()).select("post_id").distinct()
    return ids.join(posts.select("post_id"), "post_id", "left_anti")


# 6
def duplicate_users(users: DataFrame) -> DataFrame:
    return _duplicates(users, "user_id")


# 7
def duplicate_posts(posts: DataFrame) -> DataFrame:
    return _duplicates(posts, "post_id")


# 8
def gold_counts(trending: DataFrame, viral: DataFrame, influencers: DataFrame, sentiment: DataFrame) -> DataFrame:
    parts = [
        t.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        for name, t in zip(GOLD_TABLE_NAMES, (trending, viral, influencers, sentiment))
    ]
    return reduce(DataFrame.unionByName, parts)


# 9-15
def preview_curated(curated: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return curated.orderBy(F.asc_nulls_last("event_timestamp"), F.asc_nulls_last("event_id")).limit(n)


def preview_users(users: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return users.orderBy(F.asc_nulls_last("user_id")).limit(n)


def preview_posts(posts: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return posts.orderBy(F.asc_nulls_last("post_id")).limit(n)


def preview_trending(trending: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return trending.orderBy("window_minutes", "rank").limit(n)


def preview_viral(viral: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return viral.orderBy(F.desc("like_count"), F.asc_nulls_last("post_id")).limit(n)


def preview_influencers(influencers: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return influencers.orderBy("rank").limit(n)


def preview_sentiment(sentiment: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return sentiment.orderBy(F.asc_nulls_last("event_timestamp"), F.asc_nulls_last("event_id")).limit(n)


# 16
def event_type_distribution(curated: DataFrame) -> DataFrame:
    return (
        curated.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), F.asc_nulls_last("event_type"))
    )


# 17
def user_dim_nulls(users: DataFrame) -> DataFrame:
    return _null_counts(users, {"null_user_id": "user_id", "null_username": "username", "null_country": "country"})


# 18
def post_dim_nulls(posts: DataFrame) -> DataFrame:
    return _null_counts(posts, {"null_post_id": "post_id", "null_user_id": "user_id", "null_created_at": "created_at"})


def quality_report(curated: DataFrame, users: DataFrame, posts: DataFrame) -> DataFrame:
    """(check, violations) for every check that detects faults; 0 = clean."""
    rows = lambda df: df.agg(F.count(F.lit(1)).cast("long").alias("violations"))
    # One pass over curated for the row-level checks (missing fields, unknown types).
    row_level = curated.agg(
        sum(
            (F.count_if(F.col(c).isNull()) for c in ("event_id", "event_type", "user_id", "event_timestamp")),
            F.lit(0),
        ).cast("long").alias("missing"),
        F.count_distinct(F.when(~F.col("event_type").isin(*EVENT_TYPES), F.col("event_type"))).cast("long").alias(
            "invalid"
        ),
    )
    named = F.explode(
        F.array(
            F.struct(F.lit("missing_fields").alias("check"), F.col("missing").alias("violations")),
            F.struct(F.lit("invalid_types").alias("check"), F.col("invalid").alias("violations")),
        )
    )
    parts = {
        "duplicate_events": rows(duplicate_events(curated)),
        "orphan_users": rows(orphan_users(curated, users)),
        "orphan_posts": rows(orphan_posts(curated, posts)),
        "duplicate_users": rows(duplicate_users(users)),
        "duplicate_posts": rows(duplicate_posts(posts)),
        "user_dim_nulls": user_dim_nulls(users).select(
            (F.col("null_user_id") + F.col("null_username") + F.col("null_country")).cast("long").alias("violations")
        ),
        "post_dim_nulls": post_dim_nulls(posts).select(
            (F.col("null_post_id") + F.col("null_user_id") + F.col("null_created_at")).cast("long").alias("violations")
        ),
    }
    return reduce(
        DataFrame.unionByName,
        [row_level.select(named.alias("r")).select("r.*")]
        + [df.select(F.lit(name).alias("check"), "violations") for name, df in parts.items()],
    )
