"""Paths the small test tables never take by themselves: sort-merge lookup
joins with hot keys split, and NULL keys spread."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ripplecast.operators.joins import lookup_left_join
from ripplecast.operators.silver import curated_events, post_dim, user_dim


def _hot_bronze(spark, n=60000):
    """Events where one post and one target user carry a third of all rows,
    and two thirds of the rows have no target (NULL key)."""
    t0 = dt.datetime(2026, 1, 1)
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0
    return ids.select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"),
        F.lit("like").alias("event_type"),
        F.concat(F.lit("user_"), (F.col("id") % 500).cast("string")).alias("user_id"),
        F.concat(F.lit("name_"), (F.col("id") % 500).cast("string")).alias("username"),
        F.lit("X").alias("country"),
        F.lit(t0).cast("timestamp_ntz").alias("user_created_at"),
        F.when(hot, F.lit("user_7")).alias("target_user_id"),
        F.lit(None).cast("string").alias("target_username"),
        F.when(hot, F.lit("post_hot")).otherwise(F.concat(F.lit("post_"), (F.col("id") % 1000).cast("string")))
        .alias("post_id"),
        F.lit("user_7").alias("post_creator_user_id"),
        F.lit(None).cast("timestamp_ntz").alias("post_created_at"),
        F.lit("#tag").alias("hashtag"),
        F.lit(None).cast("string").alias("comment_text"),
        (F.lit(t0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("int")))
        .alias("event_timestamp"),
    )


def _tables(spark, scratch):
    _hot_bronze(spark).write.parquet(scratch + "/bronze")
    bronze = spark.read.parquet(scratch + "/bronze")
    user_dim(bronze).write.parquet(scratch + "/users")
    post_dim(bronze).write.parquet(scratch + "/posts")
    return bronze, spark.read.parquet(scratch + "/users"), spark.read.parquet(scratch + "/posts")


def test_split_lookup_joins_equal_broadcast_joins(spark, scratch):
    bronze, users, posts = _tables(spark, scratch)
    expected = curated_events(bronze, users, posts)  # dims are tiny: broadcast
    assert "BroadcastHashJoin" in expected._jdf.queryExecution().executedPlan().toString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = curated_events(bronze, users, posts, rows_per_split=5000, force_split=True)
        planned = split._jdf.queryExecution().sparkPlan().toString().splitlines()
        rows = split.collect()
        plan = split._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "xxhash64" in plan
    assert sum("SortMergeJoin" in x for x in planned) == 3
    assert sum("FileScan" in x and "event_id" in x for x in planned) == 1  # heavy keys are counted before
    assert sorted(map(tuple, rows)) == sorted(map(tuple, expected.collect()))
    assert len(rows) == 60000


def test_hot_and_null_keys_are_spread_over_tasks(spark, scratch):
    bronze, users, _ = _tables(spark, scratch)
    targets = users.select(F.col("user_id").alias("tid"), F.col("username").alias("tname"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # look at raw hash partitions
    try:
        joined = lookup_left_join(bronze, targets, "target_user_id", "tid", "event_id", rows_per_split=2000,
                                  force_split=True)
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        hot_rows = joined.where("tname = 'name_7'").count()
        null_rows = joined.where("target_user_id IS NULL AND tname IS NULL").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert hot_rows == 20000 and null_rows == 40000
    # 60000 rows over 8 hash partitions: without the split one task would hold
    # the 40000 NULL-key rows and another the 20000 hot rows.
    assert max(r["count"] for r in per_task) < 20000


def test_every_heavy_key_is_split(spark):
    """More heavy keys than any fixed list would hold: none keeps its rows in one task."""
    from ripplecast.operators.joins import lookup_left_join

    fact = spark.range(0, 30_000).selectExpr("cast(id % 30 as string) AS k", "cast(id as string) AS event_id")
    dim = spark.range(0, 30).selectExpr("cast(id as string) AS dk", "id AS v")
    joined = lookup_left_join(fact, dim, "k", "dk", "event_id", rows_per_split=100, force_split=True)
    assert joined.where("v = cast(k as long)").count() == 30_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit" not in plan
