"""Quality checks kept up to date: mergeable states per event date instead of the curated table.

A state table holds what a check needs of one date: counts of rows and NULLs per event type, event ids
with their number, user ids, post ids. `fold` replaces the states of the dates it is given and reads
no other date of curated; replacing makes a repeated or corrected fold harmless. The report and the
type distribution are then aggregations over the states, which hold a few narrow columns
(one row per id and date, reduced before the exchange), never the events themselves.

A folded date always has a row of its own (n = 0), so one that lost all its rows is replaced as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.constants import EVENT_TYPES
from ripplecast.operators import quality as Q

#: Rows without event time belong to this date.
NO_DATE = "none"
NULLS = ("event_id", "event_type", "user_id", "event_timestamp")
_NULL_COUNTS = ", ".join(f"null_{c} long" for c in NULLS)
SCHEMAS = {
    "rows": f"event_type string, n long, {_NULL_COUNTS}, day string",
    "ids": "event_id string, n long, day string",
    "users": "user_id string, n long, day string",
    "posts": "post_id string, n long, day string",
}


def day_of(event_timestamp: Column) -> Column:
    return F.coalesce(F.to_date(event_timestamp).cast("string"), F.lit(NO_DATE))


def _touched(curated: DataFrame, days: list[str]) -> DataFrame:
    part = curated
    if "event_date" in curated.columns and NO_DATE not in days:  # prunes the date folders
        part = curated.where(F.col("event_date").isin([F.lit(d).cast("date") for d in days]))
    return part.withColumn("day", day_of(F.col("event_timestamp"))).where(F.col("day").isin(days))


def fold(curated: DataFrame, root: str, days: list[str]) -> None:
    """Replace the states of `days` (ISO dates, or NO_DATE) by those of curated's rows of these days."""
    spark = curated.sparkSession
    part = _touched(curated, days)
    counts = [F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in NULLS)]
    number = F.count(F.lit(1)).alias("n")
    states = {
        "rows": part.groupBy("day", "event_type").agg(*counts),
        "ids": part.groupBy("day", "event_id").agg(number),
        "users": part.where("user_id IS NOT NULL").groupBy("day", "user_id").agg(number),
        "posts": part.where("post_id IS NOT NULL").groupBy("day", "post_id").agg(number),
    }
    folded = spark.createDataFrame([(d,) for d in days], "day string").withColumn("n", F.lit(0).cast("long"))
    for name, state in states.items():
        state.unionByName(folded, allowMissingColumns=True).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("day").parquet(f"{root}/{name}")


def read_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}").where("n > 0")


def event_type_distribution(spark: SparkSession, root: str) -> DataFrame:
    return read_state(spark, root, "rows").groupBy("event_type").agg(F.sum("n").alias("event_count"))


def report_from_states(spark: SparkSession, root: str, users: DataFrame, posts: DataFrame) -> DataFrame:
    """The rows of `quality.quality_report`, from the states and the dimensions."""
    rows, ids = read_state(spark, root, "rows"), read_state(spark, root, "ids")
    missing = sum((F.coalesce(F.sum(f"null_{c}"), F.lit(0)) for c in NULLS), F.lit(0))
    unknown = F.count_distinct(F.when(~F.col("event_type").isin(*EVENT_TYPES), F.col("event_type")))
    many = ids.groupBy("event_id").agg(F.sum("n").alias("n")).where("n > 1")
    count = F.count(F.lit(1))
    parts = {
        "missing_fields": rows.agg(missing.alias("v")),
        "invalid_types": rows.agg(unknown.alias("v")),
        "duplicate_events": many.agg(count.alias("v")),
        "orphan_users": Q.orphan_users(read_state(spark, root, "users"), users).agg(count.alias("v")),
        "orphan_posts": Q.orphan_posts(read_state(spark, root, "posts"), posts).agg(count.alias("v")),
        "duplicate_users": Q.duplicate_users(users).agg(count.alias("v")),
        "duplicate_posts": Q.duplicate_posts(posts).agg(count.alias("v")),
    }
    for name, nulls in (("user_dim_nulls", Q.user_dim_nulls(users)), ("post_dim_nulls", Q.post_dim_nulls(posts))):
        parts[name] = nulls.select(reduce(Column.__add__, map(F.col, nulls.columns)).alias("v"))
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("check"), F.col("v").cast("long").alias("violations")) for name, df in parts.items()],
    )
