"""Global (un-partitioned) ROW_NUMBER without funnelling rows into one task.

`row_number().over(Window.orderBy(...))` plans `Exchange SinglePartition`: all
rows are sorted by one task. Here rows are range-partitioned on the order key
(so partition i holds keys before partition i+1), numbered inside each
partition, and shifted by the row counts of all earlier partitions. Only one
row per partition (at most `spark.sql.shuffle.partitions` rows) is gathered to
build the offsets, a proven size bound, so that small table is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplecast.plans.lineage import cut_lineage


#: Rows of a range partition. The number of partitions follows the row count, without a ceiling.
ROWS_PER_PARTITION = 1_000_000


def range_partitioned(df: DataFrame, order: list[Column], num_partitions: int | None = None) -> DataFrame:
    """`df` in range partitions of `order`: as many as given, else one per `ROWS_PER_PARTITION`
    rows. The input is computed once, written, and counted and sampled from there."""
    frozen = cut_lineage(df)
    n = int(num_partitions) if num_partitions else max(1, -(-frozen.count() // ROWS_PER_PARTITION))
    return frozen.repartitionByRange(n, *order)


def global_row_number(
    df: DataFrame,
    order: list[Column],
    name: str = "rank",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add `name` = 1-based position of each row in the total order `order`.

    `order` must be a total order (end it with a unique column), otherwise
    ties are numbered in an arbitrary but valid way.
    """
    # Range partition + sort inside each partition: partition ids follow the order.
    ranged = range_partitioned(df, order, num_partitions).sortWithinPartitions(*order)
    # monotonically_increasing_id = (partition id << 33) + position in the
    # partition's (sorted) iteration order.
    numbered = ranged.select(
        "*",
        F.spark_partition_id().alias("__pid"),
        (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33) + 1).alias("__local"),
    )
    # Freeze partition ids and positions before reading them twice.
    frozen = cut_lineage(numbered)
    sizes = frozen.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    )
    return (
        frozen.join(F.broadcast(offsets), "__pid", "left")
        .select(
            *[F.col(c) for c in df.columns],
            (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__local")).alias(name),
        )
    )


def global_running_sum(
    df: DataFrame,
    order: list[Column],
    value: Column,
    name: str = "running",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add `name` = sum of `value` over all rows up to and including this one in
    the total order `order` (a global cumulative sum).

    Same scheme as `global_row_number`: range partitions follow the order, a
    window per partition adds up its own rows (each range partition is one
    balanced task), and offsets from one row per partition (bounded, broadcast)
    shift the partitions. No key or time bucket is ever gathered into one task.
    """
    ranged = range_partitioned(df.select("*", value.alias("__v")), order, num_partitions)
    frozen = cut_lineage(ranged.select("*", F.spark_partition_id().alias("__pid")))
    w = Window.partitionBy("__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = frozen.select("*", F.sum("__v").over(w).alias("__local"))
    sizes = frozen.groupBy("__pid").agg(F.sum("__v").alias("__n"))
    offsets = sizes.select(
        "__pid",
        F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)).alias("__off"),
    )
    return local.join(F.broadcast(offsets), "__pid", "left").select(
        *[F.col(c) for c in df.columns],
        (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__local")).alias(name),
    )
