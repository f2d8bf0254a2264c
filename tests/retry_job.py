"""Run by test_retries.py in its own JVM with task retries enabled: first
attempts of some tasks fail; results must equal a run without failures."""

from __future__ import annotations

import json
import sys
import tempfile

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

spark = (
    SparkSession.builder.master("local[4,3]")  # 3 attempts per task
    .config("spark.sql.shuffle.partitions", "6")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ripplecast-retry-ckpt-"))

from ripplecast.operators.ranking import global_row_number, global_running_sum  # noqa: E402
from ripplecast.plans.lakehouse import Lakehouse  # noqa: E402
from ripplecast.sources.driver_feed import driver_messages  # noqa: E402


@F.udf(T.LongType())
def flaky(x):
    # Test-only fault injection: the first attempt of even partitions fails.
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return x


data = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 13).alias("v"))
shaky = data.select(flaky("k").alias("k"), "v")
rank = global_row_number(shaky, [F.desc("v"), F.asc("k")], "r", num_partitions=5)
plain = data.withColumn("r", F.row_number().over(Window.orderBy(F.desc("v"), F.asc("k"))).cast("long"))
run = global_running_sum(shaky, [F.asc("k")], F.col("v"), "s", num_partitions=5)
plain_run = data.withColumn("s", F.sum("v").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))

lake = Lakehouse(spark, tempfile.mkdtemp(prefix="ripplecast-retry-lake-"))
msgs = driver_messages(spark, sys.argv[2], 4)
lake.write_landing(msgs.select(F.when(flaky(F.lit(1)) == 1, F.col("value")).alias("value")))
lake.build_bronze()
lake.build_silver()

print(
    "RESULT "
    + json.dumps(
        {
            "rank_equal": rank.exceptAll(plain).count() == 0 and plain.exceptAll(rank).count() == 0,
            "running_equal": run.exceptAll(plain_run).count() == 0 and plain_run.exceptAll(run).count() == 0,
            "bronze": lake.bronze().count(),
            "curated": lake.curated().count(),
        }
    )
)
