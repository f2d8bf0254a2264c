"""Reading the corpus tables and writing intermediate tables in the shared folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ripplecast.session import work_dir


#: Spark's setting that removes the shuffle files of an SQL execution at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package from any working folder.

    On a cluster the package is installed or passed with --py-files.
    """
    if spark.sparkContext.master.startswith("local"):
        env = spark.sparkContext.environment
        if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH")) if x)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of repeating the job.
    So the write's shuffle files go with its end; else they stay until the driver collects its garbage.
    """
    path = f"{work_dir(df.sparkSession)}/llm/{label}-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions of a keyed exchange of packed rows: the session's own setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
