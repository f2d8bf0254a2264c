"""Session helpers: recommended configuration and the shared work folder.

Library code never creates its own session; callers pass one in. `local_session`
exists for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the pipeline relies on. AQE re-plans joins from measured sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Reliable checkpoints go with the DataFrames that hold them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Streaming dedup keeps one entry per event id: keep that state in RocksDB
    # (off-heap, spills to local disk, checkpointed incrementally) rather than
    # in the JVM heap of the default provider.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Checkpoint a changelog per micro-batch instead of uploading snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ripplecast") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("RIPPLECAST_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Catalog databases of tests / bench go to a scratch folder, not the cwd.
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ripplecast-warehouse-"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for materialised layers and lineage cuts.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. Only when it is
    unset on a *local* master (tests, the smoke driver) a fresh temporary folder
    is created and registered as the checkpoint dir. A cluster without the setting
    is an error: a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir()
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
            configured = sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder on the cluster"
            )
        configured = tempfile.mkdtemp(prefix="ripplecast-ckpt-")
        sc.setCheckpointDir(configured)
        configured = sc.getCheckpointDir()
    return configured.rstrip("/")


def session_time_zone(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone", "UTC")
