"""Lineage cuts that survive executor loss.

Reliable checkpoints go to the shared folder named by `spark.checkpoint.dir`
(see `ripplecast.session.work_dir`); `localCheckpoint` is never used because
its blocks die with the executor that holds them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ripplecast.session import work_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder and return a DataFrame
    that reads it back (eager, reliable checkpoint)."""
    work_dir(df.sparkSession)  # make sure a checkpoint dir is configured
    return df.checkpoint(eager=True)
