"""Intermediate tables."""

from __future__ import annotations

import time
from pathlib import Path

from ripplecast.llm.tables import CLEANUP, materialise


def test_a_written_table_leaves_no_shuffle_files(spark):
    """Files of the write's exchanges go with its end, not when the driver collects its garbage."""
    folders = [str(x) for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {x.name for d in folders for x in Path(d).glob("*/shuffle_*.data")}
    before, setting = shuffles(), spark.conf.get(CLEANUP, None)
    table = materialise(spark.range(5000).repartition(4, "id").groupBy("id").count(), "shuffled")
    assert spark.conf.get(CLEANUP, None) == setting
    deadline = time.time() + 10
    while shuffles() - before and time.time() < deadline:  # they go in the background
        time.sleep(0.1)
    assert not shuffles() - before
    assert table.count() == 5000
