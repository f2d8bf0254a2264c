"""Task failures are retried and leave results unchanged (separate JVM with
`local[4,3]`: three attempts per task)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest
from conftest import feed_count

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
pytestmark = pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="driver test data missing")


def test_results_survive_failed_task_attempts():
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tests", "retry_job.py"), ROOT, "/root/testdata/sf0.001"],
        capture_output=True,
        text=True,
        timeout=600,
    )
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT ")]
    assert line, out.stderr[-3000:]
    res = json.loads(line[0][len("RESULT "):])
    rows = feed_count("dedup_events")
    assert res == {"rank_equal": True, "running_equal": True, "bronze": rows, "curated": rows}
