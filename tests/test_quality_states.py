"""Quality states: the report from folded dates equals the full one; only the given dates are read and replaced."""

from __future__ import annotations

import random

import pytest
from conftest import curated_df

from ripplecast.operators import quality as Q
from ripplecast.operators import quality_states as S


def _tables(spark, seed=1, n=200):
    rng = random.Random(seed)
    rows = [
        {
            "event_id": rng.choice([None, f"e{rng.randrange(n)}"]) if i % 9 == 0 else f"e{rng.randrange(2 * n)}",
            "event_type": rng.choice(["like", "comment", "odd", "odder", None]),
            "user_id": rng.choice([None, f"u{rng.randrange(20)}"]), "post_id": rng.choice([None, f"p{rng.randrange(20)}"]),
            "event_timestamp": rng.choice([None, *[f"2026-01-{d:02d}T0{rng.randrange(9)}:00:00" for d in range(1, 7)]]),
        }
        for i in range(n)
    ]
    users = spark.createDataFrame([(f"u{i}", None if i % 4 else "n", "c") for i in [*range(12), 3]], "user_id string, username string, country string")
    posts = spark.createDataFrame([(f"p{i}", f"u{i}", None) for i in [*range(15), 1, 2]], "post_id string, user_id string, created_at string")
    return rows, users, posts


DAYS = [f"2026-01-{d:02d}" for d in range(1, 7)] + [S.NO_DATE]


def _report(df):
    return {r["check"]: r["violations"] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_report_from_states_equals_full_report(spark, scratch, seed):
    rows, users, posts = _tables(spark, seed)
    curated = curated_df(spark, rows)
    curated = curated.withColumn("event_date", curated["event_timestamp"].cast("date"))
    for at in range(0, len(DAYS), 2):
        S.fold(curated, scratch, DAYS[at : at + 2])
    assert _report(S.report_from_states(spark, scratch, users, posts)) == _report(Q.quality_report(curated, users, posts))
    got = {r["event_type"]: r["event_count"] for r in S.event_type_distribution(spark, scratch).collect()}
    assert got == {r["event_type"]: r["event_count"] for r in Q.event_type_distribution(curated).collect()}


def test_a_corrected_or_emptied_date_is_replaced(spark, scratch):
    rows, users, posts = _tables(spark)
    S.fold(curated_df(spark, rows), scratch, DAYS)
    S.fold(curated_df(spark, rows[:50] * 2), scratch, DAYS)  # a fold of wrong rows
    emptied = [r for r in rows if not (r["event_timestamp"] or "").startswith("2026-01-03")]
    S.fold(curated_df(spark, emptied), scratch, DAYS)
    want = _report(Q.quality_report(curated_df(spark, emptied), users, posts))
    assert _report(S.report_from_states(spark, scratch, users, posts)) == want


def test_fold_reads_the_given_date_folders_only(spark, scratch):
    rows, _, _ = _tables(spark)
    curated = curated_df(spark, rows)
    curated.withColumn("event_date", curated["event_timestamp"].cast("date")).write.partitionBy("event_date").parquet(f"{scratch}/cur")
    part = S._touched(spark.read.parquet(f"{scratch}/cur"), ["2026-01-02"])
    assert {f.rsplit("event_date=", 1)[1][:10] for f in part.inputFiles()} >= {"2026-01-02"}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2026-01-02" in plan.split("PartitionFilters: [")[1].split("]")[0]
