"""Plan-shape checks: the properties the design relies on at scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data missing")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E._reference_queries()))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["dedup_events", "user_dim", "post_dim"])
def test_first_row_per_key_is_limited_before_the_shuffle(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below


def test_messages_are_parsed_once(spark):
    plan = plan_of(E.queries()["valid_events"](spark, SF))
    assert plan.count("from_json(") == 1


@pytest.mark.parametrize("name", ["trending_hashtags", "viral_posts"])
def test_latest_window_prunes_date_partitions(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "event_date#" in plan and "Subquery" in plan


def test_global_rank_is_range_partitioned(spark):
    plan = plan_of(E.queries()["influencer_ranking"](spark, SF))
    # the ranked rows come from a checkpoint of a range-partitioned sort;
    # only the per-partition size table is broadcast
    assert "BroadcastExchange" in plan


def test_curated_joins_are_left_outer_without_hints(spark):
    plan = plan_of(E.queries()["curated_events"](spark, SF))
    assert plan.count("LeftOuter") == 3


def test_orphan_checks_use_anti_joins(spark):
    for name in ("dq_orphan_users", "dq_orphan_posts"):
        assert "LeftAnti" in plan_of(E.queries()[name](spark, SF))
