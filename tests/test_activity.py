"""User sessions and the activity trend against plain Python, with hot users, gaps of exactly the limit and NULLs."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from conftest import curated_df

from ripplecast.operators import activity as A

START = dt.datetime(2026, 3, 1)


def _events(seed: int, n: int = 400) -> list[dict]:
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        user = "hot" if rng.random() < 0.4 else f"u{rng.randrange(12)}"
        at = START + dt.timedelta(minutes=rng.choice([rng.randrange(6000), 30 * rng.randrange(200)]), microseconds=rng.choice([0, 0, 1]))
        rows.append({"user_id": user, "event_type": rng.choice(["like", "comment", "follow"]), "event_timestamp": at.isoformat()})
    rows.append({"user_id": None, "event_type": "like", "event_timestamp": START.isoformat()})
    rows.append({"user_id": "u1", "event_type": "like", "event_timestamp": None})
    return rows


def _by_user(rows):
    out = defaultdict(list)
    for r in rows:
        if r["user_id"] is not None and r["event_timestamp"] is not None:
            out[r["user_id"]].append((dt.datetime.fromisoformat(r["event_timestamp"]), r["event_type"]))
    return {u: sorted(v) for u, v in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_equal_plain_python(spark, seed):
    rows, gap = _events(seed), dt.timedelta(minutes=30)
    want = []
    for user, events in _by_user(rows).items():
        sessions = []
        for at, kind in events:
            if not sessions or at - sessions[-1][-1][0] > gap:
                sessions.append([])
            sessions[-1].append((at, kind))
        for k, s in enumerate(sessions):
            before = len(sessions[k - 1]) if k else 0
            idle = int((s[0][0] - sessions[k - 1][-1][0]).total_seconds()) if k else None
            engaged = sum(kind in ("like", "comment", "share") for _, kind in s)
            length = int((s[-1][0] - s[0][0]).total_seconds())
            want.append((user, k + 1, s[0][0], s[-1][0], len(s), engaged, length, idle, before, len(s) - before))
    got = [tuple(r) for r in A.user_activity_sessions(curated_df(spark, rows), 30).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_an_event_after_exactly_the_gap_belongs_to_the_session(spark):
    times = ("10:00:00", "10:29:00", "10:59:00", "11:29:00.000001")
    rows = [{"user_id": "u", "event_type": "like", "event_timestamp": f"2026-01-01T{t}"} for t in times]
    got = A.user_activity_sessions(curated_df(spark, rows), 30).orderBy("session_no").collect()
    assert [(r["event_count"], r["idle_seconds"]) for r in got] == [(3, None), (1, 1800)]


@pytest.mark.parametrize("seed", [3, 4])
def test_trend_equals_plain_python(spark, seed):
    rows, width = _events(seed, 120), 480  # buckets are aligned to the epoch
    active = defaultdict(lambda: defaultdict(int))
    for user, events in _by_user(rows).items():
        for at, _ in events:
            active[int((at - START).total_seconds()) // 60 // width][user] += 1
    first = {}
    for b in sorted(active):
        for u in active[b]:
            first.setdefault(u, b)
    want = []
    for b in range(min(active), max(active) + 1):
        now, before = active.get(b, {}), active.get(b - 1, {})
        lapsed = sum(u not in now for u in before)
        if not now and not lapsed:
            continue
        new, again = sum(first[u] == b for u in now), sum(u in before for u in now)
        want.append((
            START + dt.timedelta(minutes=b * width), START + dt.timedelta(minutes=(b + 1) * width), sum(now.values()), len(now),
            new, again, len(now) - new - again, lapsed, len(now) - len(before), sum(now.values()) - sum(before.values()),
        ))
    got = [tuple(r) for r in A.user_activity_trend(curated_df(spark, rows), width).collect()]
    assert sorted(got) == sorted(want)


def test_empty_input(spark):
    none = curated_df(spark, []).limit(0)
    assert A.user_activity_sessions(none).collect() == [] and A.user_activity_trend(none).collect() == []


def test_a_hot_user_is_summed_up_before_the_exchange(spark):
    plan = A.user_activity_sessions(curated_df(spark, _events(5)), 30)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    partial = max(i for i, x in enumerate(lines) if "partial_min(event_timestamp" in x)
    exchange = max(i for i, x in enumerate(lines) if "Exchange hashpartitioning(user_id" in x and "bucket" in x)
    assert exchange < partial  # printed from the top: the partial sums feed the exchange
