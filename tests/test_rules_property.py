"""Property test: for random messages the named-rule conjunction equals the
required-fields table, and every reject names at least one failed rule."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import messages_df
from ripplecast.functions.parsing import parse_messages
from ripplecast.functions.rules import failed_rules, is_valid, validation_rules
from test_parse_validate import ALWAYS, REQUIRED

FIELDS = ("event_id", "event_type", "user_id", "target_user_id", "post_id", "post_creator_user_id", "hashtag",
          "comment_text", "timestamp")
TYPES = list(REQUIRED) + ["unknown_event", None]

message = st.fixed_dictionaries(
    {
        "event_type": st.sampled_from(TYPES),
        "present": st.sets(st.sampled_from([f for f in FIELDS if f != "event_type"])),
        "broken": st.booleans(),
    }
)


def expected_valid(m) -> bool:
    if m["broken"] or m["event_type"] not in REQUIRED:
        return False
    need = {"timestamp" if c == "event_timestamp" else c for c in ALWAYS + REQUIRED[m["event_type"]]}
    return need <= m["present"]


def render(m) -> str:
    body = {f: ("2026-01-01T00:00:00+00:00" if f == "timestamp" else f"v_{f}") for f in m["present"]}
    body["event_type"] = m["event_type"]
    text = json.dumps(body)
    return text[:-1] if m["broken"] else text


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(message, min_size=150, max_size=150))
def test_rules_match_required_fields(spark, msgs):
    parsed = parse_messages(messages_df(spark, [render(m) for m in msgs]))
    rules = validation_rules()
    got = parsed.select(is_valid(rules).alias("ok"), failed_rules(rules).alias("why")).collect()
    for m, row in zip(msgs, got):
        assert row.ok == expected_valid(m), (m, row)
        assert (row.why == "") == row.ok


row = st.tuples(
    st.sampled_from(["a", "b", "c", "d"]),  # event_id: many duplicates
    st.one_of(st.none(), st.integers(0, 3)),  # event_timestamp (minutes), NULLs allowed
    st.sampled_from(["x", "y", None]),  # another column
)


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=60, max_size=60))
def test_dedup_earliest_matches_python_reference(spark, rows):
    import datetime as dt

    from ripplecast.operators.dedup import dedup_earliest

    base = dt.datetime(2026, 1, 1)
    data = [(i, None if t is None else base + dt.timedelta(minutes=t), v) for i, t, v in rows]
    df = spark.createDataFrame(data, "event_id string, event_timestamp timestamp_ntz, v string")
    got = {r.event_id: (r.event_timestamp, r.v) for r in dedup_earliest(df).collect()}

    def key(r):  # ascending, NULLs last, on (timestamp, v)
        return (r[1] is None, r[1] or base, r[2] is None, r[2] or "")

    want = {}
    for r in data:
        if r[0] not in want or key(r) < key(want[r[0]]):
            want[r[0]] = r
    assert got == {k: (r[1], r[2]) for k, r in want.items()}


tagged = st.tuples(st.sampled_from(["#a", "#b", "#c", "#d", "#e"]), st.integers(0, 20))


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(tagged, min_size=80, max_size=80))
def test_trending_matches_python_reference(spark, events):
    import datetime as dt

    from conftest import curated_df
    from ripplecast.operators.gold import trending_hashtags

    base = dt.datetime(2026, 1, 1, 12, 0)
    rows = [dict(hashtag=h, event_timestamp=base - dt.timedelta(minutes=m)) for h, m in events]
    got = {
        (r.window_minutes, r.hashtag): (r.event_count, r.rank)
        for r in trending_hashtags(curated_df(spark, rows), windows_minutes=(1, 5, 15), top_n=3).collect()
    }
    latest = max(r["event_timestamp"] for r in rows)
    want = {}
    for w in (1, 5, 15):
        counts = {}
        for r in rows:
            if latest - dt.timedelta(minutes=w) <= r["event_timestamp"] <= latest:
                counts[r["hashtag"]] = counts.get(r["hashtag"], 0) + 1
        ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        for i, (h, n) in enumerate(ranked, 1):
            want[(w, h)] = (n, i)
    assert got == want


engagement = st.tuples(st.sampled_from([f"u{i}" for i in range(12)]),
                       st.sampled_from(["like", "comment", "share", "video_view", "follow"]))


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(engagement, min_size=120, max_size=120))
def test_influencer_ranking_matches_python_reference(spark, events):
    import datetime as dt

    from conftest import curated_df
    from ripplecast.operators.gold import influencer_ranking

    t = dt.datetime(2026, 1, 1)
    rows = [dict(post_creator_user_id=u, event_type=e, event_timestamp=t) for u, e in events]
    users = spark.createDataFrame([(f"u{i}", f"n{i}") for i in range(0, 12, 2)], "user_id string, username string")
    got = {r.user_id: (int(r.engagement_score), r.rank, r.username) for r in
           influencer_ranking(curated_df(spark, rows), users).collect()}
    weight = {"like": 1, "comment": 2, "share": 3}
    score = {}
    for u, e in events:
        if e in weight:
            score[u] = score.get(u, 0) + weight[e]
    order = sorted(score, key=lambda u: (-score[u], u))
    names = {f"u{i}": f"n{i}" for i in range(0, 12, 2)}
    assert got == {u: (score[u], i, names.get(u)) for i, u in enumerate(order, 1)}
