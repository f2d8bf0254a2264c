"""Gold tables: window edges, ties, thresholds, weights, lexicon, R1, R2."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import curated_df
from ripplecast.operators import gold as G
from ripplecast.operators.ranking import global_row_number

T = dt.datetime(2026, 5, 1, 12, 0, 0)


def ts(minutes_before: float) -> dt.datetime:
    return T - dt.timedelta(minutes=minutes_before)


def test_trending_window_edges_ties_and_latest_over_all_events(spark):
    rows = [
        # latest event has no hashtag: still defines the window end (T12)
        dict(event_type="follow", event_timestamp=T),
        dict(hashtag="#a", event_type="like", event_timestamp=ts(1)),  # exactly on 1-min start: inside
        dict(hashtag="#b", event_type="like", event_timestamp=ts(1.0001)),  # just outside 1-min
        dict(hashtag="#b", event_type="follow", event_timestamp=ts(3)),  # any type counts (T13)
        dict(hashtag="#c", event_type="like", event_timestamp=ts(15)),  # on 15-min start
        dict(hashtag="#d", event_type="like", event_timestamp=ts(16)),  # outside all
    ]
    out = G.trending_hashtags(curated_df(spark, rows)).collect()
    got = {(r.window_minutes, r.hashtag): (r.event_count, r.rank) for r in out}
    assert got[(1, "#a")] == (1, 1) and (1, "#b") not in got
    assert got[(5, "#b")] == (2, 1) and got[(5, "#a")] == (1, 2)
    assert got[(15, "#b")] == (2, 1) and got[(15, "#a")] == (1, 2) and got[(15, "#c")] == (1, 3)
    assert all(r.window_end == T for r in out)
    assert {r.window_start for r in out if r.window_minutes == 5} == {ts(5)}


def test_trending_keeps_top_n_per_window(spark):
    rows = [dict(hashtag=f"#t{i:02d}", event_timestamp=ts(0.5)) for i in range(25) for _ in range(1 + i % 3)]
    out = G.trending_hashtags(curated_df(spark, rows), windows_minutes=(1,), top_n=10).collect()
    assert len(out) == 10
    assert [r.rank for r in sorted(out, key=lambda r: r.rank)] == list(range(1, 11))
    # ties broken by hashtag ascending
    threes = sorted([r for r in out if r.event_count == 3], key=lambda r: r.rank)
    assert [r.hashtag for r in threes] == sorted(r.hashtag for r in threes)


def test_viral_threshold_is_strict(spark):
    rows = [dict(event_type="like", post_id="p500", event_timestamp=ts(i % 5)) for i in range(500)]
    rows += [dict(event_type="like", post_id="p501", event_timestamp=ts(i % 5)) for i in range(501)]
    rows += [dict(event_type="like", post_id="old", event_timestamp=ts(6)) for _ in range(600)]
    out = G.viral_posts(curated_df(spark, rows), run_ts="2026-05-01 12:00:00").collect()
    assert [(r.post_id, r.like_count, r.window_minutes) for r in out] == [("p501", 501, 5)]
    assert out[0].window_start == ts(5) and out[0].viral_detected_at == T


def test_influencer_weights_rank_and_self_engagement(spark):
    rows = (
        [dict(event_type="like", post_creator_user_id="u1", user_id="u1")] * 3  # self-likes count
        + [dict(event_type="comment", post_creator_user_id="u2")] * 2
        + [dict(event_type="share", post_creator_user_id="u3")]
        + [dict(event_type="video_view", post_creator_user_id="u4")] * 9  # not engagement
    )
    cur = curated_df(spark, [{**r, "event_timestamp": T} for r in rows])
    users = spark.createDataFrame([("u1", "one"), ("u2", "two")], "user_id string, username string")
    out = sorted(G.influencer_ranking(cur, users).collect(), key=lambda r: r.rank)
    assert [(r.user_id, float(r.engagement_score), r.rank) for r in out] == [
        ("u2", 4.0, 1),
        ("u1", 3.0, 2),
        ("u3", 3.0, 3),
    ]
    assert out[2].username is None


def test_global_row_number_equals_single_task_window(spark):
    rnd = random.Random(7)
    data = [(f"u{i}", rnd.randint(0, 50)) for i in range(2000)]
    df = spark.createDataFrame(data, "user_id string, score int")
    order = [F.desc("score"), F.asc("user_id")]
    dist = global_row_number(df, order, "rank", num_partitions=7)
    plain = df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
    assert dist.exceptAll(plain).count() == 0 and plain.exceptAll(dist).count() == 0


def test_sentiment_lexicon_exact_after_lower(spark):
    texts = ["Amazing!", "NOTED.", "I don't like this.", " great post! ", "Great post", "unknown"]
    rows = [dict(event_type="comment", comment_text=t, event_timestamp=T) for t in texts]
    rows.append(dict(event_type="comment", comment_text=None, event_timestamp=T))
    rows.append(dict(event_type="like", comment_text="Amazing!", event_timestamp=T))
    out = {r.comment_text: r.sentiment for r in G.comment_sentiment(curated_df(spark, rows)).collect()}
    assert out == {
        "Amazing!": "Positive",
        "NOTED.": "Neutral",
        "I don't like this.": "Negative",
        " great post! ": "Neutral",
        "Great post": "Neutral",
        "unknown": "Neutral",
    }


def test_hashtag_trend_change_uses_adjacent_bucket_only(spark):
    rows = (
        [dict(hashtag="#a", event_timestamp=dt.datetime(2026, 1, 1, 10, 5))] * 2
        + [dict(hashtag="#a", event_timestamp=dt.datetime(2026, 1, 1, 11, 5))] * 5
        + [dict(hashtag="#a", event_timestamp=dt.datetime(2026, 1, 1, 13, 5))] * 1  # gap at 12:00
    )
    out = sorted(G.hashtag_trend_over_time(curated_df(spark, rows), 60).collect(), key=lambda r: r.window_start)
    assert [(r.event_count, r.prev_event_count, r.count_change) for r in out] == [(2, 0, 2), (5, 2, 3), (1, 0, 1)]


def _brute_any_window(likes, width_min, threshold):
    by_post = {}
    for p, t in likes:
        by_post.setdefault(p, []).append(t)
    res = {}
    for p, times in by_post.items():
        best = None
        for t in times:
            c = sum(1 for u in times if t - dt.timedelta(minutes=width_min) <= u <= t)
            if c > threshold and (best is None or c > best[0] or (c == best[0] and t < best[1])):
                best = (c, t)
        if best:
            res[p] = best
    return res


def test_viral_any_window_matches_brute_force(spark):
    rnd = random.Random(3)
    likes = []
    base = dt.datetime(2026, 1, 1)
    for p in range(6):
        n = 40 if p == 0 else 12
        for _ in range(n):
            likes.append((f"p{p}", base + dt.timedelta(minutes=rnd.randint(0, 60 * (1 + p)))))
    # a burst straddling bucket boundaries for p1
    likes += [("p1", base + dt.timedelta(minutes=9, seconds=s)) for s in range(0, 240, 20)]
    rows = [dict(event_type="like", post_id=p, event_timestamp=t) for p, t in likes]
    out = G.viral_posts_any_window(curated_df(spark, rows), window_minutes=5, threshold=4).collect()
    got = {r.post_id: (r.like_count, r.window_end) for r in out}
    assert got == _brute_any_window(likes, 5, 4)
    for r in out:
        assert r.window_start == r.window_end - dt.timedelta(minutes=5)


def test_viral_any_window_burst_in_one_bucket_matches_brute_force(spark):
    """A third of all likes on one post within one minute (one time bucket)."""
    base = dt.datetime(2026, 3, 1, 8, 0, 0)
    likes = [("burst", base + dt.timedelta(milliseconds=137 * i)) for i in range(300)]
    rnd = random.Random(11)
    likes += [(f"p{i % 20}", base + dt.timedelta(seconds=rnd.randint(-3600, 3600))) for i in range(600)]
    rows = [dict(event_type="like", post_id=p, event_timestamp=t) for p, t in likes]
    out = G.viral_posts_any_window(curated_df(spark, rows), window_minutes=5, threshold=9).collect()
    got = {r.post_id: (r.like_count, r.window_end) for r in out}
    assert got == _brute_any_window(likes, 5, 9)
    assert got["burst"][0] == 300


def test_every_operator_handles_empty_input(spark):
    from ripplecast.operators import quality as Q

    cur = curated_df(spark, [])
    users = spark.createDataFrame([], "user_id string, username string, country string, created_at timestamp_ntz")
    posts = spark.createDataFrame([], "post_id string, user_id string, hashtag string, created_at timestamp_ntz")
    assert G.trending_hashtags(cur).count() == 0
    assert G.viral_posts(cur).count() == 0
    assert G.influencer_ranking(cur, users).count() == 0
    assert G.comment_sentiment(cur).count() == 0
    assert G.hashtag_trend_over_time(cur).count() == 0
    assert G.viral_posts_any_window(cur).count() == 0
    assert Q.duplicate_events(cur).count() == 0
    assert Q.missing_fields(cur).collect()[0].null_event_id == 0
    assert {r.check: r.violations for r in Q.quality_report(cur, users, posts).collect()}["orphan_users"] == 0
