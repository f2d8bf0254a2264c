"""End to end through the job runner (stream ingest → batch build → catalog),
then warehouse-style SQL on the registered tables equals the DataFrame
operators."""

from __future__ import annotations

import os

import pytest
from conftest import feed_count

from ripplecast.operators import gold as G
from ripplecast.operators import quality as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data missing")

DAY = 1440


@pytest.fixture(scope="module")
def built(spark):
    import tempfile

    from ripplecast.jobs import build_batch, start_streams
    from ripplecast.plans.lakehouse import GoldParams, Lakehouse
    from ripplecast.sources.driver_feed import driver_messages
    from ripplecast.streaming.ingest import file_messages

    root = tempfile.mkdtemp(prefix="ripplecast-jobs-")
    lake = Lakehouse(
        spark,
        root,
        GoldParams(trending_windows_minutes=(DAY, 5 * DAY, 15 * DAY), viral_window_minutes=5 * DAY, viral_threshold=2),
    )
    lake.write_landing(driver_messages(spark, SF))
    for q in start_streams(lake, file_messages(spark, lake.path("landing")), trigger={"availableNow": True}):
        q.awaitTermination()
        assert q.exception() is None
    build_batch(lake)
    return lake


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_ingest_counts(spark, built):
    rows = feed_count("dedup_events")  # valid after dedup at sf0.001
    assert built.bronze().count() == rows
    assert built.rejects().count() == feed_count("rejected_events")
    assert built.users().count() == feed_count("user_dim")
    assert spark.table("bronze.raw_events").count() == rows
    assert spark.table("silver.curated_events").count() == rows
    assert spark.table("bronze.rejected_events").count() == feed_count("rejected_events")


def test_sql_duplicate_and_missing_checks(spark, built):
    dup = spark.sql(
        "SELECT event_id, n AS duplicate_count FROM "
        "(SELECT event_id, count(1) AS n FROM silver.curated_events GROUP BY 1) WHERE n >= 2"
    )
    assert same(dup, Q.duplicate_events(built.curated()))
    miss = spark.sql(
        "SELECT count(1) - count(event_id) AS null_event_id, count(1) - count(event_type) AS null_event_type, "
        "count(1) - count(user_id) AS null_user_id, count(1) - count(event_timestamp) AS null_event_timestamp "
        "FROM silver.curated_events"
    )
    assert same(miss, Q.missing_fields(built.curated()))


def test_sql_first_seen_dimension(spark, built):
    users = spark.sql(
        """
        SELECT user_id, first.username, first.country, first.created_at FROM (
            SELECT user_id,
                   min_by(named_struct('username', username, 'country', country, 'created_at', user_created_at),
                          named_struct('t', event_timestamp, 'id', event_id)) AS first
            FROM bronze.raw_events WHERE user_id IS NOT NULL GROUP BY user_id)
        """
    )
    assert users.count() == 15
    assert same(users, spark.table("silver.user_dim"))


def test_sql_trending_equals_one_pass_operator(spark, built):
    spans = (DAY, 5 * DAY, 15 * DAY)
    sql = f"""
    SELECT span AS window_minutes, hashtag, n AS event_count, pos AS rank,
           hi - make_dt_interval(0, 0, CAST(span AS INT)) AS window_start, hi AS window_end
    FROM (
        SELECT span, hashtag, hi, n,
               CAST(row_number() OVER (PARTITION BY span ORDER BY n DESC, hashtag) AS BIGINT) AS pos
        FROM (
            SELECT span, hashtag, hi, count(1) AS n
            FROM (SELECT hashtag, event_timestamp,
                         (SELECT max(event_timestamp) FROM silver.curated_events) AS hi
                  FROM silver.curated_events WHERE hashtag IS NOT NULL) c
            LATERAL VIEW explode(array({", ".join(f"CAST({w} AS BIGINT)" for w in spans)})) s AS span
            WHERE c.event_timestamp BETWEEN hi - make_dt_interval(0, 0, CAST(span AS INT)) AND hi
            GROUP BY span, hashtag, hi))
    WHERE pos <= 10
    """
    got = G.trending_hashtags(built.curated_partitioned(), spans)
    assert same(spark.sql(sql), got)
    assert same(spark.table("gold.trending_hashtags"), got)


def test_sql_influencers_equal_operator(spark, built):
    sql = """
    SELECT t.user_id, d.username,
           CAST(t.score AS DECIMAL(10,2)) AS engagement_score,
           CAST(row_number() OVER (ORDER BY t.score DESC, t.user_id) AS BIGINT) AS rank
    FROM (
        SELECT post_creator_user_id AS user_id,
               sum(CASE event_type WHEN 'like' THEN 1 WHEN 'comment' THEN 2 WHEN 'share' THEN 3 END) AS score
        FROM silver.curated_events
        WHERE post_creator_user_id IS NOT NULL AND event_type IN ('like', 'comment', 'share')
        GROUP BY 1) t
    LEFT JOIN silver.user_dim d ON d.user_id = t.user_id
    """
    got = spark.table("gold.influencer_ranking").select("user_id", "username", "engagement_score", "rank")
    assert same(spark.sql(sql), got)


def test_cli_ingest_build_report(spark, capsys):
    import tempfile

    from ripplecast.jobs import main
    from ripplecast.plans.lakehouse import Lakehouse
    from ripplecast.sources.driver_feed import driver_messages

    root = tempfile.mkdtemp(prefix="ripplecast-cli-")
    landing = tempfile.mkdtemp(prefix="ripplecast-cli-landing-")
    driver_messages(spark, SF).write.mode("overwrite").text(landing)
    assert main(["ingest", "--root", root, "--files", landing, "--available-now"]) == 0
    assert main(["build", "--root", root, "--windows", f"{DAY},{5 * DAY},{15 * DAY}", "--viral-minutes",
                 str(5 * DAY), "--viral-threshold", "2"]) == 0
    lake = Lakehouse(spark, root)
    assert lake.bronze().count() == feed_count("dedup_events") and lake.rejects().count() == feed_count("rejected_events")
    assert lake.gold("trending_hashtags").count() == 30
    assert main(["report", "--root", root]) == 0
    assert "duplicate_events" in capsys.readouterr().out


def test_ensure_keeps_stream_written_bronze(spark, built):
    from ripplecast.plans.lakehouse import Lakehouse

    again = Lakehouse(spark, built.root, built.gold_params)
    again.ensure("gold")
    # still the stream's batch folders (no batch rebuild over them)
    assert again.bronze().count() == feed_count("dedup_events")
    assert again.spark.read.parquet(again.path("bronze")).columns[-2:] == ["query_id", "batch_id"]
