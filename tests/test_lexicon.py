"""Lexicon table: equal to the fixed CASE in both join forms; ties, case, white space, frequent comments."""

from __future__ import annotations

import pytest
from conftest import curated_df

from ripplecast.operators import gold as G
from ripplecast.operators.lexicon import comment_sentiment_by_table, exact_phrase, lexicon_table, loose_phrase
from ripplecast.sources.driver_feed import comment_texts


def _comments(spark, texts):
    at = "2026-01-01T10:00:00"
    rows = [{"event_type": "comment", "comment_text": t, "event_timestamp": at} for t in texts]
    return curated_df(spark, rows + [{"event_type": "like", "comment_text": "great post!", "event_timestamp": at}])


@pytest.mark.parametrize("split", [False, True])
def test_table_equals_the_fixed_lexicon(spark, split):
    curated = _comments(spark, [*comment_texts() * 3, *["great post!"] * 200, None])
    got = comment_sentiment_by_table(curated, lexicon_table(spark), run_ts="2026-01-02 00:00:00", rows_per_split=20, force_split=split)
    want = G.comment_sentiment(curated, run_ts="2026-01-02 00:00:00")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() == 3 * len(comment_texts()) + 200


def test_loose_phrases_and_ties(spark):
    lexicon = spark.createDataFrame(
        [("So  Good", "Positive", 2), ("so good", "Negative", 3), ("tie", "b", 1), ("TIE", "a", 1), (None, "x", 0), ("y", None, 0)],
        "phrase string, sentiment string, priority int",
    )
    curated = _comments(spark, [" so\tGOOD ", "Tie", "y", ""])
    loose = {r["comment_text"]: r["sentiment"] for r in comment_sentiment_by_table(curated, lexicon, loose_phrase).collect()}
    assert loose == {" so\tGOOD ": "Positive", "Tie": "a", "y": "Neutral", "": "Neutral"}
    exact = {r["comment_text"]: r["sentiment"] for r in comment_sentiment_by_table(curated, lexicon, exact_phrase).collect()}
    assert exact == {" so\tGOOD ": "Neutral", "Tie": "a", "y": "Neutral", "": "Neutral"}


def test_a_frequent_comment_is_split(spark):
    curated = _comments(spark, ["great post!"] * 400 + ["rare"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = comment_sentiment_by_table(curated, lexicon_table(spark), rows_per_split=50)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [spoken" in plan and "__salt" in plan
        assert df.where("sentiment = 'Positive'").count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
