"""Comment sentiment by a lexicon table of any size.

`functions.sentiment.lexicon_sentiment` folds 45 phrases into the query. A lexicon of millions
of phrases is a table: it is reduced to one label per normalised phrase and joined with
the comments by `joins.lookup_left_join`, which broadcasts a lexicon under the
planner's threshold and sort-merges a larger one with frequent comments ("nice!") split over
several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.constants import (
    NEGATIVE_PHRASES,
    NEUTRAL_PHRASES,
    POSITIVE_PHRASES,
    SENTIMENT_NEGATIVE,
    SENTIMENT_NEUTRAL,
    SENTIMENT_POSITIVE,
)
from ripplecast.operators.gold import run_timestamp
from ripplecast.operators.joins import fits_broadcast, heavy_keys, lookup_left_join
from ripplecast.schema import SENTIMENT_COLUMNS


def lexicon_table(spark: SparkSession) -> DataFrame:
    """The fixed phrases as (phrase, sentiment, priority): a lower priority wins."""
    lists = ((POSITIVE_PHRASES, SENTIMENT_POSITIVE), (NEUTRAL_PHRASES, SENTIMENT_NEUTRAL), (NEGATIVE_PHRASES, SENTIMENT_NEGATIVE))
    rows = [(phrase, label, k) for k, (phrases, label) in enumerate(lists) for phrase in phrases]
    return spark.createDataFrame(rows, "phrase string, sentiment string, priority int")


def exact_phrase(text: Column) -> Column:
    """As the fixed lexicon compares: lower case, neither trimmed nor tokenised."""
    return F.lower(text)


def loose_phrase(text: Column) -> Column:
    """Lower case, white space trimmed and collapsed."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def comment_sentiment_by_table(
    curated: DataFrame, lexicon: DataFrame, normalise=exact_phrase, run_ts=None, session_tz: str = "UTC",
    rows_per_split: int = 2_000_000, force_split: bool = False,
) -> DataFrame:
    """COMMENT_SENTIMENT with the labels of `lexicon` (phrase, sentiment, priority), compared after
    `normalise`; a phrase listed several times has its label of least priority, then of
    least name, and a comment outside the lexicon is Neutral."""
    labels = (
        lexicon.where(F.col("phrase").isNotNull() & F.col("sentiment").isNotNull())
        .groupBy(normalise(F.col("phrase")).alias("lex_phrase"))
        .agg(F.min(F.struct("priority", "sentiment"))["sentiment"].alias("label"))
    )
    comments = curated.where((F.col("event_type") == "comment") & F.col("comment_text").isNotNull()).select(
        "event_id", "post_id", "user_id", "comment_text", "event_timestamp",
        normalise(F.col("comment_text")).alias("spoken"),
    )
    heavy = None
    if force_split or not fits_broadcast(lexicon):
        heavy = heavy_keys(comments, ("spoken",), rows_per_split)["spoken"]
    joined = lookup_left_join(comments, labels, "spoken", "lex_phrase", salt_col="event_id", heavy=heavy)
    return joined.select(
        "event_id", "post_id", "user_id", "comment_text",
        F.coalesce("label", F.lit(SENTIMENT_NEUTRAL)).alias("sentiment"), "event_timestamp",
        run_timestamp(run_ts, session_tz).alias("calculated_at"),
    ).select(*SENTIMENT_COLUMNS)
