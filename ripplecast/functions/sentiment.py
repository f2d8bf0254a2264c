"""Lexicon sentiment as one CASE expression (Catalyst folds each list to INSET)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ripplecast.constants import (
    NEGATIVE_PHRASES,
    NEUTRAL_PHRASES,
    POSITIVE_PHRASES,
    SENTIMENT_NEGATIVE,
    SENTIMENT_NEUTRAL,
    SENTIMENT_POSITIVE,
)


def lexicon_sentiment(
    text: Column,
    positive=POSITIVE_PHRASES,
    neutral=NEUTRAL_PHRASES,
    negative=NEGATIVE_PHRASES,
) -> Column:
    """Exact match of the lower-cased text (no trim, no tokenising); anything
    else is Neutral. Lists are checked in the order positive, neutral, negative."""
    lowered = F.lower(text)
    return (
        F.when(lowered.isin(*positive), F.lit(SENTIMENT_POSITIVE))
        .when(lowered.isin(*neutral), F.lit(SENTIMENT_NEUTRAL))
        .when(lowered.isin(*negative), F.lit(SENTIMENT_NEGATIVE))
        .otherwise(F.lit(SENTIMENT_NEUTRAL))
    )
