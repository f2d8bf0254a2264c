"""Domain constants of the social event pipeline.

FIXED VALUES: the lists below must equal the values the producers emit and
the analytical SQL tests for, so they are stated verbatim, in their natural
order, in one place.
"""

from __future__ import annotations

# --- FIXED VALUES: event vocabulary -----------------------------------------
EVENT_TYPES: tuple[str, ...] = (
    "post_created",
    "like",
    "comment",
    "share",
    "follow",
    "video_view",
    "profile_visit",
)

# Event types that must carry post information.
POST_EVENT_TYPES: tuple[str, ...] = (
    "post_created",
    "like",
    "comment",
    "share",
    "video_view",
)

# Engagement types that count towards a creator's score, with weights.
ENGAGEMENT_WEIGHTS: dict[str, int] = {"like": 1, "comment": 2, "share": 3}

# --- FIXED VALUES: hashtags used by the producer ----------------------------
HASHTAGS: tuple[str, ...] = (
    "#travel",
    "#food",
    "#fitness",
    "#music",
    "#technology",
    "#fashion",
    "#sports",
    "#gaming",
    "#photography",
    "#lifestyle",
    "#nature",
    "#business",
    "#coding",
    "#movies",
    "#vacation",
)

# --- FIXED VALUES: sentiment lexicon (matched after lower-casing) -----------
POSITIVE_PHRASES: tuple[str, ...] = (
    "amazing!",
    "love this!",
    "this is fantastic!",
    "great post!",
    "absolutely beautiful!",
    "this made my day!",
    "so inspiring!",
    "i really enjoyed this!",
    "wonderful content!",
    "this is awesome!",
    "great job!",
    "i love it!",
    "very helpful!",
    "fantastic video!",
    "such a great experience!",
)

NEUTRAL_PHRASES: tuple[str, ...] = (
    "interesting.",
    "thanks for sharing.",
    "i see.",
    "good to know.",
    "interesting information.",
    "thanks for posting.",
    "i had not seen this before.",
    "this is useful information.",
    "nice post.",
    "good information.",
    "i will keep this in mind.",
    "interesting perspective.",
    "thanks for the update.",
    "i understand.",
    "noted.",
)

NEGATIVE_PHRASES: tuple[str, ...] = (
    "i don't like this.",
    "this was disappointing.",
    "not very useful.",
    "i disagree with this.",
    "this could be much better.",
    "i did not enjoy this.",
    "this is disappointing.",
    "the quality is poor.",
    "i expected more.",
    "not a good experience.",
    "this did not work for me.",
    "i am not impressed.",
    "unfortunately this was bad.",
    "i don't recommend this.",
    "this needs improvement.",
)

SENTIMENT_POSITIVE = "Positive"
SENTIMENT_NEUTRAL = "Neutral"
SENTIMENT_NEGATIVE = "Negative"

# --- FIXED VALUES: analytical defaults ---------------------------------------
TRENDING_WINDOWS_MINUTES: tuple[int, ...] = (1, 5, 15)
TRENDING_TOP_N = 10
VIRAL_WINDOW_MINUTES = 5
VIRAL_LIKE_THRESHOLD = 500  # strictly greater than
PREVIEW_ROWS = 10

# Names of the gold tables, as reported by the record-count check.
GOLD_TABLE_NAMES: tuple[str, ...] = (
    "TRENDING_HASHTAGS",
    "VIRAL_POSTS",
    "INFLUENCER_RANKING",
    "COMMENT_SENTIMENT",
)
