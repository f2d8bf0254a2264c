"""Adapter: the driver's generic `events` + `nation` tables → social event messages.

The driver data set has click/view/purchase/signup/error events with a JSON
`props` field. This module maps every row, deterministically, onto the social
vocabulary and serialises it as the JSON message a producer would put on the
topic, with faults seeded by fixed rules on the event id (`seq`):

* every row with ``seq % 20 == 0`` is sent twice (exact duplicate),
* every row with ``seq % 50 == 7`` loses its closing brace (malformed JSON),
* ``seq % 97 == 0`` has no user, ``k >= 97``/``k >= 98`` miss targets/posts,
  ``seq % 41 == 0`` comments miss their text, ``error`` with ``k % 4 == 0``
  gets an unknown type,
* ``seq % 89 == 3`` has no event id, ``seq % 83 == 5`` no time, ``seq % 79 == 4``
  a time that is none.

The attributes of a user or post change from event to event (name, country, creation
time, tag), so a dimension built from any other than the first event differs.

All rows are kept: nothing is filtered, sampled or capped. The plan is map-only
(one broadcast of the 25-row nation table) but for the exchange into log segments;
it scales with `events`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.constants import HASHTAGS, NEGATIVE_PHRASES, NEUTRAL_PHRASES, POSITIVE_PHRASES

TS_MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
TS_SECONDS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"

# Comment texts by `seq % 50`: the three lexicon lists (odd entries upper-cased,
# to exercise case-insensitive matching) then five texts outside the lexicon.
COMMENT_OFF_LEXICON: tuple[str, ...] = (
    " great post! ",  # surrounding blanks: not trimmed, so Neutral
    "great post",
    "unseen phrase",
    "unseen phrase",
    "unseen phrase",
)


def comment_texts() -> list[str]:
    texts: list[str] = []
    for i, phrase in enumerate(POSITIVE_PHRASES + NEUTRAL_PHRASES + NEGATIVE_PHRASES):
        texts.append(phrase.upper() if i % 2 == 1 else phrase)
    return texts + list(COMMENT_OFF_LEXICON)


def _str_id(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def _source_rows(events: DataFrame) -> DataFrame:
    """What the messages are made of: a few short columns of each driver row."""
    k = F.get_json_object(F.col("props"), "$.k").try_cast("int")
    return events.select("event_id", "ts", "user_id", "event_type", k.alias("k"))


def social_rows(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Driver rows → social event fields (strings; timestamps as ISO text)."""
    return _fields(_source_rows(events), nation)


def _fields(source: DataFrame, nation: DataFrame) -> DataFrame:
    nation_small = nation.select(F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("_country"))
    # Broadcast (25 rows): a shuffled join would undo the log segments.
    ev = source.join(
        F.broadcast(nation_small), F.pmod(F.col("user_id") + F.col("event_id") % 3, F.lit(25)) == F.col("_nk"), "left"
    )
    seq = F.col("event_id")
    uid = F.col("user_id")
    k = F.col("k")
    raw = F.col("event_type")
    kind = (
        F.when(raw == "click", F.lit("like"))
        .when(raw == "view", F.when(k % 2 == 0, F.lit("video_view")).otherwise(F.lit("profile_visit")))
        .when(raw == "purchase", F.when(k % 2 == 0, F.lit("share")).otherwise(F.lit("post_created")))
        .when(raw == "signup", F.lit("follow"))
        .when(raw == "error", F.when(k % 4 == 0, F.lit("unknown_event")).otherwise(F.lit("comment")))
    )
    staged = ev.select(
        seq.alias("seq"),
        F.col("ts"),
        uid.alias("uid"),
        F.col("_country"),
        k.alias("k"),
        kind.alias("kind"),
    )
    s, u, kk, t = F.col("seq"), F.col("uid"), F.col("k"), F.col("kind")
    targeted = t.isin("follow", "profile_visit")
    target_n = F.pmod(u + 1 + kk, F.lit(15))
    creator_n = F.pmod(kk, F.lit(15))
    tag_n = F.pmod(kk + s % 2, F.lit(15))
    texts = comment_texts()
    return staged.select(
        F.col("seq"),
        F.when(s % 89 != 3, _str_id("e", s)).alias("event_id"),
        t.alias("event_type"),
        F.when(s % 97 != 0, _str_id("user_", u)).alias("user_id"),
        F.concat(_str_id("name_", u), F.lit("_"), (s % 4).cast("string")).alias("username"),
        F.col("_country").alias("country"),
        F.date_format(
            F.date_add(F.make_date(F.lit(2023), F.lit(1), F.lit(1)), F.pmod(u + s % 7, F.lit(365)).cast("int")).cast(
                "timestamp_ntz"
            ),
            TS_SECONDS_FORMAT,
        ).alias("user_created_at"),
        F.when(targeted, F.when(kk < 97, _str_id("user_", target_n))).otherwise(_str_id("user_", creator_n)).alias(
            "target_user_id"
        ),
        F.when(targeted, F.when(kk < 97, _str_id("name_", target_n))).otherwise(_str_id("name_", creator_n)).alias(
            "target_username"
        ),
        F.when(~targeted & (kk < 98), _str_id("post_", kk)).alias("post_id"),
        F.when(~targeted, _str_id("user_", creator_n)).alias("post_creator_user_id"),
        F.when(
            ~targeted,
            F.date_format(
                F.make_timestamp_ntz(
                    F.lit(2023), F.lit(12), (F.lit(1) + F.floor(kk / 24)).cast("int"), (kk % 24), F.lit(0), F.lit(0)
                ),
                TS_SECONDS_FORMAT,
            ),
        ).alias("post_created_at"),
        F.when(~targeted, F.element_at(F.array(*[F.lit(h) for h in HASHTAGS]), (tag_n + 1).cast("int"))).alias("hashtag"),
        F.when(
            (t == "comment") & (s % 41 != 0),
            F.element_at(F.array(*[F.lit(x) for x in texts]), (F.pmod(s, F.lit(len(texts))) + 1).cast("int")),
        ).alias("comment_text"),
        F.when(s % 79 == 4, F.lit("not a time"))
        .when(s % 83 != 5, F.date_format(F.col("ts"), TS_MICROS_FORMAT))
        .alias("timestamp"),
    )


# A redelivered copy arrives this many messages after the original.
REDELIVERY_LAG = 37


def social_messages(
    events: DataFrame, nation: DataFrame, segments: int | None = None, late_by: int | None = None
) -> DataFrame:
    """One row per message on the topic: column `value` (JSON text).

    With `segments`, the topic is laid out as that many log segments in
    arrival order (range partitions of the arrival position); a redelivered
    copy arrives `REDELIVERY_LAG` messages after its original, so some copies
    fall into a later segment (and a later micro-batch). With `late_by`, the same
    messages arrive in disorder: every thirteenth, and every other copy, that many
    positions later."""
    n = F.col("event_id")
    copies = F.explode(F.when(n % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    source = _source_rows(events).withColumn("copy", copies)
    if segments:
        arrival = n + F.col("copy") * F.lit(REDELIVERY_LAG)
        if late_by:
            late = (n % 13 == 5) | ((F.col("copy") == 1) & (n % 40 == 0))
            arrival = arrival + F.when(late, F.lit(late_by)).otherwise(F.lit(0))
        # The short source columns are exchanged; the messages are composed after it, in their segment.
        source = source.repartitionByRange(segments, arrival, F.col("copy"))
    rows = _fields(source.drop("copy"), nation)
    fields = [c for c in rows.columns if c != "seq"]
    payload = F.to_json(F.struct(*[F.col(c) for c in fields]))
    s = F.col("seq")
    value = F.when(s % 50 == 7, F.expr("substring(_json, 1, length(_json) - 1)")).otherwise(F.col("_json"))
    return rows.select(s, payload.alias("_json")).select(value.alias("value"))


def read_driver_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return events, nation


def driver_messages(
    spark: SparkSession, sf_dir: str, segments: int | None = None, late_by: int | None = None
) -> DataFrame:
    events, nation = read_driver_tables(spark, sf_dir)
    return social_messages(events, nation, segments, late_by)
