"""Parsing edge cases and the named validation rules (incl. the producers'
six invalid events and the malformed message)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import event, messages_df
from ripplecast.functions.parsing import parse_messages
from ripplecast.functions.rules import is_valid, validation_rules
from ripplecast.operators.validate import rejected_events, valid_events


def _parse_one(spark, value):
    return parse_messages(messages_df(spark, [value])).collect()[0]


def test_well_formed_event_parses_all_fields(spark):
    r = _parse_one(spark, event())
    assert r.event_id == "ev_1" and r.event_type == "like" and r.hashtag == "#travel"
    assert r.event_timestamp == "2026-09-03T17:30:00.123456+00:00"
    assert r._corrupt_record is None


@pytest.mark.parametrize(
    "raw",
    [
        '{"event_id":"m1","event_type":"like","user_id":"u"',  # closing brace missing
        "[1, 2]",
        "42",
        "plain text",
    ],
)
def test_unparseable_text_gives_nulls_and_corrupt_marker(spark, raw):
    r = _parse_one(spark, raw)
    assert r.event_id is None and r.user_id is None
    assert r._corrupt_record is not None


@pytest.mark.parametrize("raw", [None, ""])
def test_null_or_empty_message_is_unparseable(spark, raw):
    r = _parse_one(spark, raw)
    assert r.event_id is None
    assert r._corrupt_record is not None


def test_empty_object_parses_to_nulls_and_fails_rules(spark):
    df = parse_messages(messages_df(spark, ["{}"]))
    assert df.filter(is_valid(validation_rules())).count() == 0


def test_lenient_json_cases(spark):
    raws = [
        '{"event_id": 7, "event_type":"follow","user_id":"u","target_user_id":"t","timestamp":"2026-01-01T00:00:00+00:00"}',
        '{"event_id":"a","event_id":"b","event_type":"follow","user_id":"u","target_user_id":"t","timestamp":"2026-01-01T00:00:00+00:00"}',
        '{"event_id":"x","event_type":"follow","user_id":"u","target_user_id":"t","timestamp":"2026-01-01T00:00:00+00:00"} trailing',
        '{"event_id":"y","extra":1,"event_type":"follow","user_id":"u","target_user_id":"t","timestamp":"2026-01-01T00:00:00+00:00"}',
    ]
    rows = parse_messages(messages_df(spark, raws)).collect()
    assert rows[0].event_id == "7"  # number in a string field: its JSON text
    assert rows[1].event_id == "b"  # repeated key: last wins
    assert rows[2].event_id == "x"  # text after the object is ignored
    assert rows[3].event_id == "y"  # unknown keys ignored
    assert valid_events(parse_messages(messages_df(spark, raws))).count() == 4


def test_keys_are_case_sensitive(spark):
    r = _parse_one(spark, '{"EVENT_ID":"a","event_type":"like"}')
    assert r.event_id is None


def test_empty_string_counts_as_present(spark):
    df = parse_messages(messages_df(spark, [event(event_id="", comment_text="")]))
    assert valid_events(df).count() == 1


# The producers' six well-formed but invalid events and the malformed message.
PRODUCER_NEGATIVES = [
    (event(event_id="invalid_001", user_id=None), "user_id_present"),
    (event(event_id="invalid_002", event_type="unknown_event"), "event_type_known"),
    (
        event(event_id="invalid_003", post_id=None, post_creator_user_id=None, post_created_at=None, hashtag=None),
        "post_fields_present",
    ),
    (event(event_id="invalid_004", event_type="comment", comment_text=None), "comment_text_present"),
    (
        event(
            event_id="invalid_005",
            event_type="follow",
            target_user_id=None,
            target_username=None,
            post_id=None,
            post_creator_user_id=None,
            post_created_at=None,
            hashtag=None,
        ),
        "follow_target_present",
    ),
    (
        event(event_id="invalid_006", event_type="profile_visit", timestamp=None, post_id=None, hashtag=None),
        "event_timestamp_present",
    ),
]

EXTRA_NEGATIVES = [
    (event(event_id=None), "event_id_present"),
    (event(event_type="profile_visit", target_user_id=None), "profile_visit_target_present"),
    (event(post_id=None), "post_fields_present"),
    (event(post_creator_user_id=None), "post_fields_present"),
    (event(hashtag=None), "post_fields_present"),
    (event(event_type=None), "event_type_known"),
    (event(timestamp="not a time"), "event_timestamp_parseable"),
    (event(timestamp=""), "event_timestamp_parseable"),
]


@pytest.mark.parametrize("msg,rule", PRODUCER_NEGATIVES + EXTRA_NEGATIVES)
def test_each_invalid_event_is_rejected_with_its_rule(spark, msg, rule):
    parsed = parse_messages(messages_df(spark, [msg]), keep_value=True)
    assert valid_events(parsed.drop("value")).count() == 0
    rej = rejected_events(parsed).collect()
    assert len(rej) == 1
    assert rule in rej[0].failed_rules.split(",")
    assert rej[0].value is not None  # raw message kept for tracing


def test_malformed_message_rejected_as_malformed(spark):
    raw = (
        '{"event_id":"malformed_001","event_type":"like","user_id":"user_25","post_id":"post_1",'
        '"post_creator_user_id":"user_10","hashtag":"#travel","timestamp":"2026-09-03T17:30:10+00:00"'
    )
    rej = rejected_events(parse_messages(messages_df(spark, [raw]), keep_value=True)).collect()
    assert rej[0].failed_rules.split(",")[0] == "malformed_json"
    assert rej[0].value == raw


def test_valid_events_are_typed_utc(spark):
    rows = valid_events(parse_messages(messages_df(spark, [event(timestamp="2026-09-03T19:30:00+02:00")]))).collect()
    assert rows[0].event_timestamp == dt.datetime(2026, 9, 3, 17, 30, 0)
    assert rows[0].user_created_at == dt.datetime(2026, 1, 15, 10, 0, 0)


# Required fields per event type, as a table (an independent statement of the rules).
REQUIRED = {
    "post_created": ("post_id", "post_creator_user_id", "hashtag"),
    "like": ("post_id", "post_creator_user_id", "hashtag"),
    "comment": ("post_id", "post_creator_user_id", "hashtag", "comment_text"),
    "share": ("post_id", "post_creator_user_id", "hashtag"),
    "video_view": ("post_id", "post_creator_user_id", "hashtag"),
    "follow": ("target_user_id",),
    "profile_visit": ("target_user_id",),
}
ALWAYS = ("event_id", "user_id", "event_timestamp")


def test_named_rules_equal_required_field_table_on_driver_feed(spark):
    """On all driver messages the rule conjunction (but for the time's form) equals "known
    type and all fields required for that type present"."""
    from ripplecast.sources.driver_feed import driver_messages

    parsed = parse_messages(driver_messages(spark, "/root/testdata/sf0.001"))
    by_type = F.lit(False)
    for typ, cols in REQUIRED.items():
        present = F.lit(True)
        for c in ALWAYS + cols:
            present = present & F.col(c).isNotNull()
        by_type = F.when(F.col("event_type") == typ, present).otherwise(by_type)
    expected = F.col("_corrupt_record").isNull() & F.coalesce(by_type, F.lit(False))
    rules = validation_rules(check_timestamp_parse=False)
    assert parsed.where(is_valid(rules) != expected).count() == 0
    assert parsed.where(expected).count() > parsed.where(is_valid(validation_rules())).count() > 800


def test_rejects_keep_kafka_coordinates(spark):
    import json as _json

    msgs = spark.createDataFrame(
        [("social_media_events", 3, 1001, bytearray(_json.dumps(event(user_id=None)).encode()))],
        "topic string, partition int, offset long, value binary",
    )
    rej = rejected_events(parse_messages(msgs, keep_value=True)).collect()
    assert (rej[0].topic, rej[0].partition, rej[0].offset) == ("social_media_events", 3, 1001)
    assert rej[0].failed_rules == "user_id_present"
