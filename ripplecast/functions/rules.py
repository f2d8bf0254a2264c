"""Named validation rules for parsed events.

Every rule is a boolean Column over the parsed (string) columns. An event is
valid when every rule is TRUE; NULL counts as failure. Rules conditional on the
event type do not apply when the type is NULL (that case already fails
`event_type_known`), so a reject lists only rules that really failed.
The conjunction accepts exactly the events the original single validity
predicate accepts, plus the `malformed_json` and `event_timestamp_parseable`
rules (see README, deviations).
"""

from __future__ import annotations

from collections import OrderedDict
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ripplecast.constants import EVENT_TYPES, POST_EVENT_TYPES
from ripplecast.schema import CORRUPT_COLUMN

# Rule names, in report order.
MALFORMED_JSON = "malformed_json"
EVENT_ID_PRESENT = "event_id_present"
EVENT_TYPE_KNOWN = "event_type_known"
USER_ID_PRESENT = "user_id_present"
EVENT_TIMESTAMP_PRESENT = "event_timestamp_present"
EVENT_TIMESTAMP_PARSEABLE = "event_timestamp_parseable"
POST_FIELDS_PRESENT = "post_fields_present"
COMMENT_TEXT_PRESENT = "comment_text_present"
FOLLOW_TARGET_PRESENT = "follow_target_present"
PROFILE_VISIT_TARGET_PRESENT = "profile_visit_target_present"


def _not_type(name: str) -> Column:
    return F.coalesce(F.col("event_type") != F.lit(name), F.lit(True))


def validation_rules(check_timestamp_parse: bool = True, check_json: bool = True) -> "OrderedDict[str, Column]":
    c = F.col
    rules: "OrderedDict[str, Column]" = OrderedDict()
    if check_json:
        rules[MALFORMED_JSON] = c(CORRUPT_COLUMN).isNull()
    rules[EVENT_ID_PRESENT] = c("event_id").isNotNull()
    rules[EVENT_TYPE_KNOWN] = F.coalesce(c("event_type").isin(*EVENT_TYPES), F.lit(False))
    rules[USER_ID_PRESENT] = c("user_id").isNotNull()
    rules[EVENT_TIMESTAMP_PRESENT] = c("event_timestamp").isNotNull()
    if check_timestamp_parse:
        rules[EVENT_TIMESTAMP_PARSEABLE] = (
            c("event_timestamp").isNull() | F.try_to_timestamp(c("event_timestamp")).isNotNull()
        )
    rules[POST_FIELDS_PRESENT] = F.coalesce(~c("event_type").isin(*POST_EVENT_TYPES), F.lit(True)) | (
        c("post_id").isNotNull() & c("post_creator_user_id").isNotNull() & c("hashtag").isNotNull()
    )
    rules[COMMENT_TEXT_PRESENT] = _not_type("comment") | c("comment_text").isNotNull()
    rules[FOLLOW_TARGET_PRESENT] = _not_type("follow") | c("target_user_id").isNotNull()
    rules[PROFILE_VISIT_TARGET_PRESENT] = _not_type("profile_visit") | c("target_user_id").isNotNull()
    return rules


def is_valid(rules: "OrderedDict[str, Column]") -> Column:
    """TRUE iff every rule is TRUE (NULL → FALSE)."""
    return reduce(lambda a, b: a & b, (F.coalesce(r, F.lit(False)) for r in rules.values()))


def failed_rules(rules: "OrderedDict[str, Column]") -> Column:
    """Comma-separated names of the failed rules, in rule order ('' if none)."""
    return F.concat_ws(
        ",",
        *[F.when(~F.coalesce(r, F.lit(False)), F.lit(name)) for name, r in rules.items()],
    )
