"""Split parsed events into valid (typed) rows and rejects with rule names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplecast.functions.parsing import utc_timestamp
from ripplecast.functions.rules import failed_rules, is_valid, validation_rules
from ripplecast.schema import CORRUPT_COLUMN, PARSED_COLUMNS, TIMESTAMP_COLUMNS



def typed_events(valid_text: DataFrame, session_tz: str = "UTC") -> DataFrame:
    """The 14 parsed columns with the three timestamps converted (UTC NTZ)."""
    return valid_text.select(
        *[
            utc_timestamp(F.col(c), session_tz).alias(c) if c in TIMESTAMP_COLUMNS else F.col(c)
            for c in PARSED_COLUMNS
        ]
    )


def valid_events(parsed: DataFrame, session_tz: str = "UTC", check_timestamp_parse: bool = True) -> DataFrame:
    """Rows that pass every rule, typed. Map-only filter, pushed next to the parse."""
    rules = validation_rules(check_timestamp_parse=check_timestamp_parse, check_json=CORRUPT_COLUMN in parsed.columns)
    return typed_events(parsed.filter(is_valid(rules)), session_tz)


def rejected_events(parsed: DataFrame, check_timestamp_parse: bool = True) -> DataFrame:
    """Rows failing at least one rule, as received (text), plus `failed_rules`:
    the comma-separated names of every rule that failed, in rule order."""
    rules = validation_rules(check_timestamp_parse=check_timestamp_parse, check_json=CORRUPT_COLUMN in parsed.columns)
    keep = [c for c in parsed.columns if c != CORRUPT_COLUMN]
    return parsed.filter(~is_valid(rules)).select(*keep, failed_rules(rules).alias("failed_rules"))
