"""Small scalar expressions: text lists, empty markers, durations, time formats."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mean "not given", the first-run watermark, the
# open-ended time marker, the look-back in minutes and the time format.
EMPTY_WORDS = ("", "none", "null")
FIRST_WATERMARK = datetime(1900, 1, 1)
OPEN_END = datetime(9999, 12, 31, 23, 59, 59, 999000)
LOOKBACK_MINUTES = 10
MILLIS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def timestamp_literal(value: datetime | str | Column) -> Column:
    """A zone-free timestamp constant; times with a zone are taken as UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime) and value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(str(value)).cast("timestamp_ntz")


def parse_list(column: Column) -> Column:
    """Split a comma list into trimmed, unquoted, non-empty names."""
    bare = F.regexp_replace(column, '"', "")
    return F.filter(F.transform(F.split(bare, ","), lambda x: F.trim(x)), lambda x: x != "")


def none_if_empty(column: Column) -> Column:
    """NULL for texts that only say "nothing" (empty, ``none``, ``null``)."""
    return F.when(~F.lower(F.trim(column)).isin(*EMPTY_WORDS), column)


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", start, end)


def format_millis(column: Column) -> Column:
    """Timestamp text with milliseconds (digits beyond are cut off)."""
    return F.date_format(column, MILLIS_FORMAT)


def look_back(column: Column, minutes: int = LOOKBACK_MINUTES) -> Column:
    """The timestamp ``minutes`` earlier, to catch late rows again."""
    return column - F.expr(f"INTERVAL {int(minutes)} MINUTES")
