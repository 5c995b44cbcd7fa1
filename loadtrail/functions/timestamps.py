"""Time expressions on zone-less timestamps; none of them depends on the session time zone.

Like all functions of this package they take SQL expressions and return one.
"""

from __future__ import annotations

from loadtrail import constants as c
from loadtrail.functions.sql import text


def cut_to_second(ts: str) -> str:
    """Start of the one-second window around `ts`; stands in a select list and drops rows without a time."""
    return f"window({ts}, '1 second').start"


def epoch_seconds(ts: str) -> str:
    days = f"CAST(date_diff(CAST({ts} AS DATE), DATE'1970-01-01') AS BIGINT)"
    return f"({days} * 86400 + hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}))"


def minutes_between(earlier: str, later: str) -> str:
    """Minutes as a double, keeping microseconds; null if either side is null, negative if reversed."""
    seconds = f"CAST(CAST({later} - {earlier} AS INTERVAL SECOND) AS DECIMAL(38, 6))"
    return f"CAST({seconds} AS DOUBLE) / 60D"


def parse_timestamp(value: str) -> str:
    """Text to timestamp; anything unreadable becomes null."""
    return f"try_cast({value} AS TIMESTAMP_NTZ)"


def written_timestamp(value: str) -> str:
    """Text as the CSV sink writes a time, `yyyy-MM-dd HH:mm:ss` with up to six digits of a second; else null."""
    return f"CASE WHEN rlike({value}, {text(c.WRITTEN_TIMESTAMP_PATTERN)}) THEN {parse_timestamp(value)} END"


def millis_to_timestamp(millis: str) -> str:
    seconds = f"CAST({millis} / 1000BD AS DECIMAL(18, 6))"
    return f"(TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}))"


def received_date(millis: str) -> str:
    return f"date_format(CAST({millis_to_timestamp(millis)} AS DATE), '{c.RECEIVED_DATE_FORMAT}')"


def date_label(day: str) -> str:
    """`5thDEC` style label of a date."""
    number = f"dayofmonth({day})"
    suffix = (
        f"CASE WHEN {number} BETWEEN 11 AND 13 THEN 'th' WHEN {number} % 10 = 1 THEN 'st' "
        f"WHEN {number} % 10 = 2 THEN 'nd' WHEN {number} % 10 = 3 THEN 'rd' ELSE 'th' END"
    )
    return f"concat({number}, {suffix}, upper(date_format({day}, 'MMM')))"
