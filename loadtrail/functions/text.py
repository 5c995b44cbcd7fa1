"""Text expressions for alerts, ids and keys."""

from __future__ import annotations

from loadtrail import constants as c
from loadtrail.functions.sql import text

# (?d): only \n ends a line; white space includes the information separators \x1c..\x1f
_AFTER_LABEL = f"(?d){c.ALERT_LABEL}(.*)"
_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def alert_text(comment: str) -> str:
    """Text after the alert label up to the end of that line, trimmed; unchanged without the label."""
    after = f"regexp_replace(regexp_extract({comment}, {text(_AFTER_LABEL)}, 1), {text(_OUTER_SPACE)}, '')"
    return f"CASE WHEN contains({comment}, {text(c.ALERT_LABEL)}) THEN {after} ELSE {comment} END"


def without_load_prefix(value: str) -> str:
    """Drop every `Load #<digits>:` and the trailing characters of the fixed set."""
    no_prefix = f"regexp_replace({value}, {text(c.LOAD_PREFIX_PATTERN)}, '')"
    return f"regexp_replace({no_prefix}, {text(c.TAIL_CHARACTERS_PATTERN)}, '')"


def execution_id(request_id: str, load_id: str) -> str:
    """Null if either part is null."""
    return f"concat({request_id}, '-', {load_id})"


def load_number(value: str) -> str:
    """Whole number as BIGINT; null for anything else, overflow included."""
    return f"CASE WHEN rlike({value}, {text(c.INTEGER_PATTERN)}) THEN try_cast({value} AS BIGINT) END"


def shipper_key(shipper_id: str) -> str:
    return f"translate({shipper_id}, '-', '_')"


def decode_base64url(data: str) -> str:
    return f"unbase64(translate({data}, '-_', '+/'))"
