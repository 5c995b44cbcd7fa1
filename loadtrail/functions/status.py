"""Status, flag and note expressions."""

from __future__ import annotations

from loadtrail import constants as c
from loadtrail.functions.sql import text


def response_status(message: str, updated_at: str) -> str:
    return (
        f"CASE WHEN {message} IS NULL THEN '{c.AWAITING_STATUS}' "
        f"WHEN {updated_at} IS NULL THEN '{c.FAILED_STATUS}' ELSE '{c.SUCCESS_STATUS}' END"
    )


def trigger_text(comment: str) -> str:
    """The comment of an alert row, null for any other row."""
    return f"CASE WHEN {comment} LIKE {text(f'%{c.ALERT_LABEL} %')} THEN {comment} END"


def escalated_flag(status: str) -> str:
    return f"CASE WHEN {status} = '{c.ESCALATION_SENT_STATUS}' THEN '{c.FLAG_YES}' END"


def reminder_flag(status: str, comments: str) -> str:
    return (
        f"CASE WHEN {status} = '{c.ESCALATION_SENT_STATUS}' OR ({status} = '{c.RESPONSE_RECEIVED_STATUS}' "
        f"AND contains({comments}, '{c.ESCALATION_TEXT}')) THEN '{c.FLAG_YES}' END"
    )


def out_of_window(followup: str, trigger: str) -> str:
    """Follow-up before the trigger or more than the window after it; a null on either side is not."""
    limit = f"{trigger} + INTERVAL '{c.FOLLOW_UP_WINDOW_SECONDS}' SECOND"
    return f"coalesce({followup} < {trigger} OR {followup} > {limit}, false)"


def response_note(followup: str, response_at: str, actions: str) -> str:
    return (
        f"CASE WHEN {followup} IS NULL THEN '{c.NOTE_NOT_SENT}' "
        f"WHEN {response_at} IS NULL THEN '{c.NOTE_AWAITING}' "
        f"WHEN contains(upper({actions}), '{c.UPDATED_ACTION_TEXT}') THEN '{c.NOTE_PROCESSED}' "
        f"ELSE '{c.NOTE_NOT_PROCESSED}' END"
    )
