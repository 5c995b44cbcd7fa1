from __future__ import annotations

from collections import Counter
from datetime import datetime

from loadtrail import schemas
from loadtrail.params import ReportParams

NOTIFIER = ReportParams.notifier("a", "2024-01-10", "2024-01-10")
READY = ReportParams.ready_to_pickup("a", "2024-01-10", "2024-01-10")


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2024-01-10 {text}")


def log_row(entity, request, workflow, action, created_at, comment=None, shipper="a", kind="Load"):
    return {
        "entity_id": entity,
        "request_id": request,
        "entity_type": kind,
        "shipper_id": shipper,
        "workflow_identifier": workflow,
        "action": action,
        "comment": comment,
        "created_at": created_at,
    }


def milestone(entity, created_at, status="followup_sent", comments=None, workflow="notifier", kind="Load", shipper="a"):
    return {
        "entity_id": entity,
        "shipper_id": shipper,
        "status": status,
        "comments": comments,
        "created_at": created_at,
        "entity_type": kind,
        "workflow_id": workflow,
    }


def log_frame(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in schemas.AUDIT_LOG.fieldNames()) for r in rows], schemas.AUDIT_LOG)


def milestone_frame(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in schemas.MILESTONES.fieldNames()) for r in rows], schemas.MILESTONES)


def multiset(rows, columns) -> Counter:
    return Counter(tuple(row[name] for name in columns) for row in rows)


def assert_same(frame, expected: list[dict]) -> None:
    columns = sorted(frame.columns)
    if expected:
        assert columns == sorted(expected[0])
    ours, theirs = multiset(frame.collect(), columns), multiset(expected, columns)
    assert ours == theirs, f"only ours {list((ours - theirs))[:3]}, only expected {list((theirs - ours))[:3]}"
