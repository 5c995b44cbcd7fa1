"""Row-by-row restatement of the rules, for comparison on small inputs."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from loadtrail.constants import ALERT_LABEL
from loadtrail.params import ReportParams

SKIP = "TRIGGER_SKIPPED"


def nulls_first(row: dict, names) -> tuple:
    return tuple((row[name] is not None, row[name] if row[name] is not None else 0) for name in names)


def within(params: ReportParams, ts) -> bool:
    return ts is not None and params.start <= ts.date() <= params.end


def correlate(log: list[dict], params: ReportParams) -> list[dict]:
    active = {r["request_id"] for r in log if within(params, r["created_at"]) and r["request_id"] is not None}
    mine = [
        r
        for r in log
        if r["entity_type"] in ("Load", "Shipment") and r["shipper_id"] == params.shipper_id and r["request_id"] in active
    ]
    groups: dict = {}
    for r in mine:
        if r["workflow_identifier"] == "shipment_update":
            groups.setdefault((r["request_id"], r["entity_id"]), []).append(r)
    responses = []
    for (_, load), rows in groups.items():
        raw = [r["comment"] for r in rows if r["comment"] and "Raw message" in r["comment"]]
        details = [r["created_at"] for r in rows if r["action"] == "DETAILS_EXTRACTED"]
        updated = [r["created_at"] for r in rows if r["action"] and r["action"].find("UPDATED") > 0]
        message = max(raw) if raw else None
        status = "AWAITING_RESPONSE" if message is None else "SUCCESS" if updated else "SKIPPED/INVALID_RESPONSE/FAILED"
        responses.append(
            {
                "load": load,
                "status": status,
                "response_message": message,
                "response_timestamp": min(details) if details else None,
                "actions": "; ".join(sorted({r["action"] for r in rows if r["action"] is not None})) or None,
            }
        )
    none = {"status": "AWAITING_RESPONSE", "response_message": None, "response_timestamp": None, "actions": None}
    result = []
    for r in mine:
        if r["workflow_identifier"] != params.workflow or params.trigger_action not in (None, r["action"]):
            continue
        comment = r["comment"]
        trigger = {
            "load_id": r["entity_id"],
            "workflow_exec_id": None if r["entity_id"] is None else f"{r['request_id']}-{r['entity_id']}",
            "shipper_id": r["shipper_id"],
            "workflow": r["workflow_identifier"],
            "trigger_message": comment if comment and f"{ALERT_LABEL} " in comment else None,
            "trigger_timestamp": r["created_at"],
        }
        later = [
            g
            for g in responses
            if r["entity_id"] is not None
            and g["load"] == r["entity_id"]
            and g["response_timestamp"] is not None
            and r["created_at"] < g["response_timestamp"]
        ]
        for g in later or [none]:
            result.append({**trigger, **{name: g[name] for name in none}})
    return result


def flags(milestones: list[dict], params: ReportParams) -> list[dict]:
    result = []
    for m in milestones:
        if m["entity_type"] != "Load" or not within(params, m["created_at"]):
            continue
        if m["workflow_id"] != params.workflow or m["shipper_id"] != params.shipper_id:
            continue
        sent = m["status"] == "escalation_l2_sent"
        seen = m["status"] == "response_received" and "Escalation triggered" in (m["comments"] or "")
        result.append(
            {
                "load_id": m["entity_id"],
                "followup_sent_at": m["created_at"].replace(microsecond=0),
                "reminder": "Y" if sent or seen else None,
                "escalated": "Y" if sent else None,
            }
        )
    return result


def classify(correlated: list[dict], follow_ups: list[dict]) -> list[dict]:
    order = ("trigger_timestamp", "followup_sent_at", "reminder", "escalated", "trigger_message", "load_id")
    missing = {"followup_sent_at": None, "reminder": None, "escalated": None}
    executions: dict = {}
    for row in correlated:
        for m in [m for m in follow_ups if m["load_id"] == row["load_id"]] or [missing]:
            merged = {**row, **{name: m[name] for name in missing}}
            sent = merged["followup_sent_at"]
            gap = None if sent is None else (sent - row["trigger_timestamp"]).total_seconds()
            late = gap is not None and not 0 <= gap <= 120
            if late or sent is None:
                merged.update(status=SKIP, response_message=None, response_timestamp=None, actions="DETAILS_EXTRACTED")
            executions.setdefault(row["workflow_exec_id"], []).append((late, merged))
    kept = []
    for rows in executions.values():
        good = [row for late, row in rows if not late]
        kept += good or [min((row for _, row in rows), key=lambda row: nulls_first(row, order))]
    return distinct(kept)


def distinct(rows: list[dict]) -> list[dict]:
    return list({tuple(sorted(row.items(), key=lambda item: item[0])): row for row in rows}.values())


ROW_ORDER = (
    "trigger_timestamp followup_sent_at response_timestamp reminder escalated response_message "
    "trigger_message workflow_exec_id status actions load_id"
).split()


def without_skipped(rows: list[dict]) -> list[dict]:
    executions: dict = {}
    for row in rows:
        executions.setdefault(row["workflow_exec_id"], []).append(row)
    kept = []
    for group in executions.values():
        good = [row for row in group if row["status"] != SKIP]
        kept += good or [min(group, key=lambda row: nulls_first(row, ROW_ORDER))]
    return kept


def first_of_loads(rows: list[dict]) -> list[dict]:
    loads: dict = {}
    for row in rows:
        text = row["load_id"]
        if text is not None and text.strip().lstrip("+-").isdigit():
            loads.setdefault(int(text), []).append(row)
    return [{**min(group, key=lambda row: nulls_first(row, ROW_ORDER)), "load_number": n} for n, group in loads.items()]


def random_inputs(seed: int, rows: int, loads: list, hot_share: float = 0.0) -> tuple[list[dict], list[dict]]:
    """A dense log with ties, straddling requests and missing ids; `loads[0]` may be hot."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 9, 23, 50)

    def moment():
        return start + timedelta(seconds=rng.randrange(0, 3000), microseconds=rng.choice([0, 0, 250000, 1]))

    def load():
        return loads[0] if rng.random() < hot_share else rng.choice(loads)

    log = []
    for n in range(rows):
        workflow = rng.choice(["notifier", "ready_to_pickup", "shipment_update", "shipment_update"])
        actions = ["DETAILS_EXTRACTED", "DETAILS_EXTRACTED", "ETA_UPDATED", "UPDATED", "xUPDATED", None]
        log.append(
            {
                "entity_id": load(),
                "request_id": rng.choice([None, "r", "r-1", *[f"r{k}" for k in range(max(rows // 10, 2))]]),
                "entity_type": rng.choice(["Load", "Load", "Shipment", "Order"]),
                "shipper_id": rng.choice(["a", "a", "a", "b"]),
                "workflow_identifier": workflow,
                "action": rng.choice(actions) if workflow == "shipment_update" else "FETCHED_CARRIER_SCAC",
                "comment": rng.choice([None, f"Raw message {n}", f"{ALERT_LABEL} late", f"{ALERT_LABEL} {n % 4}"]),
                "created_at": moment(),
            }
        )
    milestones = []
    for _ in range(rows // 2):
        near = rng.choice(log)
        milestones.append(
            {
                "entity_id": near["entity_id"],
                "shipper_id": rng.choice(["a", "a", "b"]),
                "status": rng.choice(["response_received", "escalation_l2_sent", "followup_sent"]),
                "comments": rng.choice([None, "ok", "x Escalation triggered y"]),
                "created_at": near["created_at"] + timedelta(seconds=rng.randrange(-20, 140)),
                "entity_type": rng.choice(["Load", "Load", "Shipment"]),
                "workflow_id": rng.choice(["notifier", "ready_to_pickup"]),
            }
        )
    return log, milestones
