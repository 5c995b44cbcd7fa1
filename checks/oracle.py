"""The same results in DuckDB SQL, written the plain way: full joins, windows, one step after another."""

from __future__ import annotations

from checks import inputs as i
from loadtrail import constants as c
from loadtrail.params import ReportParams

ORDER_FIRST = "trigger_timestamp NULLS FIRST, followup_sent_at NULLS FIRST"
TRIGGER_ORDER = f"{ORDER_FIRST}, reminder NULLS FIRST, escalated NULLS FIRST, trigger_message NULLS FIRST"
ROW_ORDER = (
    f"{ORDER_FIRST}, response_timestamp NULLS FIRST, reminder NULLS FIRST, escalated NULLS FIRST, "
    "response_message NULLS FIRST, trigger_message NULLS FIRST, workflow_exec_id NULLS FIRST, "
    "status NULLS FIRST, actions NULLS FIRST"
)


def _alert(x: str) -> str:
    line = f"regexp_extract({x}, '{c.ALERT_LABEL}([^' || chr(10) || ']*)', 1)"
    return f"CASE WHEN contains({x}, '{c.ALERT_LABEL}') THEN trim({line}) ELSE {x} END"


def _without_prefix(x: str) -> str:
    no_prefix = rf"regexp_replace({x}, 'Load #\d+:?\s*', '', 'g')"
    return rf"regexp_replace({no_prefix}, '[\\r\\n)]+(' || chr(10) || '?)$', '\1', 'g')"


def _number(x: str) -> str:
    return rf"CASE WHEN regexp_matches({x}, '^\s*[+-]?[0-9]+\s*$') THEN try_cast(replace(trim({x}), '+', '') AS BIGINT) END"


def _delay(earlier: str, later: str) -> str:
    return f"date_diff('microsecond', {earlier}, {later}) / 1000000.0::DOUBLE / 60.0::DOUBLE"


def _label(d: str) -> str:
    return (
        f"CAST(day({d}) AS VARCHAR) || CASE WHEN day({d}) IN (11, 12, 13) THEN 'th' "
        f"WHEN day({d}) % 10 = 1 THEN 'st' WHEN day({d}) % 10 = 2 THEN 'nd' "
        f"WHEN day({d}) % 10 = 3 THEN 'rd' ELSE 'th' END || upper(strftime({d}, '%b'))"
    )


def _in_range(p: ReportParams, ts: str) -> str:
    return f"({ts} >= TIMESTAMP '{p.start} 00:00:00' AND {ts} < TIMESTAMP '{p.day_after_end} 00:00:00')"


def _note(followup: str, response: str, actions: str) -> str:
    return (
        f"CASE WHEN {followup} IS NULL THEN '{c.NOTE_NOT_SENT}' WHEN {response} IS NULL THEN '{c.NOTE_AWAITING}' "
        f"WHEN contains(upper({actions}), '_UPDATED') THEN '{c.NOTE_PROCESSED}' ELSE '{c.NOTE_NOT_PROCESSED}' END"
    )


def _steps(p: ReportParams) -> list[tuple[str, str]]:
    """Named steps from the raw tables to the reports, in order; later ones use earlier ones."""
    base = f"entity_type IN ('Load', 'Shipment') AND shipper_id = '{p.shipper_id}'"
    action = f"AND action = '{p.trigger_action}'" if p.trigger_action else ""
    rtp = p.trigger_action is not None
    message = "CASE WHEN comment LIKE '%" + c.ALERT_LABEL + " %' THEN comment END"
    keys = "f.load_id IS NOT DISTINCT FROM t.load_id" + ("" if rtp else " AND f.shipper_id IS NOT DISTINCT FROM t.shipper_id")
    missed = "coalesce(followup_sent_at < trigger_timestamp OR followup_sent_at > trigger_timestamp + INTERVAL 120 SECOND, false)"
    data_columns = ", ".join(
        f"max(CASE WHEN col_idx = {n} THEN cell_value END) AS \"{name}\"" for n, name in enumerate(c.SHEET_COLUMNS)
    )
    return [
        ("audit", i.AUDIT_LOG_SQL),
        ("milestone", i.MILESTONES_SQL),
        ("payload", i.CARRIER_PAYLOAD_SQL),
        ("sheet", i.SHEET_SQL),
        ("line", i.ORDER_LINE_SQL),
        (
            "cells",
            f"""SELECT file_name, CAST(r AS INT) AS row_idx, CAST(k AS INT) AS col_idx, v AS cell_value FROM (
              SELECT file_name, unnest([0, d % 3, d % 3, d % 3 + 1, d % 3 + 1, d % 3 + 3, d % 3 + 4, d % 3 + 4, 2000000000]) AS r,
                unnest([0, d % 2 + 1, d % 2 + 2, 1, 2, 0, 0, 1, 0]) AS k,
                unnest(['Holdover report', '{c.PLANT_LABEL}', 'Plant ' || CAST(d AS VARCHAR), '{c.PLANT_LABEL}',
                        'elsewhere', '77', '{c.HEADER_LABEL}', 'CARRIER', '{c.HEADER_LABEL}']) AS v
              FROM sheet
              UNION ALL
              SELECT file_name, row_idx, unnest(range(14)),
                unnest([first_cell, customer, order_status, order_priority]
                       || list_transform(range(4, 14), lambda n: 'v' || CAST(n AS VARCHAR) || ' ' || order_status))
              FROM line)""",
        ),
        ("mail", i.MAIL_SQL),
        ("active", f"SELECT DISTINCT request_id FROM audit WHERE {_in_range(p, 'created_at')} AND request_id IS NOT NULL"),
        ("shipper_rows", f"SELECT * FROM audit WHERE {base} AND request_id IN (SELECT request_id FROM active)"),
        ("trigger_log", f"SELECT * FROM shipper_rows WHERE workflow_identifier = '{p.workflow}' {action}"),
        (
            "triggers",
            f"""SELECT entity_id AS load_id, request_id || '-' || entity_id AS workflow_exec_id, shipper_id,
              workflow_identifier AS workflow, {message} AS trigger_message,
              created_at AS trigger_timestamp FROM trigger_log""",
        ),
        (
            "response_group",
            f"""SELECT request_id, entity_id,
              max(comment) FILTER (comment LIKE '{c.RAW_MESSAGE_LIKE}') AS response_message,
              min(created_at) FILTER (action = '{c.DETAILS_EXTRACTED_ACTION}') AS response_timestamp,
              min(created_at) FILTER (action LIKE '{c.UPDATED_ACTION_LIKE}') AS response_updated_timestamp,
              string_agg(DISTINCT action, '; ' ORDER BY action) AS actions
            FROM shipper_rows WHERE workflow_identifier = '{c.RESPONSE_WORKFLOW}' GROUP BY request_id, entity_id""",
        ),
        (
            "correlated",
            f"""SELECT t.*, CASE WHEN g.response_message IS NULL THEN '{c.AWAITING_STATUS}'
                WHEN g.response_updated_timestamp IS NULL THEN '{c.FAILED_STATUS}' ELSE '{c.SUCCESS_STATUS}' END AS status,
              g.response_message, g.response_timestamp, g.actions
            FROM triggers t LEFT JOIN response_group g
              ON g.entity_id = t.load_id AND t.trigger_timestamp < g.response_timestamp""",
        ),
        (
            "followup",
            f"""SELECT entity_id AS load_id, shipper_id, date_trunc('second', created_at) AS followup_sent_at,
              CASE WHEN status = '{c.ESCALATION_SENT_STATUS}' OR status = '{c.RESPONSE_RECEIVED_STATUS}'
                AND contains(comments, '{c.ESCALATION_TEXT}') THEN 'Y' END AS reminder,
              CASE WHEN status = '{c.ESCALATION_SENT_STATUS}' THEN 'Y' END AS escalated
            FROM milestone WHERE entity_type = 'Load' AND {_in_range(p, 'created_at')}
              AND workflow_id = '{p.workflow}' AND shipper_id = '{p.shipper_id}'""",
        ),
        (
            "merged",
            f"""SELECT *, {missed} AS missed
            FROM (SELECT t.* REPLACE ({_alert('t.trigger_message') if rtp else 't.trigger_message'} AS trigger_message),
                    f.followup_sent_at, f.reminder, f.escalated
                  FROM correlated t LEFT JOIN followup f ON {keys})""",
        ),
        (
            "fallback",
            f"""SELECT *, bool_and(missed) OVER (PARTITION BY workflow_exec_id) AS all_missed,
              row_number() OVER (PARTITION BY workflow_exec_id ORDER BY {TRIGGER_ORDER}) AS rn FROM merged""",
        ),
        (
            "classified",
            f"""SELECT DISTINCT load_id, workflow_exec_id, shipper_id, workflow,
              CASE WHEN skip THEN '{c.TRIGGER_SKIPPED_STATUS}' ELSE status END AS status, trigger_message,
              CASE WHEN NOT skip THEN response_message END AS response_message, trigger_timestamp,
              CASE WHEN NOT skip THEN response_timestamp END AS response_timestamp,
              CASE WHEN skip THEN '{c.DETAILS_EXTRACTED_ACTION}' ELSE actions END AS actions,
              followup_sent_at, reminder, escalated
            FROM (SELECT *, missed OR followup_sent_at IS NULL AS skip FROM fallback
                  WHERE NOT missed OR (all_missed AND rn = 1))""",
        ),
        (
            "not_skipped",
            f"""SELECT * EXCLUDE (all_skipped, rn) FROM (
              SELECT *, bool_and(status = '{c.TRIGGER_SKIPPED_STATUS}') OVER (PARTITION BY workflow_exec_id) AS all_skipped,
                row_number() OVER (PARTITION BY workflow_exec_id, status = '{c.TRIGGER_SKIPPED_STATUS}' ORDER BY {ROW_ORDER}) AS rn
              FROM classified)
            WHERE status <> '{c.TRIGGER_SKIPPED_STATUS}' OR (all_skipped AND rn = 1)""",
        ),
        (
            "load_first",
            f"""SELECT * EXCLUDE (rn) FROM (
              SELECT *, row_number() OVER (PARTITION BY load_number ORDER BY {ROW_ORDER}) AS rn
              FROM (SELECT *, {_number('load_id')} AS load_number FROM not_skipped) WHERE load_number IS NOT NULL)
            WHERE rn = 1""",
        ),
        (
            "entry",
            f"""SELECT {_number("load.loadNumber")} AS load_number, coalesce(load.carrier.name, '') AS carrier_name,
              coalesce(load.carrier.id, '') AS scac, arrival_order, position
            FROM (SELECT arrival_order, unnest(loads) AS load, unnest(range(len(loads))) AS position
                  FROM (SELECT arrival_order, from_json(body,
                    '{{"loads":[{{"loadNumber":"VARCHAR","carrier":{{"name":"VARCHAR","id":"VARCHAR"}}}}]}}').loads AS loads
                  FROM payload))""",
        ),
        (
            "carrier",
            """SELECT load_number, carrier_name, scac FROM entry WHERE load_number IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY load_number ORDER BY arrival_order DESC, position DESC) = 1""",
        ),
        (
            "plant",
            f"""SELECT a.file_name, b.cell_value AS "FACILITY" FROM (
              SELECT * FROM cells WHERE cell_value = '{c.PLANT_LABEL}'
              QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY row_idx, col_idx) = 1) a
            JOIN cells b ON b.file_name = a.file_name AND b.row_idx = a.row_idx AND b.col_idx = a.col_idx + 1""",
        ),
        ("header", f"SELECT file_name, min(row_idx) AS h FROM cells WHERE cell_value = '{c.HEADER_LABEL}' GROUP BY 1"),
        (
            "grid",
            f"""SELECT c.file_name, c.row_idx, {data_columns}
            FROM cells c JOIN header USING (file_name) WHERE c.row_idx > h GROUP BY 1, 2""",
        ),
        (
            "sheet_row",
            f"""SELECT * REPLACE ({_number('"Load Number"')} AS "Load Number") FROM grid
            WHERE {_number('"Load Number"')} IS NOT NULL""",
        ),
        (
            "attachment",
            f"""SELECT message_id, internal_date, attachment_name AS file_name,
              CASE WHEN role = 'user' THEN subject ELSE '{c.NO_SUBJECT}' END AS subject,
              strftime(epoch_ms(internal_date), '%d:%m:%Y') AS received_date,
              replace('{p.shipper_id}', '-', '_') AS shipper_key, turn_text AS content
            FROM mail WHERE attachment_id IS NOT NULL AND {_in_range(p, 'epoch_ms(internal_date)')}
              AND (lower(subject || ' ' || turn_text) LIKE '%holdover%' OR lower(subject || ' ' || turn_text) LIKE '%hold over%')""",
        ),
        ("received", 'SELECT file_name, arg_max(received_date, (internal_date, message_id)) AS "DATE" FROM attachment GROUP BY 1'),
        (
            "holdover",
            """SELECT sheet_row.* EXCLUDE (file_name, row_idx), "FACILITY", "DATE"
            FROM sheet_row LEFT JOIN plant USING (file_name) LEFT JOIN received USING (file_name)""",
        ),
        (
            "notifier_out",
            f"""SELECT workflow AS "Workflow", workflow_exec_id || '-' || load_id AS "Workflow Execution Id",
              shipper_id AS "Shipper", coalesce(carrier.carrier_name, '') AS carrier_name,
              coalesce(carrier.scac, '') AS "Carrier SCAC", load_id AS "Load Number",
              {_without_prefix('(' + _alert('trigger_message') + ')')} AS "Trigger Message",
              response_message AS "Response Message", trigger_timestamp AS "Triggered At",
              followup_sent_at AS "Followup Sent At", response_timestamp AS "Response At",
              {_delay('followup_sent_at', 'response_timestamp')} AS "Response Delay (mins)",
              actions AS "Update Actions", status AS "Status", reminder AS "Reminder", escalated AS "Escalated"
            FROM classified LEFT JOIN carrier ON carrier.load_number = {_number('load_id')}""",
        ),
    ]


def _query(select: str, last_step: str, p: ReportParams, only: tuple[str, ...] = ()) -> str:
    """The steps up to `last_step`, or `only` some of them, as a WITH clause in front of `select`."""
    parts = []
    for name, sql in _steps(p):
        if not only or name in only:
            parts.append(f"{name} AS ({sql.strip()})")
        if name == last_step:
            break
    return "WITH " + ",\n".join(parts) + "\n" + select


def oracle_sql() -> dict[str, str]:
    n, r = i.NOTIFIER, i.READY_TO_PICKUP
    triggers = "load_id, workflow_exec_id, shipper_id, workflow, trigger_message, trigger_timestamp"
    missed = "coalesce(f.followup_sent_at < t.trigger_timestamp OR f.followup_sent_at > t.trigger_timestamp + INTERVAL 120 SECOND, false)"
    same = "f.load_id IS NOT DISTINCT FROM t.load_id AND f.shipper_id IS NOT DISTINCT FROM t.shipper_id"
    first_followup = """(SELECT DISTINCT ON (load_id, shipper_id) * FROM followup
        ORDER BY load_id, shipper_id, followup_sent_at, reminder NULLS FIRST, escalated NULLS FIRST)"""
    rtp_columns = ", ".join(
        f'"{name}"' if name in (c.FACILITY_COLUMN, c.RECEIVED_COLUMN, *c.SHEET_COLUMNS) else name for name in (
            c.FACILITY_COLUMN, c.RECEIVED_COLUMN, *[s for s in c.SHEET_COLUMNS if s != "NOTES/COMMENTS"])
    )
    joined = 'holdover LEFT JOIN load_first l ON l.load_number = holdover."Load Number"'
    report_set = """SELECT 'carriers' AS table_name, CAST(load_number AS VARCHAR) AS entry, carrier_name AS detail FROM carrier
        UNION ALL SELECT 'master data', request_id || '/' || coalesce(entity_id, ''), actions FROM response_group"""
    result = {
        "request_window_semi": _query("SELECT request_id, entity_id, action, created_at FROM trigger_log", "trigger_log", n),
        "response_rollup": _query("SELECT * FROM response_group", "response_group", n),
        "hot_load_grid": _query(
            f"""SELECT load_id, a AS left_splits, b AS right_splits, latest_response FROM (
              SELECT *, greatest(1, least(responses, greatest(ceil(responses / {n.rows_per_split}.0::DOUBLE),
                  ceil(cells / a))))::BIGINT AS b
              FROM (SELECT *, greatest(1, least(triggers, greatest(ceil(triggers / {n.rows_per_split}.0::DOUBLE),
                  ceil(sqrt(cells * triggers / greatest(responses, 1))))))::BIGINT AS a
                FROM (SELECT *, greatest(1.0::DOUBLE, triggers::DOUBLE * responses / {n.pairs_per_split}) AS cells
                  FROM (SELECT load_id, coalesce(triggers, 0) AS triggers, coalesce(responses, 0) AS responses, latest_response
                    FROM (SELECT load_id, count(*) AS triggers FROM triggers GROUP BY 1)
                    FULL JOIN (SELECT entity_id AS load_id, count(response_timestamp) AS responses,
                      max(response_timestamp) AS latest_response FROM response_group GROUP BY 1) USING (load_id)
                    WHERE load_id IS NOT NULL))))
            WHERE a > 1 OR b > 1""",
            "response_group",
            n,
        ),
        "trigger_response_correlate_notifier": _query("SELECT * FROM correlated", "correlated", n),
        "trigger_response_correlate_rtp": _query("SELECT * FROM correlated", "correlated", r),
        "milestone_flags": _query("SELECT * FROM followup", "followup", n),
        "milestone_join_nullsafe": _query(
            f"""SELECT t.*, f.followup_sent_at, f.reminder, f.escalated
            FROM (SELECT DISTINCT * FROM triggers) t LEFT JOIN {first_followup} f ON {same}""",
            "followup",
            n,
        ),
        "followup_window": _query(
            f"""SELECT {triggers}, followup_sent_at, reminder, escalated, out_of_window,
              CASE WHEN out_of_window OR followup_sent_at IS NULL THEN '{c.TRIGGER_SKIPPED_STATUS}' END AS status,
              CASE WHEN out_of_window OR followup_sent_at IS NULL THEN '{c.DETAILS_EXTRACTED_ACTION}' END AS actions
            FROM (
              SELECT DISTINCT t.*, f.followup_sent_at, f.reminder, f.escalated, false AS out_of_window
              FROM triggers t JOIN followup f ON {same} AND NOT {missed}
              UNION ALL
              SELECT DISTINCT t.*, f.followup_sent_at, f.reminder, f.escalated, f.followup_sent_at IS NOT NULL
              FROM triggers t LEFT JOIN {first_followup} f ON {same}
              WHERE NOT EXISTS (SELECT 1 FROM followup f WHERE {same} AND NOT {missed}))""",
            "followup",
            n,
        ),
        "keep_first_fallback": _query(
            f"SELECT DISTINCT {triggers}, followup_sent_at, reminder, escalated, status = '{c.TRIGGER_SKIPPED_STATUS}' AS skipped FROM classified",
            "classified",
            n,
        ),
        "classified_notifier": _query("SELECT * FROM classified", "classified", n),
        "classified_rtp": _query("SELECT * FROM classified", "classified", r),
        "keep_first_by_status": _query("SELECT * FROM not_skipped", "not_skipped", r),
        "first_row_per_load": _query("SELECT * FROM load_first", "load_first", r),
        "load_summary": _query("SELECT * FROM load_first", "load_first", r),
        "carrier_payload_last_wins": _query("SELECT * FROM carrier", "carrier", n),
        "carrier_lookup": _query(
            f"""SELECT load_key, coalesce(carrier_name, '') AS carrier_name, coalesce(scac, '') AS scac
            FROM (SELECT DISTINCT load_id AS load_key FROM triggers) k LEFT JOIN carrier ON load_number = {_number('load_key')}""",
            "carrier",
            n,
        ),
        "lookup_batches": _query(
            """SELECT CAST(0 AS BIGINT) AS bucket, batch, string_agg(load_key, ',' ORDER BY load_key) AS load_ids, count(*) AS loads
            FROM (SELECT load_key, (row_number() OVER (ORDER BY load_key) - 1) // 10 AS batch
                  FROM (SELECT DISTINCT load_id AS load_key FROM triggers WHERE load_id IS NOT NULL)) GROUP BY batch""",
            "triggers",
            n,
        ),
        "alert_text": _query(
            f"""SELECT request_id, created_at, comment, {_alert('comment')} AS alert,
              {_without_prefix('(' + _alert('comment') + ')')} AS cleaned FROM audit""",
            "audit",
            n,
        ),
        "response_delay": """SELECT event_id, try_cast(sent AS TIMESTAMP) AS followup_sent_at, ts AS response_timestamp, """
        + _delay("try_cast(sent AS TIMESTAMP)", "ts")
        + """ AS response_delay FROM (SELECT event_id, ts, CASE WHEN value < 5 THEN 'n/a' WHEN value < 10 THEN NULL
              ELSE CAST(date_trunc('day', ts) AS VARCHAR) END AS sent FROM events)""",
        "response_note": _query(
            f"""SELECT DISTINCT workflow_exec_id, followup_sent_at, response_timestamp, actions,
              {_note('followup_sent_at', 'response_timestamp', 'actions')} AS note FROM classified""",
            "classified",
            r,
        ),
        "sheet_anchor_facility": _query("SELECT * FROM plant", "plant", r, only=("sheet", "line", "cells", "plant")),
        "sheet_normalise": _query("SELECT * FROM sheet_row", "sheet_row", r),
        "mail_attachments": _query("SELECT * FROM attachment", "attachment", r),
        "holdover_list": _query("SELECT * FROM holdover", "holdover", r),
        "holdover_left_join": _query(
            f"""SELECT holdover.*, l.workflow_exec_id, l.trigger_timestamp, l.status FROM {joined}""", "holdover", r
        ),
        "notifier_report": _query("SELECT * FROM notifier_out", "notifier_out", n),
        "rtp_report": _query(
            f"""SELECT {rtp_columns}, {_note('followup_sent_at', 'response_timestamp', 'actions')} AS "NOTES/COMMENTS",
              workflow AS "Workflow", workflow_exec_id AS "Workflow Execution Id", shipper_id AS "Shipper",
              coalesce(carrier.carrier_name, '') AS carrier_name, coalesce(carrier.scac, '') AS "Carrier SCAC",
              trigger_message AS "Trigger Message", response_message AS "Response Message",
              trigger_timestamp AS "Triggered At", followup_sent_at AS "Followup Sent At",
              response_timestamp AS "Response At", {_delay('followup_sent_at', 'response_timestamp')} AS "Response Delay (mins)",
              actions AS "Update Actions", status AS "Status", reminder AS "Reminder", escalated AS "Escalated"
            FROM {joined} LEFT JOIN carrier ON carrier.load_number = holdover."Load Number" """,
            "holdover",
            r,
        ),
        "report_label": "SELECT CAST(o_orderdate AS DATE) AS order_day, " + _label("o_orderdate")
        + " AS label, count(*) AS orders FROM orders GROUP BY 1, 2",
        "csv_roundtrip": _query(
            """SELECT "Workflow", "Workflow Execution Id", "Shipper", nullif(carrier_name, '') AS carrier_name,
              nullif("Carrier SCAC", '') AS "Carrier SCAC", "Load Number", nullif("Trigger Message", '') AS "Trigger Message",
              "Response Message", "Triggered At", "Followup Sent At", "Response At", "Response Delay (mins)",
              "Update Actions", "Status", "Reminder", "Escalated" FROM notifier_out""",
            "notifier_out",
            n,
        ),
        "publish_replace": _query(report_set, "carrier", n),
    }
    return result
