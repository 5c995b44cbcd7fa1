"""The registered queries: every operator and report, run over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import NOTIFIER, READY_TO_PICKUP, Tables
from loadtrail import constants as c
from loadtrail.functions.text import alert_text, without_load_prefix
from loadtrail.functions.timestamps import date_label, minutes_between, parse_timestamp
from loadtrail.operators.carriers import carrier_table, lookup_batches, lookup_keys, with_carrier
from loadtrail.operators.correlation import hot_loads, land_log, response_groups, trigger_rows
from loadtrail.operators.followups import follow_up_candidates, join_first_followup, milestone_flags
from loadtrail.operators.requests import is_trigger, load_rows, rows_of_active_requests
from loadtrail.params import ReportParams
from loadtrail.operators.sheets import attachments, sheet_anchors, sheet_facilities, sheet_rows
from loadtrail.plans.correlate import correlate
from loadtrail.plans.holdover import holdover_list
from loadtrail.plans.notifier import FOLLOW_UP_KEYS, notifier_classified, notifier_report, notifier_rows
from loadtrail.plans.rtp import (
    load_summary,
    rtp_first_rows,
    rtp_kept_rows,
    rtp_notes,
    rtp_report,
    rtp_rows,
)
from loadtrail.sinks.csv import write_report
from loadtrail.sinks.landing import shared_folder
from loadtrail.sinks.report_set import publish_table, read_table, table_names
from loadtrail.sources.tables import read_report_csv

Query = Callable[[SparkSession, str], DataFrame]
# small files, so that the small tables give several
CSV_ROWS = 2_000


def request_window_semi(t: Tables) -> DataFrame:
    rows = load_rows(t.log, NOTIFIER).where(is_trigger(NOTIFIER))
    kept = rows_of_active_requests(t.log, rows, NOTIFIER)
    return kept.select("request_id", "entity_id", "action", "created_at")


def milestone_join_nullsafe(t: Tables) -> DataFrame:
    flags = milestone_flags(t.milestones, NOTIFIER)
    triggers = trigger_rows(t.log, NOTIFIER).distinct()
    joined = join_first_followup(triggers, flags, FOLLOW_UP_KEYS, rows_per_split=NOTIFIER.rows_per_split)
    return joined.select("*", "first_followup.*").drop("first_followup")


def followup_window(t: Tables) -> DataFrame:
    flags = milestone_flags(t.milestones, NOTIFIER)
    rows = follow_up_candidates(trigger_rows(t.log, NOTIFIER).distinct(), flags, FOLLOW_UP_KEYS)
    skipped = "out_of_window OR skipped"
    return rows.selectExpr(
        "*",
        f"CASE WHEN {skipped} THEN '{c.TRIGGER_SKIPPED_STATUS}' END AS status",
        f"CASE WHEN {skipped} THEN '{c.DETAILS_EXTRACTED_ACTION}' END AS actions",
    ).drop("skipped")


def keep_first(t: Tables) -> DataFrame:
    return notifier_classified(t.log, t.milestones, NOTIFIER)


def carriers(t: Tables) -> DataFrame:
    return carrier_table(t.carrier_payload)


def carrier_lookup(t: Tables) -> DataFrame:
    return with_carrier(lookup_keys(trigger_rows(t.log, NOTIFIER), "load_id"), carriers(t), "load_key")


def batches(t: Tables) -> DataFrame:
    return lookup_batches(lookup_keys(trigger_rows(t.log, NOTIFIER), "load_id"))


def alerts(t: Tables) -> DataFrame:
    alert = alert_text("comment")
    cleaned = without_load_prefix(alert)
    return t.log.selectExpr("request_id", "created_at", "comment", f"{alert} AS alert", f"{cleaned} AS cleaned")


def response_delay(t: Tables) -> DataFrame:
    midnight = "date_format(CAST(ts AS DATE), 'yyyy-MM-dd HH:mm:ss')"
    sent = f"CASE WHEN value < 5 THEN 'n/a' WHEN value >= 10 THEN {midnight} END"
    return (
        t.given("events")
        .selectExpr("event_id", f"{parse_timestamp(sent)} AS followup_sent_at", "ts AS response_timestamp")
        .selectExpr("*", f"{minutes_between('followup_sent_at', 'response_timestamp')} AS response_delay")
    )


def notes(t: Tables) -> DataFrame:
    return over_active_rows(t, rtp_notes, READY_TO_PICKUP)


def mail_attachments(t: Tables) -> DataFrame:
    found = attachments(t.mail, READY_TO_PICKUP)
    return found.withColumn("content", F.decode("content", "UTF-8"))


def holdover(t: Tables) -> DataFrame:
    return holdover_list(t.cells, t.mail, READY_TO_PICKUP)


def facilities(t: Tables) -> DataFrame:
    return sheet_facilities(sheet_anchors(t.cells))


def normalised_sheets(t: Tables) -> DataFrame:
    headers = sheet_anchors(t.cells).where("header_row IS NOT NULL").select("file_name", "header_row")
    return sheet_rows(t.cells).join(headers, "file_name").where("row_idx > header_row").drop("header_row")


def correlated(t: Tables, params: ReportParams) -> DataFrame:
    return correlate(*land_log(t.log, params))


def over_active_rows(t: Tables, plan: Callable[..., DataFrame], params: ReportParams, *others: DataFrame) -> DataFrame:
    """A plan that looks at the log several times, over its landed active rows."""
    log, active = land_log(t.log, params)
    return plan(log, t.milestones, *others, active)


def summary(t: Tables) -> DataFrame:
    return over_active_rows(t, load_summary, READY_TO_PICKUP)


def holdover_left_join(t: Tables) -> DataFrame:
    loads = summary(t).select("load_number", "workflow_exec_id", "trigger_timestamp", "status")
    return holdover(t).join(loads, F.expr("`Load Number` = load_number"), "left").drop("load_number")


def notifier(t: Tables) -> DataFrame:
    return over_active_rows(t, notifier_report, NOTIFIER, carriers(t))


def ready_to_pickup(t: Tables) -> DataFrame:
    return over_active_rows(t, rtp_report, READY_TO_PICKUP, carriers(t), holdover(t))


def labels(t: Tables) -> DataFrame:
    days = t.given("orders").selectExpr("CAST(o_orderdate AS DATE) AS order_day")
    return days.groupBy("order_day", F.expr(f"{date_label('order_day')} AS label")).agg(F.expr("count(*) AS orders"))


def csv_roundtrip(t: Tables) -> DataFrame:
    report, path = notifier(t), f"{shared_folder(t.spark)}/notifier.csv"
    # the report has a row per pair, so its texts repeat many times: compressed, they are a fraction of the disk
    write_report(report, path, rows_per_file=CSV_ROWS, compression="gzip")
    return read_report_csv(t.spark, path, report.schema, multi_line=True)


def hot_load_grid(t: Tables) -> DataFrame:
    return hot_loads(t.log, NOTIFIER)


def publish_replace(t: Tables) -> DataFrame:
    report_set = shared_folder(t.spark)
    rows = carriers(t).selectExpr("CAST(load_number AS STRING) AS entry", "carrier_name AS detail")
    publish_table(rows, report_set)
    publish_table(rows, report_set, "carriers")
    entry = "concat(request_id, '/', coalesce(entity_id, ''))"
    groups = response_groups(t.log, NOTIFIER).selectExpr(f"{entry} AS entry", "actions AS detail")
    publish_table(groups, report_set)
    whole = None
    for table in table_names(t.spark, report_set):
        part = read_table(t.spark, report_set, table).select(F.lit(table).alias("table_name"), "*")
        whole = part if whole is None else whole.unionByName(part)
    return whole


_OPERATORS: dict[str, Callable[[Tables], DataFrame]] = {
    "request_window_semi": request_window_semi,
    "response_rollup": lambda t: response_groups(t.log, NOTIFIER),
    "hot_load_grid": hot_load_grid,
    "trigger_response_correlate_notifier": lambda t: correlated(t, NOTIFIER),
    "trigger_response_correlate_rtp": lambda t: correlated(t, READY_TO_PICKUP),
    "milestone_flags": lambda t: milestone_flags(t.milestones, NOTIFIER),
    "milestone_join_nullsafe": milestone_join_nullsafe,
    "followup_window": followup_window,
    "keep_first_fallback": keep_first,
    "classified_notifier": lambda t: over_active_rows(t, notifier_rows, NOTIFIER),
    "classified_rtp": lambda t: over_active_rows(t, rtp_rows, READY_TO_PICKUP),
    "keep_first_by_status": lambda t: over_active_rows(t, rtp_kept_rows, READY_TO_PICKUP),
    "first_row_per_load": lambda t: over_active_rows(t, rtp_first_rows, READY_TO_PICKUP),
    "load_summary": summary,
    "carrier_payload_last_wins": carriers,
    "carrier_lookup": carrier_lookup,
    "lookup_batches": batches,
    "alert_text": alerts,
    "response_delay": response_delay,
    "response_note": notes,
    "sheet_anchor_facility": facilities,
    "sheet_normalise": normalised_sheets,
    "mail_attachments": mail_attachments,
    "holdover_list": holdover,
    "holdover_left_join": holdover_left_join,
    "notifier_report": notifier,
    "rtp_report": ready_to_pickup,
    "report_label": labels,
    "csv_roundtrip": csv_roundtrip,
    "publish_replace": publish_replace,
}


def queries() -> dict[str, Query]:
    def bind(operator: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, folder: operator(Tables(spark, folder))

    return {name: bind(operator) for name, operator in _OPERATORS.items()}
