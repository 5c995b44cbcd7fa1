"""Ready-to-pickup report: the holdover list with the first relevant row of each load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail import constants as c
from loadtrail.functions.sql import name
from loadtrail.functions.status import response_note
from loadtrail.functions.text import alert_text, load_number
from loadtrail.functions.timestamps import minutes_between
from loadtrail.operators.carriers import CARRIER_COLUMNS
from loadtrail.operators.correlation import (
    attach_earliest_response,
    hot_loads,
    response_groups,
    responses_of_loads,
    trigger_rows,
)
from loadtrail.operators.followups import blank_skipped, follow_up_candidates, milestone_flags
from loadtrail.operators.keepfirst import first_per_key, keep_first_fallback
from loadtrail.params import ReportParams
from loadtrail.plans.classify import ROW_ORDER, TRIGGER_ORDER, classify, complete
from loadtrail.plans.formatting import report_columns
from loadtrail.sinks.landing import landed, sorted_by_ranges

FOLLOW_UP_KEYS = ("load_id",)
SORT_KEY = ("Triggered At", "Load Number")
ROWS_PER_PART = 1_000_000


def rtp_triggers(log: DataFrame, params: ReportParams) -> DataFrame:
    return trigger_rows(log, params).withColumn("trigger_message", F.expr(alert_text("trigger_message")))


def rtp_classified(log: DataFrame, milestones: DataFrame, params: ReportParams) -> DataFrame:
    return classify(rtp_triggers(log, params), milestone_flags(milestones, params), FOLLOW_UP_KEYS, params.hot_loads)


def rtp_rows(log: DataFrame, milestones: DataFrame, params: ReportParams) -> DataFrame:
    """Classified rows with all their responses."""
    return complete(rtp_classified(log, milestones, params), log, params)


def rtp_notes(log: DataFrame, milestones: DataFrame, params: ReportParams) -> DataFrame:
    """The distinct executions, follow-ups, response times and actions of `rtp_rows`, with their note.

    Both sides are made distinct before they are joined, so that the pairs are distinct as they come and need no
    shuffle. Of the triggers of an execution and follow-up, the first meets all responses that any of them meets; the
    last tells whether one of them stays without. Only an execution id that several loads share may have equal pairs.
    """
    keys = ["workflow_exec_id", "load_id", "followup_sent_at", "skipped"]
    classified = rtp_classified(log, milestones, params)
    spans = classified.groupBy(*keys).agg(
        F.expr("min(trigger_timestamp) AS trigger_timestamp"), F.expr("max(trigger_timestamp) AS last_trigger")
    )
    of_loads = spans.select("workflow_exec_id", "load_id").distinct().groupBy("workflow_exec_id").count()
    shared = of_loads.where("count > 1").select("workflow_exec_id")
    latest = (
        responses_of_loads(response_groups(log, params))
        .groupBy("load_id")
        .agg(F.expr("max(response_timestamp) AS latest_of_load"))
    )
    columns = ("followup_sent_at", "response_timestamp", "actions")

    def noted(spans: DataFrame) -> DataFrame:
        pairs = complete(spans, log, params, blank=["status", "response_message"])
        answered_first = "NOT skipped AND trigger_timestamp < latest_of_load AND last_trigger >= latest_of_load"
        unanswered = spans.join(latest, "load_id").where(answered_first)
        nothing = ["CAST(NULL AS TIMESTAMP_NTZ) AS response_timestamp", "CAST(NULL AS STRING) AS actions"]
        return pairs.select("workflow_exec_id", *columns).unionByName(
            unanswered.selectExpr("workflow_exec_id", "followup_sent_at", *nothing)
        )

    rows = noted(spans.join(shared, "workflow_exec_id", "left_anti")).union(
        noted(spans.join(shared, "workflow_exec_id", "left_semi")).distinct()
    )
    return rows.selectExpr("*", f"{response_note(*columns)} AS note")


def without_skipped(rows: DataFrame) -> DataFrame:
    """Drop skipped rows, but keep the first row of an execution that has no other.

    Takes complete rows, or classified ones whose responses come later: skipped rows have none either way.
    """
    flag = "skipped" if "skipped" in rows.columns else f"status = '{c.TRIGGER_SKIPPED_STATUS}'"
    order = [column for column in ROW_ORDER if column in rows.columns]
    flagged = rows.selectExpr("*", f"{flag} AS is_skipped")
    return keep_first_fallback(flagged, "workflow_exec_id", "is_skipped", order).drop("is_skipped")


def rtp_kept_rows(log: DataFrame, milestones: DataFrame, params: ReportParams) -> DataFrame:
    """`without_skipped(rtp_rows(...))`: the rule needs no response, so it comes before they multiply the rows."""
    return complete(without_skipped(rtp_classified(log, milestones, params)), log, params)


def first_before_responses(rows: DataFrame) -> DataFrame:
    """Of classified rows, those that can be first of their load: the first skipped and the first other one.

    Rows of a load and a trigger time meet the same responses, so the other columns decide between them.
    """
    return first_per_key(rows, ["load_id", "skipped"], [*TRIGGER_ORDER, "workflow_exec_id"])


def rtp_first_rows(log: DataFrame, milestones: DataFrame, params: ReportParams) -> DataFrame:
    """`first_rows_of_loads(without_skipped(rtp_rows(...)))`, with responses for rows that can be first."""
    kept = without_skipped(rtp_classified(log, milestones, params))
    return first_rows_of_loads(complete(first_before_responses(kept), log, params))


def first_rows_of_loads(rows: DataFrame) -> DataFrame:
    """The first row of each load number; rows without a whole number as load id can match nothing."""
    numbered = rows.selectExpr("*", f"{load_number('load_id')} AS load_number").where("load_number IS NOT NULL")
    return first_per_key(numbered, ["load_number"], ROW_ORDER)


def load_summary(log: DataFrame, milestones: DataFrame, params: ReportParams) -> DataFrame:
    """`first_rows_of_loads(without_skipped(rtp_rows(...)))` without building trigger-response pairs.

    Both skip rules together say: an execution shows its triggers with a follow-up in time; lacking
    those, its first trigger without any follow-up; lacking those, its first late one. Within a load,
    the columns known before responses decide which trigger comes first. So the rows shrink to the
    first skipped and the first other row of each load, and only then meet the responses.
    """
    flags = milestone_flags(milestones, params)
    candidates = follow_up_candidates(rtp_triggers(log, params), flags, FOLLOW_UP_KEYS, params.hot_loads)
    ranked = candidates.selectExpr("*", "CASE WHEN out_of_window THEN 2 WHEN skipped THEN 1 ELSE 0 END AS rank")
    order = ["rank", *TRIGGER_ORDER]
    per_execution = first_per_key(ranked.drop("skipped", "out_of_window"), ["workflow_exec_id", "load_id"], order)
    # few rows share an execution id here: as many as there are ways to cut the text into request and load
    place = f"row_number() OVER (PARTITION BY workflow_exec_id ORDER BY {', '.join(order)}, load_id) AS place"
    kept = per_execution.selectExpr("*", place).where("(rank = 0 OR place = 1) AND load_id IS NOT NULL")
    flagged = kept.selectExpr("*", "rank > 0 AS skipped").drop("rank", "place")
    keys = ["load_id", "skipped"]
    per_load = first_before_responses(flagged)
    responses = responses_of_loads(response_groups(log, params))
    attached = attach_earliest_response(per_load, keys, responses, hot_loads(log, params), wanted="NOT skipped")
    return first_rows_of_loads(blank_skipped(attached))


def rtp_rows_of_report(
    log: DataFrame, milestones: DataFrame, carriers: DataFrame, holdover: DataFrame, params: ReportParams
) -> DataFrame:
    """The report's rows, in no order."""
    # both lookups have one row per load; merged, the long holdover list is joined once
    summary = load_summary(log, milestones, params).drop("load_id")
    lookup = summary.join(carriers, "load_number", "full")
    rows = holdover.join(lookup, F.expr("`Load Number` = load_number"), "left")
    carrier, scac = [f"coalesce({column}, '')" for column in CARRIER_COLUMNS]
    changed = {
        "Load Number": "`Load Number`",
        c.CARRIER_COLUMN: carrier,
        "Carrier SCAC": scac,
        c.DELAY_HEADING: minutes_between("followup_sent_at", "response_timestamp"),
        "NOTES/COMMENTS": response_note("followup_sent_at", "response_timestamp", "actions"),
    }
    return report_columns(rows, c.READY_TO_PICKUP_COLUMNS, changed)


def rtp_report(
    log: DataFrame, milestones: DataFrame, carriers: DataFrame, holdover: DataFrame, params: ReportParams
) -> DataFrame:
    """The rows in order, by ranges of the sort key: computed once, landed, then dealt out and sorted in parts."""
    report = landed(rtp_rows_of_report(log, milestones, carriers, holdover, params), "rtp-rows")
    return sorted_by_ranges(report, [name(column) for column in SORT_KEY], ROWS_PER_PART)
