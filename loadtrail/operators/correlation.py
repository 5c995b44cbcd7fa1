"""Trigger rows, response groups and the join between them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail import constants as c
from loadtrail.functions.sql import names, text
from loadtrail.functions.status import response_status, trigger_text
from loadtrail.functions.text import execution_id
from loadtrail.operators.hotkeys import LEFT, RIGHT, copy_per_split, deal, hot_keys, within_cells
from loadtrail.operators.keepfirst import row_struct
from loadtrail.operators.requests import active_log, is_response, is_trigger, load_rows, rows_of_active_requests
from loadtrail.params import ReportParams
from loadtrail.sinks.landing import landed

RESPONSE_COLUMNS = ("response_message", "response_timestamp", "actions")


def trigger_rows(log: DataFrame, params: ReportParams) -> DataFrame:
    rows = load_rows(log, params).where(is_trigger(params))
    return rows_of_active_requests(log, rows, params).selectExpr(
        "entity_id AS load_id",
        f"{execution_id('request_id', 'entity_id')} AS workflow_exec_id",
        "shipper_id",
        "workflow_identifier AS workflow",
        f"{trigger_text('comment')} AS trigger_message",
        "created_at AS trigger_timestamp",
    )


def response_groups(log: DataFrame, params: ReportParams) -> DataFrame:
    """One row per request and load of the response workflow."""
    rows = load_rows(log, params).where(is_response())
    found = "collect_set(action)"
    listed = f"array_join(array_sort({found}), '{c.ACTION_SEPARATOR}')"
    return (
        rows_of_active_requests(log, rows, params)
        .groupBy("request_id", "entity_id")
        .agg(
            F.expr(f"max(comment) FILTER (WHERE comment LIKE {text(c.RAW_MESSAGE_LIKE)}) AS response_message"),
            F.expr(f"min(created_at) FILTER (WHERE action = '{c.DETAILS_EXTRACTED_ACTION}') AS response_timestamp"),
            F.expr(
                f"min(created_at) FILTER (WHERE action LIKE {text(c.UPDATED_ACTION_LIKE)}) AS response_updated_timestamp"
            ),
            F.expr(f"CASE WHEN size({found}) > 0 THEN {listed} END AS actions"),
        )
    )


def responses_of_loads(groups: DataFrame) -> DataFrame:
    """Response groups that can match a trigger: with a load and with extracted details."""
    return groups.where("entity_id IS NOT NULL AND response_timestamp IS NOT NULL").selectExpr(
        "entity_id AS load_id",
        f"{response_status('response_message', 'response_updated_timestamp')} AS status",
        *RESPONSE_COLUMNS,
    )


def load_weights(log: DataFrame, params: ReportParams) -> DataFrame:
    """Per load, the trigger rows and response groups that enter the join, and the latest group's time.

    The rows are those of active requests, inside and outside the report range, with few of their columns.
    """
    rows = load_rows(log, params).where(f"{is_trigger(params)} OR {is_response()}")
    details = f"{is_response()} AND action = '{c.DETAILS_EXTRACTED_ACTION}'"
    groups = (
        rows_of_active_requests(log, rows, params)
        .groupBy("request_id", "entity_id")
        .agg(
            F.expr(f"count_if({is_trigger(params)}) AS triggers"),
            F.expr(f"min(created_at) FILTER (WHERE {details}) AS response_timestamp"),
        )
    )
    return groups.groupBy(F.expr("entity_id AS load_id")).agg(
        F.expr("sum(triggers) AS triggers"),
        F.expr("count(response_timestamp) AS responses"),
        F.expr("max(response_timestamp) AS latest_response"),
    )


def hot_loads(log: DataFrame, params: ReportParams) -> DataFrame:
    """Loads with too many trigger-response pairs, or simply too many rows, for one task: their grid."""
    if params.hot_loads is not None:
        return params.hot_loads
    weights = load_weights(log, params)
    return hot_keys(weights, "load_id", "triggers", "responses", params.pairs_per_split, params.rows_per_split)


def land_log(log: DataFrame, params: ReportParams) -> tuple[DataFrame, ReportParams]:
    """`active_log` and the grid of its hot loads as landed tables, and parameters that let every plan take them.

    Triggers, responses and the weights of loads are three looks at the log. Of the landed rows that is three small
    scans; of the log itself each would run the semi join over its history again. The grid is a small file, which the
    planner sees, so that looking loads up in it needs no shuffle.
    """
    if params.rows_are_active:
        return log, params
    rows = landed(active_log(log, params), "active-rows")
    params = replace(params, rows_are_active=True)
    return rows, replace(params, hot_loads=landed(hot_loads(rows, params), "hot-loads"))


def attach_responses(rows: DataFrame, responses: DataFrame, hot: DataFrame, wanted: str = "true") -> DataFrame:
    """Left join every row to all later responses of its load; rows not `wanted` stay without one.

    The pairs are the result the reports ask for. The pairs of a hot load are a grid. A row of it that no
    response follows stays in one cell only, which the load's latest response tells before the join.
    """
    grid, hot = [LEFT, RIGHT], within_cells(hot)
    left = deal(rows, "load_id", hot, LEFT, RIGHT, carry=["latest_response"])
    right = deal(responses, "load_id", hot, RIGHT, LEFT).selectExpr(
        "load_id AS response_load",
        *[f"{side} AS response_{side}" for side in grid],
        "status AS response_status",
        *RESPONSE_COLUMNS,
    )
    cell = " AND ".join(f"{side} = response_{side}" for side in grid)
    match = f"load_id = response_load AND {cell} AND trigger_timestamp < response_timestamp AND ({wanted})"
    met = "response_load IS NOT NULL"
    followed = f"coalesce(trigger_timestamp < latest_response AND ({wanted}), false)"
    return (
        left.join(right, F.expr(match), "left")
        .where(f"{met} OR ({RIGHT} = 0 AND NOT {followed}) OR latest_response IS NULL")
        .selectExpr(*names(rows.columns), _status(), *RESPONSE_COLUMNS)
    )


def attach_earliest_response(
    rows: DataFrame, keys: Sequence[str], responses: DataFrame, hot: DataFrame, wanted: str
) -> DataFrame:
    """Left join each row to the earliest later response of its load; `keys` tell the rows apart.

    For few rows per load: here the many responses are the dealt side, the rows are copied to every
    split of their load, and a mergeable minimum brings the copies together again. No pairs are kept.
    """
    columns = rows.columns
    right = deal(responses, "load_id", hot, RIGHT).selectExpr(
        "load_id AS response_load", f"{RIGHT} AS response_split", "status AS response_status", *RESPONSE_COLUMNS
    )
    match = (
        f"load_id = response_load AND {RIGHT} = response_split "
        f"AND trigger_timestamp < response_timestamp AND ({wanted})"
    )
    response = "struct(response_timestamp, response_message, response_status, actions)"
    return (
        copy_per_split(rows, "load_id", hot, RIGHT)
        .join(right, F.expr(match), "left")
        .groupBy(*keys)
        .agg(
            F.expr(f"min({row_struct(columns, columns, skip=keys)}) AS row"),
            F.expr(f"min(CASE WHEN response_load IS NOT NULL THEN {response} END) AS best"),
        )
        .selectExpr(*keys, "row.*", "best.*")
        .selectExpr(*names(columns), _status(), *RESPONSE_COLUMNS)
    )


def _status() -> str:
    return f"coalesce(response_status, '{c.AWAITING_STATUS}') AS status"
