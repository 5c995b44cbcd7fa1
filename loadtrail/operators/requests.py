"""Log rows of the requests that were active in the report range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail import constants as c
from loadtrail.functions.sql import text, texts
from loadtrail.params import ReportParams
from loadtrail.sinks.landing import landed


def load_rows(log: DataFrame, params: ReportParams) -> DataFrame:
    return log.where(f"entity_type IN ({texts(c.LOAD_ENTITY_TYPES)}) AND shipper_id = {text(params.shipper_id)}")


def is_trigger(params: ReportParams) -> str:
    condition = f"workflow_identifier = {text(params.workflow)}"
    if params.trigger_action is not None:
        condition += f" AND action = {text(params.trigger_action)}"
    return f"({condition})"


def is_response() -> str:
    return f"(workflow_identifier = '{c.RESPONSE_WORKFLOW}')"


def active_requests(log: DataFrame, params: ReportParams) -> DataFrame:
    """Distinct ids seen in the range, of any shipper, workflow or entity type."""
    seen = f"{params.logged_in_range(log.columns)} AND request_id IS NOT NULL"
    return log.where(seen).select("request_id").distinct()


def request_days(log: DataFrame) -> DataFrame:
    """The days of every request, of any shipper: a table to land once and extend by day (`sinks/request_days.py`).

    One row per request with the sorted set of its days, first and last day beside it.
    """
    day = F.col(c.DAY_COLUMN) if c.DAY_COLUMN in log.columns else F.to_date("created_at")
    days = log.where("request_id IS NOT NULL").groupBy("request_id")
    return _with_ends(days.agg(F.sort_array(F.collect_set(day)).alias("days")))


def merged_request_days(known: DataFrame, more: DataFrame) -> DataFrame:
    """Two tables of request days as one; days that both hold count once."""
    both = known.select("request_id", "days").unionByName(more.select("request_id", "days"))
    union = F.sort_array(F.array_distinct(F.flatten(F.collect_list("days"))))
    return _with_ends(both.groupBy("request_id").agg(union.alias("days")))


def _with_ends(days: DataFrame) -> DataFrame:
    return days.selectExpr("request_id", "days", "array_min(days) AS first_day", "array_max(days) AS last_day")


def history_days(days_of_requests: DataFrame, params: ReportParams) -> DataFrame:
    """The days outside the range on which requests of the range were logged, one row each."""
    start, end = f"DATE'{params.start}'", f"DATE'{params.end}'"
    reached = days_of_requests.where(
        f"first_day <= {end} AND last_day >= {start} AND exists(days, day -> day BETWEEN {start} AND {end})"
    )
    return reached.selectExpr("explode(days) AS day").where(params.is_history_day("day")).distinct()


def rows_of_active_requests(log: DataFrame, rows: DataFrame, params: ReportParams) -> DataFrame:
    """Rows whose request occurs in the range, whenever the row itself was written.

    A row inside the range is its own proof and passes without a shuffle; only rows outside it need
    the semi join. With a table of request days, only the days of active requests are opened: they are joined to
    the partition column, which prunes the scan while it runs. Rows that `active_log` has picked pass as they are.
    """
    if params.rows_are_active:
        return rows.where("request_id IS NOT NULL")
    inside = rows.where(f"{params.logged_in_range(rows.columns)} AND request_id IS NOT NULL")
    outside = rows.where(f"{params.logged_out_of_range(rows.columns)} AND request_id IS NOT NULL")
    if params.request_days is not None and c.DAY_COLUMN in rows.columns:
        # a calendar bounds this table, as many rows as the log has days: landed, so that requests are read once
        days = landed(history_days(params.request_days, params), "history-days").where(params.is_history_day("day"))
        ends = days.agg(F.min("day").alias("first"), F.max("day").alias("last"))
        between = F.col(c.DAY_COLUMN).between(ends.select("first").scalar(), ends.select("last").scalar())
        calendar = F.broadcast(days.withColumnRenamed("day", "history_day"))
        outside = outside.where(between).join(calendar, F.col(c.DAY_COLUMN) == F.col("history_day"), "left_semi")
    return inside.unionByName(outside.join(active_requests(log, params), "request_id", "left_semi"))


ACTIVE_COLUMNS = ("entity_id", "request_id", "entity_type", "shipper_id", "workflow_identifier", "action", "comment", "created_at")


def active_log(log: DataFrame, params: ReportParams) -> DataFrame:
    """The triggers and responses of active requests, all that a report needs of the log, with one look at history."""
    rows = load_rows(log, params).where(f"{is_trigger(params)} OR {is_response()}")
    return rows_of_active_requests(log, rows, params).select(*ACTIVE_COLUMNS)
