"""Produce one report from landed tables: `python -m loadtrail.run notifier --shipper ... --start ... --end ...`.

`request-days` instead of a report merges the log of the given days into the table of request days.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loadtrail.constants import MASTER_TABLE
from loadtrail.operators.carriers import carrier_table
from loadtrail.operators.correlation import land_log
from loadtrail.params import ReportParams
from loadtrail.plans.holdover import holdover_list
from loadtrail.plans.naming import report_label
from loadtrail.plans.notifier import notifier_report
from loadtrail.plans.rtp import SORT_KEY, rtp_rows_of_report
from loadtrail.schemas import AUDIT_LOG, CARRIER_PAYLOAD, MILESTONES
from loadtrail.session import build_session
from loadtrail.sinks.csv import write_report
from loadtrail.sinks.report_set import publish_table, read_table
from loadtrail.sinks.request_days import extend_request_days, read_request_days
from loadtrail.sources import tables

NOTIFIER, READY_TO_PICKUP, REQUEST_DAYS = "notifier", "rtp", "request-days"
SORT_BY = {NOTIFIER: ("Triggered At",), READY_TO_PICKUP: SORT_KEY}


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("report", choices=[NOTIFIER, READY_TO_PICKUP, REQUEST_DAYS])
    parser.add_argument("--shipper", help="whose report")
    parser.add_argument("--start", required=True, help="first day, YYYY-MM-DD")
    parser.add_argument("--end", required=True, help="last day, included")
    parser.add_argument("--audit-log", required=True, help="folder, or table name with --jdbc-url")
    parser.add_argument("--milestones", help="folder, or table name with --jdbc-url")
    parser.add_argument("--jdbc-url", help="read both logs from this database")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE", help="driver, user, ...")
    parser.add_argument("--jdbc-slices", type=int, default=64, help="parallel reads of a log")
    parser.add_argument("--request-days", help="folder of the days of requests, to open less history")
    parser.add_argument("--carrier-payload", help="without it the carrier columns stay empty")
    parser.add_argument("--cells", help="sheet cells, for the rtp report")
    parser.add_argument("--mail", help="landed mail, for the rtp report")
    parser.add_argument("--holdover-csv", help="a ready holdover list instead of cells and mail")
    parser.add_argument("--output", help="folder that receives the CSV report")
    parser.add_argument("--report-set", help="also replace the master table of this report set")
    return parser


def read_log(spark: SparkSession, arguments: argparse.Namespace, table: str, schema: StructType) -> DataFrame:
    if not arguments.jdbc_url:
        return spark.read.schema(schema).parquet(table)
    properties = dict(item.split("=", 1) for item in arguments.jdbc_property)
    return tables.read_jdbc_table(spark, arguments.jdbc_url, table, schema, arguments.jdbc_slices, properties)


def add_request_days(spark: SparkSession, arguments: argparse.Namespace) -> str:
    """Merge the log of the range, of all shippers, into the table of request days."""
    log = read_log(spark, arguments, arguments.audit_log, AUDIT_LOG)
    days = ReportParams.notifier("", arguments.start, arguments.end)
    extend_request_days(log.where(days.logged_in_range(log.columns)), arguments.request_days)
    return arguments.request_days


def build_report(spark: SparkSession, arguments: argparse.Namespace) -> tuple[DataFrame, str]:
    """The report and the name of its output."""
    log = read_log(spark, arguments, arguments.audit_log, AUDIT_LOG)
    milestones = read_log(spark, arguments, arguments.milestones, MILESTONES)
    days_of_requests = read_request_days(spark, arguments.request_days) if arguments.request_days else None
    if arguments.carrier_payload:
        payload = tables.read_carrier_payload(spark, arguments.carrier_payload)
    else:
        payload = spark.createDataFrame([], CARRIER_PAYLOAD)
    carriers = carrier_table(payload)
    days = (arguments.shipper, arguments.start, arguments.end)
    if arguments.report == NOTIFIER:
        params, kind = replace(ReportParams.notifier(*days), request_days=days_of_requests), "notifier_report"
        log, active = land_log(log, params)
        report = notifier_report(log, milestones, carriers, active)
    else:
        params, kind = replace(ReportParams.ready_to_pickup(*days), request_days=days_of_requests), "rtp-report"
        if arguments.holdover_csv:
            holdover = tables.read_holdover_csv(spark, arguments.holdover_csv)
        else:
            cells = tables.read_cells(spark, arguments.cells)
            holdover = holdover_list(cells, tables.read_mail(spark, arguments.mail), params)
        log, active = land_log(log, params)
        report = rtp_rows_of_report(log, milestones, carriers, holdover, active)
    # the name is a constant expression: this reads no table
    label = spark.sql(f"SELECT {report_label(params)}").first()[0]
    return report, f"{params.shipper_id}-{kind}_{label}.csv"


def main(argv: list[str] | None = None) -> str:
    parser = _arguments()
    arguments = parser.parse_args(argv)
    if arguments.report == READY_TO_PICKUP and not (arguments.holdover_csv or (arguments.cells and arguments.mail)):
        parser.error("the rtp report needs --cells and --mail, or --holdover-csv")
    needed = ("request_days",) if arguments.report == REQUEST_DAYS else ("shipper", "milestones", "output")
    for name in needed:
        if getattr(arguments, name) is None:
            parser.error(f"{arguments.report} needs --{name.replace('_', '-')}")
    spark = build_session()
    if arguments.report == REQUEST_DAYS:
        return add_request_days(spark, arguments)
    report, name = build_report(spark, arguments)
    path = f"{arguments.output.rstrip('/')}/{name}"
    if arguments.report_set:
        # computed once: the CSV is written from the published rows
        publish_table(report, arguments.report_set)
        report = read_table(spark, arguments.report_set, MASTER_TABLE)
    write_report(report, path, sort_by=SORT_BY[arguments.report])
    return path


if __name__ == "__main__":
    main()
