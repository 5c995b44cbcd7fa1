"""The command line, on tables laid out by day."""

import csv
import glob
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loadtrail import run, schemas
from loadtrail.operators.requests import request_days, rows_of_active_requests
from loadtrail.params import ReportParams
from loadtrail.plans.holdover import holdover_list
from loadtrail.plans.notifier import notifier_rows
from loadtrail.sinks.csv import write_report
from loadtrail.sinks.report_set import read_table
from loadtrail.sources import tables
from loadtrail.sources.tables import read_audit_log, read_milestones
from tests import brute
from tests.helpers import NOTIFIER, log_frame, milestone_frame
from tests.test_holdover import JAN_10, SHEETS, _cells, _mail, _message


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("landed")
    log, milestones = brute.random_inputs(8, rows=150, loads=["101", "102", "5"])
    day = F.to_date("created_at")
    log_frame(spark, log).withColumn("created_date", day).write.partitionBy("created_date").parquet(str(path / "log"))
    milestone_frame(spark, milestones).withColumn("created_date", day).write.partitionBy("created_date").parquet(
        str(path / "milestones")
    )
    body = '{"loads":[{"loadNumber":"101","carrier":{"name":"n","id":"S"}}]}'
    spark.createDataFrame([(body, 0)], schemas.CARRIER_PAYLOAD).write.parquet(str(path / "payload"))
    _cells(spark, SHEETS).write.parquet(str(path / "cells"))
    _mail(spark, [_message("m", JAN_10, parts=[("one.xlsx", "a", None)])]).write.parquet(str(path / "mail"))
    return path


def _lines(path):
    lines = []
    for part in sorted(glob.glob(f"{path}/part-*.csv")):
        with open(part, newline="", encoding="utf-8") as handle:
            lines += list(csv.DictReader(handle))
    return lines


def _common(folder, tmp_path):
    return [
        "--shipper", "a", "--start", "2024-01-10", "--end", "2024-01-10",
        "--audit-log", str(folder / "log"), "--milestones", str(folder / "milestones"),
        "--carrier-payload", str(folder / "payload"), "--output", str(tmp_path),
    ]


def test_notifier(spark, folder, tmp_path):
    path = run.main(["notifier", *_common(folder, tmp_path), "--report-set", str(tmp_path / "set")])
    assert path.endswith("/a-notifier_report_10thJAN_10thJAN2024.csv")
    lines = _lines(path)
    assert lines and [line["Triggered At"] for line in lines] == sorted(line["Triggered At"] for line in lines)
    assert {line["Carrier"] for line in lines} == {"n", ""}
    assert read_table(spark, str(tmp_path / "set"), "master data").count() == len(lines)


def test_rtp(folder, tmp_path):
    extra = ["--cells", str(folder / "cells"), "--mail", str(folder / "mail")]
    path = run.main(["rtp", *_common(folder, tmp_path), *extra])
    assert path.endswith("/a-rtp-report_10thJAN_10thJAN2024.csv")
    assert sorted(line["Load Number"] for line in _lines(path)) == ["101", "102", "103"]
    with pytest.raises(SystemExit):
        run.main(["rtp", *_common(folder, tmp_path)])


def test_rtp_from_a_ready_holdover_list(spark, folder, tmp_path):
    extra = ["--cells", str(folder / "cells"), "--mail", str(folder / "mail")]
    params = ReportParams.ready_to_pickup("a", "2024-01-10", "2024-01-10")
    cells, mail = tables.read_cells(spark, str(folder / "cells")), tables.read_mail(spark, str(folder / "mail"))
    write_report(holdover_list(cells, mail, params), str(tmp_path / "holdover.csv"))
    one = _lines(run.main(["rtp", *_common(folder, tmp_path / "one"), *extra]))
    two = _lines(run.main(["rtp", *_common(folder, tmp_path / "two"), "--holdover-csv", str(tmp_path / "holdover.csv")]))
    assert one == two and one


def test_request_days_open_fewer_days_and_change_nothing(spark, folder, tmp_path):
    log, milestones = read_audit_log(spark, str(folder / "log")), read_milestones(spark, str(folder / "milestones"))
    days = request_days(log)
    days.write.parquet(str(tmp_path / "days"))
    limited = replace(NOTIFIER, request_days=spark.read.parquet(str(tmp_path / "days")))
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = rows_of_active_requests(log, log, limited)._jdf.queryExecution().explainString(formatted)
    filters = [line for line in plan.splitlines() if line.startswith("PartitionFilters")]
    assert any("created_date" in line and "subquery" in line.lower() for line in filters), filters
    wanted = notifier_rows(log, milestones, NOTIFIER).collect()
    assert sorted(map(str, notifier_rows(log, milestones, limited).collect())) == sorted(map(str, wanted)) and wanted
    path = run.main(["notifier", *_common(folder, tmp_path), "--request-days", str(tmp_path / "days")])
    assert _lines(path)


def test_jdbc_options(spark):
    arguments = run._arguments().parse_args([
        "notifier", "--shipper", "a", "--start", "2024-01-10", "--end", "2024-01-10", "--audit-log", "log",
        "--milestones", "marks", "--output", "x", "--jdbc-url", "jdbc:x", "--jdbc-property", "user=a=b",
    ])
    assert dict(p.split("=", 1) for p in arguments.jdbc_property) == {"user": "a=b"}
    assert tables.jdbc_options("jdbc:x", {"user": "u"}) == {"url": "jdbc:x", "preferTimestampNTZ": "true", "user": "u"}
    assert tables.bounds_query("log") == "SELECT min(created_at) AS first_at, max(created_at) AS last_at FROM log"


def test_days_prune_partitions_and_change_nothing(spark, folder):
    log, milestones = read_audit_log(spark, str(folder / "log")), read_milestones(spark, str(folder / "milestones"))
    assert "created_date" in log.columns
    plan = rows_of_active_requests(log, log, NOTIFIER)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan
    by_day = notifier_rows(log, milestones, NOTIFIER).collect()
    plain = notifier_rows(log.drop("created_date"), milestones.drop("created_date"), NOTIFIER).collect()
    assert sorted(map(str, by_day)) == sorted(map(str, plain)) and plain
