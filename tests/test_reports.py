"""Whole reports: columns, row counts, files and report sets."""

import csv
import glob
from datetime import timedelta

import pytest

from loadtrail.constants import ALERT_LABEL
from loadtrail import constants as c
from loadtrail import schemas
from loadtrail.operators.carriers import carrier_table
from loadtrail.plans.notifier import notifier_report
from loadtrail.plans.rtp import rtp_report
from loadtrail.session import SETTINGS
from loadtrail.sinks import report_set
from loadtrail.sinks.csv import write_report
from loadtrail.sinks.report_set import publish_table, read_table, table_names
from loadtrail.sources.tables import read_audit_log, read_holdover_csv, read_report_csv, time_slices
from tests.helpers import NOTIFIER, READY, at, log_frame, log_row, milestone, milestone_frame

T = at("10:00:00")


def _carriers(spark):
    body = '{"loads":[{"loadNumber":"1","carrier":{"name":"Carrier, \\"One\\"","id":"ONE"}}]}'
    return carrier_table(spark.createDataFrame([(body, 0)], schemas.CARRIER_PAYLOAD))


def _holdover(spark, *numbers):
    blank = [None] * (len(c.SHEET_COLUMNS) - 2)
    return spark.createDataFrame([(n, "sheet carrier", *blank, "Plant", "10:01:2024") for n in numbers], schemas.HOLDOVER)


def _inputs(spark):
    log = []
    for workflow in ("notifier", "ready_to_pickup"):
        message = f"Load #1: {ALERT_LABEL} Load #1 is late\nmore"
        log.append(log_row("1", "r", workflow, "FETCHED_CARRIER_SCAC", T, message))
        log.append(log_row("2", "r", workflow, "FETCHED_CARRIER_SCAC", T))
        log.append(log_row("3", "r", workflow, "FETCHED_CARRIER_SCAC", T))
    for minutes, request in ((5, "x"), (7, "y")):
        later = T + timedelta(minutes=minutes, microseconds=500000)
        log.append(log_row("1", request, "shipment_update", "DETAILS_EXTRACTED", later, f"Raw message {request}"))
        log.append(log_row("3", request, "shipment_update", "DETAILS_EXTRACTED", later, f"Raw message {request}"))
    log.append(log_row("1", "x", "shipment_update", "ETA_UPDATED", T + timedelta(minutes=9)))
    marks = []
    for workflow in ("notifier", "ready_to_pickup"):
        marks.append(milestone("1", T + timedelta(seconds=30), "escalation_l2_sent", workflow=workflow))
        marks.append(milestone("3", T + timedelta(seconds=60), workflow=workflow))
    return log_frame(spark, log), milestone_frame(spark, marks)


def test_notifier_report(spark):
    report = notifier_report(*_inputs(spark), _carriers(spark), NOTIFIER)
    assert report.columns == list(c.NOTIFIER_COLUMNS)
    rows = {(r["Load Number"], r["Response Message"]): r for r in report.collect()}
    assert set(rows) == {("1", "Raw message x"), ("1", "Raw message y"), ("2", None), ("3", "Raw message x"), ("3", "Raw message y")}
    first = rows["1", "Raw message x"]
    assert first["Workflow Execution Id"] == "r-1-1"
    assert (first["carrier_name"], first["Carrier SCAC"]) == ('Carrier, "One"', "ONE")
    assert first["Trigger Message"] == "is late"
    assert first["Response Delay (mins)"] == 270.5 / 60
    assert (first["Status"], first["Reminder"], first["Escalated"]) == ("SUCCESS", "Y", "Y")
    assert first["Update Actions"] == "DETAILS_EXTRACTED; ETA_UPDATED"
    assert rows["1", "Raw message y"]["Status"] == "SKIPPED/INVALID_RESPONSE/FAILED"
    skipped = rows["2", None]
    assert (skipped["Status"], skipped["Update Actions"]) == ("TRIGGER_SKIPPED", "DETAILS_EXTRACTED")
    assert (skipped["carrier_name"], skipped["Trigger Message"]) == ("", None)


def test_rtp_report_has_the_rows_of_the_holdover_list(spark):
    report = rtp_report(*_inputs(spark), _carriers(spark), _holdover(spark, 3, 1, 1, 2, 99), READY)
    assert report.columns == list(c.READY_TO_PICKUP_COLUMNS)
    rows = report.collect()
    # sorted by trigger time, then load number; loads without a trigger come last
    assert [r["Load Number"] for r in rows] == [1, 1, 2, 3, 99]
    assert [r["NOTES/COMMENTS"] for r in rows] == [
        c.NOTE_PROCESSED, c.NOTE_PROCESSED, c.NOTE_NOT_SENT, c.NOTE_NOT_PROCESSED, c.NOTE_NOT_SENT,
    ]
    assert [r["Status"] for r in rows] == ["SUCCESS", "SUCCESS", "TRIGGER_SKIPPED", "SKIPPED/INVALID_RESPONSE/FAILED", None]
    assert rows[0]["Workflow Execution Id"] == "r-1"
    assert rows[0]["Response Message"] == "Raw message x"
    # cut at the label only: the load prefix stays in this report
    assert rows[0]["Trigger Message"] == "Load #1 is late"
    assert (rows[0]["CARRIER"], rows[0]["carrier_name"]) == ("sheet carrier", 'Carrier, "One"')


def test_csv_file_and_round_trip(spark, tmp_path):
    report = rtp_report(*_inputs(spark), _carriers(spark), _holdover(spark, 1, 99), READY)
    path = str(tmp_path / "report")
    write_report(report, path)
    lines = []
    for part in sorted(glob.glob(f"{path}/part-*.csv")):
        with open(part, newline="", encoding="utf-8") as handle:
            lines += list(csv.DictReader(handle))
    assert [line["Load Number"] for line in lines] == ["1", "99"]
    assert lines[0]["CARRIER"] == "sheet carrier" and lines[0]["Carrier"] == 'Carrier, "One"'
    assert lines[0]["Triggered At"] == "2024-01-10 10:00:00.000000"
    assert lines[1]["Status"] == "" and lines[1]["Carrier"] == ""
    back = read_report_csv(spark, path, report.schema)
    assert [r["Response At"] for r in back.collect()] == [r["Response At"] for r in report.collect()]


def test_csv_keeps_odd_text(spark, tmp_path):
    texts = [' padded ', 'quote " inside', "two\nlines", "back\\slash", "comma, here", "\\", 'end"', None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    write_report(frame.coalesce(1), str(tmp_path / "odd"))
    back = {r.n: r.t for r in read_report_csv(spark, str(tmp_path / "odd"), frame.schema, multi_line=True).collect()}
    assert back == {n: text or None for n, text in enumerate(texts)}


def test_external_holdover_csv(spark, tmp_path):
    _holdover(spark, 5).write.option("header", True).csv(str(tmp_path / "h"))
    row = read_holdover_csv(spark, str(tmp_path / "h")).first()
    assert (row["Load Number"], row["CARRIER"], row["FACILITY"]) == (5, "sheet carrier", "Plant")


def test_publish_replaces_one_table(spark, tmp_path):
    home, other = str(tmp_path / "home"), str(tmp_path / "other")
    one, two = spark.range(3).toDF("a"), spark.range(5).toDF("b")
    publish_table(one, home)
    publish_table(two, home, "extra")
    assert table_names(spark, home) == ["extra", c.MASTER_TABLE]
    # the new rows may come from the table they replace
    publish_table(read_table(spark, home, c.MASTER_TABLE).where("a > 0"), home)
    assert read_table(spark, home, c.MASTER_TABLE).count() == 2
    assert read_table(spark, home, "extra").count() == 5
    publish_table(two, home, target=other)
    assert read_table(spark, home, c.MASTER_TABLE).columns == ["a"]
    assert read_table(spark, other, c.MASTER_TABLE).columns == ["b"]
    assert read_table(spark, other, "extra").count() == 5
    assert table_names(spark, str(tmp_path / "none")) == []


def test_failed_publish_keeps_the_old_table(spark, tmp_path):
    home = str(tmp_path / "set")
    publish_table(spark.range(3).toDF("a"), home)
    broken = spark.range(2).selectExpr("CAST(raise_error('broken') AS STRING) AS a")
    with pytest.raises(Exception, match="broken"):
        publish_table(broken, home)
    assert read_table(spark, home, c.MASTER_TABLE).count() == 3
    assert table_names(spark, home) == [c.MASTER_TABLE]


def test_failed_switch_keeps_the_old_table(spark, tmp_path, monkeypatch):
    home = str(tmp_path / "set")
    publish_table(spark.range(3).toDF("a"), home)

    def fail(*_):
        raise OSError("no marker")

    with monkeypatch.context() as patched:
        patched.setattr(report_set, "_switch", fail)
        with pytest.raises(OSError, match="no marker"):
            publish_table(spark.range(9).toDF("a"), home)
    assert read_table(spark, home, c.MASTER_TABLE).count() == 3
    for n in range(4, 8):
        old = read_table(spark, home, c.MASTER_TABLE)
        publish_table(spark.range(n).toDF("a"), home)
        assert old.count() == n - 1  # a reader that has begun still finds its version
    assert read_table(spark, home, c.MASTER_TABLE).count() == 7


def test_settings_of_the_session():
    assert int(SETTINGS["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 4096
    assert SETTINGS["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_readers_declare_their_schema(spark, tmp_path):
    log, _ = _inputs(spark)
    log.write.parquet(str(tmp_path / "log"))
    assert read_audit_log(spark, str(tmp_path / "log")).schema == schemas.AUDIT_LOG


def test_every_row_is_in_one_time_slice(spark):
    start = at("00:00:00")
    times = [start + timedelta(hours=n, seconds=n % 2) for n in range(-30, 60)]
    frame = spark.createDataFrame([(moment,) for moment in times], "created_at timestamp_ntz")
    slices = time_slices(start, start + timedelta(days=1), 5)
    counts = [frame.where(condition).count() for condition in slices]
    assert sum(counts) == len(times) and min(counts) >= 4 and len(counts) == 5
    assert time_slices(start, start, 1) == ["1 = 1"]
