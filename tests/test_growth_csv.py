"""Disk of reports whose texts repeat."""

import glob
import os
from datetime import datetime

from pyspark.sql.types import StructType

from checks.registry import queries
from loadtrail.sinks.csv import write_report
from loadtrail.sources.tables import read_report_csv


def test_compressed_reports_read_back_and_take_little_disk(spark, tmp_path):
    rows = spark.range(0, 5_000, 1, 2).selectExpr("id", "concat('Load late\n\"on time\", ', repeat('x', 200)) AS text")
    sizes = {}
    for name in ("none", "gzip"):
        path = str(tmp_path / name)
        write_report(rows, path, rows_per_file=500, compression=name)
        sizes[name] = sum(os.path.getsize(file) for file in glob.glob(f"{path}/part-*"))
        back = read_report_csv(spark, path, rows.schema, multi_line=True)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert sizes["gzip"] < 0.1 * sizes["none"]


def test_the_round_trip_compresses_its_report(spark):
    files = queries()["csv_roundtrip"](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and all(file.endswith(".csv.gz") for file in files)


TIMES = {
    "2024-02-29 23:59:59.123456": datetime(2024, 2, 29, 23, 59, 59, 123456),
    "2024-02-29 23:59:59": datetime(2024, 2, 29, 23, 59, 59),
    "2024-02-29 23:59:59.5": datetime(2024, 2, 29, 23, 59, 59, 500000),
    "2024-02-29 23:59:59.00012": datetime(2024, 2, 29, 23, 59, 59, 120),
    "0001-01-01 00:00:00.000000": datetime(1, 1, 1),
    **dict.fromkeys(
        (
            "2023-02-29 00:00:00|2024-01-02|2024-01-02T03:04:05|2024-1-2 03:04:05|2024-01-02 24:00:00|2024-01-02 03:04:60"
            "|2024-01-02 03:04:05.|2024-01-02 03:04:05.1234567|2024-01-02 03:04:05.123456000|2024-13-02 03:04:05"
            "|2024-01-02 03:04:05Z|2024-01-02 03:04:5 | 2024-01-02 03:04:05|2024-01-02 03:04:05 |02024-01-02 03:04:05"
            "|-0000-01-02 03:04:05|2024-01-02 03:04:05.12345Z|2024-01-02 03:04|soon|+2024-01-02 03:04:05"
        ).split("|")
    ),
}


def test_times_are_read_as_text_and_cast(spark, tmp_path):
    """The reader's own parser took most of its time; what it takes for a time stays the same."""
    (tmp_path / "times.csv").write_text("t,at\n" + "".join(f'"{text}",{text}\n' for text in [*TIMES, ""]))
    found = read_report_csv(spark, str(tmp_path / "times.csv"), StructType.fromDDL("t string, at timestamp_ntz"))
    assert found.schema == StructType.fromDDL("t string, at timestamp_ntz")
    assert {row.t: row["at"] for row in found.collect()} == TIMES | {None: None}
    assert "ReadSchema: struct<t:string,at:string>" in found._jdf.queryExecution().executedPlan().toString()


def test_times_of_far_years_come_back(spark, tmp_path):
    years = ("-0044-03-15 12:00:00.5", "9999-12-31 23:59:59.999999", "+10000-01-01 00:00:00", "+294246-12-31 00:00:00.000001")
    rows = spark.createDataFrame([(year,) for year in years], "t string").selectExpr("t", "CAST(t AS TIMESTAMP_NTZ) AS at")
    write_report(rows, str(tmp_path / "far"))
    back = read_report_csv(spark, str(tmp_path / "far"), rows.schema)
    assert back.where("at IS NOT NULL").count() == 4 and back.exceptAll(rows).isEmpty()
