"""Scalar expressions, also under a session zone with daylight saving."""

from datetime import date, datetime

import pytest

from loadtrail.constants import ALERT_LABEL
from loadtrail import constants as c
from loadtrail.functions import status, text, timestamps
from loadtrail.params import ReportParams
from loadtrail.plans.naming import report_label


def one(spark, expression, **values):
    names = list(values)
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {_type(values[n])}" for n in names))
    return frame.selectExpr(f"{expression} AS result").first()[0]


def _type(value):
    return {int: "bigint", datetime: "timestamp_ntz", date: "date"}.get(type(value), "string")


@pytest.mark.parametrize(
    ("comment", "expected"),
    [
        (f"Load #1: {ALERT_LABEL}  late \t", "late"),
        (f"a\n{ALERT_LABEL} first line\nsecond", "first line"),
        (f"{ALERT_LABEL} keeps \r inside\r\n", "keeps \r inside"),
        (ALERT_LABEL, ""),
        ("no label ", "no label "),
        (f"\x1f {ALERT_LABEL}\x1c  odd space  ", "odd space"),
        (None, None),
    ],
)
def test_alert_text(spark, comment, expected):
    assert one(spark, text.alert_text("x"), x=comment) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("Load #12: late Load #3 today", "late today"),
        ("late, please return)", "late, please retu"),
        ("ends with \\r\\n", "ends with "),
        ("line end)\n", "line end\n"),
        ("carriage)\r", "carriage)\r"),
        ("", ""),
        (None, None),
    ],
)
def test_without_load_prefix(spark, value, expected):
    assert one(spark, text.without_load_prefix("x"), x=value) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [(" 12 ", 12), ("+5", 5), ("-7", -7), ("00123", 123), ("\t9", 9)]
    + [(bad, None) for bad in ("1_000", "12.5", "12.0", "", "TOTAL", "9" * 30, None)],
)
def test_load_number(spark, value, expected):
    assert one(spark, text.load_number("x"), x=value) == expected


def test_decode_base64url(spark):
    assert bytes(one(spark, text.decode_base64url("x"), x="-_-_YQ==")) == b"\xfb\xff\xbfa"


def test_shipper_key(spark):
    assert one(spark, text.shipper_key("x"), x="a-b-c") == "a_b_c"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before, gap, after = datetime(2024, 3, 10, 1, 59, 59, 250000), datetime(2024, 3, 10, 2, 30, 15, 1), datetime(2024, 3, 10, 4)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, timestamps.cut_to_second("x"), x=gap) == datetime(2024, 3, 10, 2, 30, 15)
        assert one(spark, timestamps.minutes_between("x", "y"), x=before, y=after) == 7200.75 / 60
        assert one(spark, timestamps.minutes_between("x", "y"), x=after, y=before) == -7200.75 / 60
        seconds = one(spark, timestamps.epoch_seconds("x"), x=gap)
        assert seconds == (datetime(2024, 3, 10, 2, 30, 15) - datetime(1970, 1, 1)).total_seconds()
        assert one(spark, timestamps.received_date("x"), x=1704844799999) == "09:01:2024"
        assert one(spark, timestamps.received_date("x"), x=1704844800000) == "10:01:2024"
        late = status.out_of_window("y", "x")
        assert one(spark, late, x=before, y=datetime(2024, 3, 10, 2, 1, 59)) is False
        assert one(spark, late, x=before, y=datetime(2024, 3, 10, 2, 2)) is True
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_missing_times(spark):
    moment = datetime(2024, 1, 1)
    for frame in ("NULL, x", "x, NULL"):
        left, right = frame.split(", ")
        typed = [f"CAST({side} AS TIMESTAMP_NTZ)" for side in (left, right)]
        assert one(spark, timestamps.minutes_between(*typed), x=moment) is None
        assert one(spark, status.out_of_window(*typed), x=moment) is False


@pytest.mark.parametrize(
    ("value", "expected"),
    [("2024-01-10 01:02:03.5", datetime(2024, 1, 10, 1, 2, 3, 500000)), ("n/a", None), ("", None), (None, None)],
)
def test_parse_timestamp(spark, value, expected):
    assert one(spark, timestamps.parse_timestamp("x"), x=value) == expected


def test_date_labels(spark):
    expected = {1: "1stMAY", 2: "2ndMAY", 3: "3rdMAY", 4: "4thMAY", 11: "11thMAY", 12: "12thMAY", 13: "13thMAY"}
    expected |= {21: "21stMAY", 22: "22ndMAY", 23: "23rdMAY", 30: "30thMAY", 31: "31stMAY"}
    for day, label in expected.items():
        assert one(spark, timestamps.date_label("x"), x=date(2024, 5, day)) == label
    params = ReportParams.notifier("a", "2024-12-05", "2025-01-02")
    assert one(spark, report_label(params), x="") == "5thDEC_2ndJAN2024"


def test_notes(spark):
    note = status.response_note("f", "r", "a")
    moment = datetime(2024, 1, 1)
    assert one(spark, status.response_note("NULL", "r", "a"), r=moment, a="X_UPDATED") == c.NOTE_NOT_SENT
    assert one(spark, status.response_note("f", "NULL", "a"), f=moment, a="X_UPDATED") == c.NOTE_AWAITING
    assert one(spark, note, f=moment, r=moment, a="eta_updated") == c.NOTE_PROCESSED
    assert one(spark, note, f=moment, r=moment, a="xUPDATED") == c.NOTE_NOT_PROCESSED
    assert one(spark, note, f=moment, r=moment, a=None) == c.NOTE_NOT_PROCESSED
