"""Sheets with floating origins, and the mail they came with."""

import base64
from datetime import date

from loadtrail import constants as c
from loadtrail import schemas
from loadtrail.operators.sheets import attachments, received_dates, sheet_anchors, sheet_facilities
from loadtrail.params import ReportParams
from loadtrail.plans.holdover import holdover_list

PARAMS = ReportParams("shipper-a-b", "ready_to_pickup", date(2024, 1, 10), date(2024, 1, 11))
JAN_10 = 1704844800000
DAY = 86_400_000


def _cells(spark, sheets):
    rows = [
        (file, row, column, value)
        for file, lines in sheets.items()
        for row, line in lines.items()
        for column, value in enumerate(line)
        if value is not None
    ]
    return spark.createDataFrame(rows, schemas.CELLS)


def _mail(spark, messages):
    return spark.createDataFrame(messages, schemas.MAIL)


def _message(key, when, text="holdover", parts=(("s.xlsx", "a", None),), headers=()):
    return (key, when, text, list(headers), list(parts))


LINE = [f"v{n}" for n in range(1, 14)]
SHEETS = {
    "one.xlsx": {
        0: ["title"],
        1: [None, "PLANT:", "Plant 1", "PLANT:", "wrong"],
        2: ["PLANT:", "wrong"],
        3: ["55", *LINE],
        4: ["SHIPMENT NUMBER", "CARRIER"],
        5: ["101", *LINE],
        6: ["TOTAL", "2"],
        7: [None, "x"],
        8: ["12.5", *LINE],
        9: ["SHIPMENT NUMBER", "CARRIER"],
        10: [" +102 ", "late"],
        11: ["9" * 25],
    },
    "two.xlsx": {7: [None, None, "SHIPMENT NUMBER"], 8: ["103"], 40: ["PLANT:"]},
    "bare.xlsx": {0: ["104"], 1: ["PLANT:", "Plant 3"]},
}


def test_holdover_list(spark):
    mail = _mail(spark, [_message("m", JAN_10, parts=[("one.xlsx", "a", None)])])
    frame = holdover_list(_cells(spark, SHEETS), mail, PARAMS)
    assert frame.columns == [*c.SHEET_COLUMNS, "FACILITY", "DATE"]
    result = {r["Load Number"]: r for r in frame.collect()}
    # the sheet without a header gives nothing; the one without a facility gives its row
    assert set(result) == {101, 102, 103}
    assert (result[101]["FACILITY"], result[101]["DATE"]) == ("Plant 1", "10:01:2024")
    assert [result[101][name] for name in c.SHEET_COLUMNS[1:]] == LINE
    assert (result[102]["CARRIER"], result[102]["CONTAINER ID"]) == ("late", None)
    assert (result[103]["FACILITY"], result[103]["DATE"]) == (None, None)


def test_facility_is_right_of_the_first_label(spark):
    cells = _cells(spark, SHEETS)
    result = {r["file_name"]: r["FACILITY"] for r in sheet_facilities(sheet_anchors(cells)).collect()}
    assert result == {"one.xlsx": "Plant 1", "bare.xlsx": "Plant 3"}


def test_attachments(spark):
    data = base64.urlsafe_b64encode(b"\xfb\xff\xbf sheet").decode()
    messages = [
        _message("first", JAN_10, "see HoldOver list", [("a.xlsx", "1", data), ("b.xlsx", "2", data)], [("Subject", "S")]),
        _message("last", JAN_10 + 2 * DAY - 1, "hold over", [("", "3", data), ("c.xlsx", None, data), ("d.xlsx", "4", None)],
                 [("From", "x"), ("Subject", "one"), ("Subject", "two")]),
        _message("early", JAN_10 - 1),
        _message("after", JAN_10 + 2 * DAY),
        _message("other", JAN_10, "hold  over"),
        _message("no time", None),
        _message("none", JAN_10, parts=()),
        _message("untitled", JAN_10, parts=[("e.xlsx", "5", data)]),
    ]
    frame = attachments(_mail(spark, messages), PARAMS)
    result = {r["file_name"]: r for r in frame.collect()}
    assert {name: (r["message_id"], r["subject"], r["received_date"]) for name, r in result.items()} == {
        "a.xlsx": ("first", "S", "10:01:2024"),
        "b.xlsx": ("first", "S", "10:01:2024"),
        "d.xlsx": ("last", "one", "11:01:2024"),
        "e.xlsx": ("untitled", "No Subject", "10:01:2024"),
    }
    assert bytes(result["a.xlsx"]["content"]) == b"\xfb\xff\xbf sheet"
    assert {r["shipper_key"] for r in result.values()} == {"shipper_a_b"}


def test_latest_message_dates_a_file(spark):
    messages = [_message("1", JAN_10), _message("2", JAN_10 + DAY), _message("0", JAN_10 + 5)]
    dates = received_dates(attachments(_mail(spark, messages), PARAMS)).collect()
    assert [tuple(r) for r in dates] == [("s.xlsx", "11:01:2024")]
