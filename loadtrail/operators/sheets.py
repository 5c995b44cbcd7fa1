"""Holdover sheets as header-less cells, and the mail they came with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail import constants as c
from loadtrail.functions.sql import name, names, text
from loadtrail.functions.text import decode_base64url, load_number, shipper_key
from loadtrail.functions.timestamps import millis_to_timestamp, received_date
from loadtrail.params import ReportParams
from loadtrail.sinks.landing import landed


def sheet_anchors(cells: DataFrame) -> DataFrame:
    """Per file with a label: first header row, and the cell to the right of the first plant label (row, then column).

    `beside` is null without a plant label or without a cell to its right. Only cells in a place where some file has
    the cell beside its label go into the join. These places are few, and landed, so that the planner sees it.
    """
    labels = cells.where(f"cell_value IN ('{c.PLANT_LABEL}', '{c.HEADER_LABEL}')").selectExpr(
        "file_name AS label_file", "row_idx AS label_row", "col_idx AS label_column", "cell_value AS label"
    )
    beside = F.expr(
        f"label = '{c.PLANT_LABEL}' AND label_file = file_name AND label_row = row_idx AND label_column + 1 = col_idx"
    )
    places = labels.where(f"label = '{c.PLANT_LABEL}'").selectExpr("label_row AS place_row", "label_column + 1 AS place_column")
    in_place = F.expr("row_idx = place_row AND col_idx = place_column")
    near = cells.join(landed(places.distinct(), "label-places"), in_place, "left_semi")
    plant, header = f"label = '{c.PLANT_LABEL}'", f"label = '{c.HEADER_LABEL}'"
    first = f"min(CASE WHEN {plant} THEN struct(label_row, label_column, file_name IS NOT NULL AS met, cell_value) END)"
    return (
        labels.join(near, beside, "left")
        .groupBy(F.expr("label_file AS file_name"))
        .agg(F.expr(f"{first} AS beside"), F.expr(f"min(CASE WHEN {header} THEN label_row END) AS header_row"))
        .selectExpr("file_name", "header_row", "CASE WHEN beside.met THEN beside END AS beside")
    )


def sheet_facilities(anchors: DataFrame) -> DataFrame:
    """Per file with a cell to the right of its plant label: that cell."""
    return anchors.where("beside IS NOT NULL").selectExpr("file_name", f"beside.cell_value AS {c.FACILITY_COLUMN}")


def sheet_rows(cells: DataFrame) -> DataFrame:
    """Cells to the fourteen columns by position, keeping rows that start with a whole number.

    Totals, blank lines and repeated headers drop out here, before anything is joined to the rows.
    """
    by_position = [
        F.expr(f"max(cell_value) FILTER (WHERE col_idx = {position}) AS {name(column)}")
        for position, column in enumerate(c.SHEET_COLUMNS)
    ]
    first, *others = names(c.SHEET_COLUMNS)
    return (
        cells.where(f"col_idx BETWEEN 0 AND {len(c.SHEET_COLUMNS) - 1}")
        .groupBy("row_idx", "file_name")  # the cheap key first: the aggregate sorts by its keys
        .agg(*by_position)
        .selectExpr("file_name", "row_idx", f"{load_number(first)} AS {first}", *others)
        .where(f"{first} IS NOT NULL")
    )


def attachments(mail: DataFrame, params: ReportParams) -> DataFrame:
    """One row per attachment of the holdover mails received in the range (UTC)."""
    found = " OR ".join(f"contains(lower(text), '{term}')" for term in c.MAIL_SEARCH_TERMS)
    subject = "get(filter(headers, header -> header.name = 'Subject'), 0).value"
    return (
        mail.where(f"({found}) AND {params.in_range(millis_to_timestamp('internal_date'))}")
        .selectExpr("*", "explode(parts) AS part")
        .where("part.filename <> '' AND part.attachment_id <> ''")
        .selectExpr(
            "message_id",
            "internal_date",
            "part.filename AS file_name",
            f"coalesce({subject}, '{c.NO_SUBJECT}') AS subject",
            f"{received_date('internal_date')} AS received_date",
            f"{shipper_key(text(params.shipper_id))} AS shipper_key",
            f"{decode_base64url('part.data')} AS content",
        )
    )


def received_dates(mail_attachments: DataFrame) -> DataFrame:
    """One received date per file; the latest message wins where a file name came twice."""
    latest = f"max_by(received_date, struct(internal_date, message_id)) AS {name(c.RECEIVED_COLUMN)}"
    return mail_attachments.groupBy("file_name").agg(F.expr(latest))
