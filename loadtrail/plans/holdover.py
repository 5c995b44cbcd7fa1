"""Holdover list: the rows of all sheets with their facility and received date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtrail import constants as c
from loadtrail.functions.sql import names
from loadtrail.operators.sheets import attachments, received_dates, sheet_anchors, sheet_rows
from loadtrail.params import ReportParams


def sheet_facts(cells: DataFrame, mail: DataFrame, params: ReportParams) -> DataFrame:
    """One row per file: header row, facility (null without a label) and received date (null without mail)."""
    return (
        sheet_anchors(cells)
        .where("header_row IS NOT NULL")
        .selectExpr("file_name", "header_row", f"beside.cell_value AS {c.FACILITY_COLUMN}")
        .join(received_dates(attachments(mail, params)), "file_name", "left")
    )


def holdover_list(cells: DataFrame, mail: DataFrame, params: ReportParams) -> DataFrame:
    """A sheet without a header row contributes nothing."""
    facts = sheet_facts(cells, mail, params).withColumnRenamed("file_name", "fact_file")
    below_header = F.expr("file_name = fact_file AND row_idx > header_row")
    columns = names([*c.SHEET_COLUMNS, c.FACILITY_COLUMN, c.RECEIVED_COLUMN])
    return sheet_rows(cells).join(facts, below_header).selectExpr(*columns)
