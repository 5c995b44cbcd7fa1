"""Names of report outputs."""

from __future__ import annotations

from loadtrail.functions.timestamps import date_label
from loadtrail.params import ReportParams


def report_label(params: ReportParams) -> str:
    """SQL text of `<first day>_<last day><year of the first day>`, as report names carry it."""
    start, end = f"DATE'{params.start}'", f"DATE'{params.end}'"
    return f"concat({date_label(start)}, '_', {date_label(end)}, '{params.start.year}')"
