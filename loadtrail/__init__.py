"""Workflow-audit reporting on Spark: correlate, classify, enrich and publish."""

from loadtrail.params import ReportParams

__all__ = ["ReportParams"]
