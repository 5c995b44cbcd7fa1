"""The landed table of request days, extended by the log of one or more days at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadtrail.operators.requests import merged_request_days, request_days
from loadtrail.sinks.report_set import PublishConflict, current_version, publish_version, read_version, table_names

TABLE = "request days"
ATTEMPTS = 5


def read_request_days(spark: SparkSession, folder: str) -> DataFrame:
    """The current version in the folder, or the folder itself if it is a plain Parquet table."""
    if TABLE in table_names(spark, folder):
        return read_version(spark, folder, TABLE, current_version(spark, folder, TABLE))
    return spark.read.parquet(folder)


def extend_request_days(log: DataFrame, folder: str) -> DataFrame:
    """Merge the log of some days, whole days or parts of them, into the table; returns the new version.

    Days are sets, so a day merged twice changes nothing, and days may come in any order. The new version counts
    only if the version it was made from is still the current one; if another writer was faster, the merge runs
    again on that writer's version.
    """
    spark = log.sparkSession
    for attempt in range(ATTEMPTS):
        base = current_version(spark, folder, TABLE)
        found = request_days(log)
        merged = merged_request_days(read_version(spark, folder, TABLE, base), found) if base.folder else found
        try:
            return read_version(spark, folder, TABLE, publish_version(merged, folder, TABLE, base))
        except PublishConflict:
            if attempt + 1 == ATTEMPTS:
                raise
    raise AssertionError("not reached")
