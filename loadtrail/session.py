"""Session settings for running the reports on a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where the step above it then needs a shuffle of its own
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # start wide; adaptive execution merges small shuffle partitions afterwards, but keeps every core busy:
    # a few input bytes of the trigger-response join can make many rows
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # let the ids of a report range prune the history scan before it is shuffled
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
}


def build_session(app_name: str = "loadtrail", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` overrides, with `__` written for `.` in keys."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in extra.items()}
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
