"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that all executors share, named by `spark.checkpoint.dir`.

    Without it, a session of one machine gets a temporary folder; on a cluster that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/loadtrail-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="loadtrail-")


def landed(rows: DataFrame, label: str) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them back: what made them is not run again."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def sorted_by_ranges(landed_rows: DataFrame, keys: list[str], rows_per_part: int) -> DataFrame:
    """Landed rows in the order of the keys (SQL expressions, nulls last), in parts of about `rows_per_part`.

    The ranges are found by a look at the rows, so they must not be computed again for it. A random last key cuts
    rows that are equal in all others: one key for all rows still gives even parts. Within a part the keys alone count.
    """
    parts = max(1, -(-landed_rows.count() // rows_per_part))
    order = [F.expr(key).asc_nulls_last() for key in keys]
    dealt = landed_rows.withColumn("range_tie", F.rand(7)).repartitionByRange(parts, *order, "range_tie")
    return dealt.sortWithinPartitions(*order).drop("range_tie")


def numbered_by_ranges(rows: DataFrame, key: str, rows_per_range: int) -> DataFrame:
    """Add `number`, dense from 0 in the order of a key without repetitions; nothing passes one task whole.

    Ranges of the key are numbered on their own and start where the ranges before them end. The table of
    starts has one row per range.
    """
    found = landed(rows, "rows-to-number")
    ranges = max(1, -(-found.count() // rows_per_range))
    dealt = found.repartitionByRange(ranges, key).withColumn("key_range", F.spark_partition_id())
    dealt = landed(dealt, "key-ranges")  # the same ranges for counts and rows
    before = "sum(count) OVER (ORDER BY key_range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    starts = dealt.groupBy("key_range").count().selectExpr("key_range", f"coalesce({before}, 0L) AS range_start")
    within = f"row_number() OVER (PARTITION BY key_range ORDER BY {key}) - 1"
    return (
        dealt.selectExpr("*", f"{within} AS range_place")
        .join(starts, "key_range")
        .withColumn("number", F.expr("range_start + range_place"))
        .drop("key_range", "range_start", "range_place")
    )
