"""What the operators of this folder share: the shared folder for intermediate tables, names and small expressions."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BROADCAST_ROWS = 500_000
ARROW_TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
}
#: Words are what lies between these characters.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; on a cluster that is an error, since the
    executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="loadtrail-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def landed(frame: DataFrame, label: str) -> DataFrame:
    """Write the frame as Parquet to the shared folder and read it back: lineage ends there."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512, size: int = 8 << 20) -> Iterator[None]:
    """Within it, jobs hand so many rows or bytes at a time to Python: for rows of some kilobytes each."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {key: spark.conf.get(key) for key in limits}
    for key, limit in limits.items():
        spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def on_workers(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package from where it lies."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def joined_by_size(frame: DataFrame, weight: int) -> DataFrame:
    """The landed frame, hinted for a broadcast join if its ``weight`` in rows is small.

    For tables of a few numbers a row: BROADCAST_ROWS of them take some 30 MB. Larger ones are joined by a shuffle.
    """
    return F.broadcast(frame) if weight <= BROADCAST_ROWS else frame


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of ``name type, name type, ...``."""
    return pa.schema([(name, ARROW_TYPES[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def column_batch(columns: Sequence, ddl: str) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def row_batch(rows: Sequence[tuple], ddl: str) -> pa.RecordBatch:
    return column_batch(list(zip(*rows)) if rows else [()] * len(ddl.split(", ")), ddl)


def signed(number: int) -> int:
    """An unsigned 64-bit number as Spark's long."""
    return number - (1 << 64) if number >> 63 else number


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def word_array(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]
