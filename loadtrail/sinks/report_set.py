"""A report set: a folder with one Parquet table per report, replaced one table at a time.

Every version of a table is a folder of its own, `<table>/version-<number>-<id>`, and counts once the marker
`current-<number>` names it. A marker is a small file that must not exist before: of two writers that started from
the same version one creates it, the other fails with `PublishConflict` and leaves nothing behind, so no version is
lost in silence. Nothing is renamed, and the version before stays readable. The switch is as atomic as the store's
way of creating a file that must not exist.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from loadtrail import constants as c

VERSION, MARKER = "version-", "current-"
#: How long a marker may stay empty while its writer is at work; after that the writer is taken for dead.
MARKER_SECONDS = 5.0


class PublishConflict(RuntimeError):
    """Another writer has published a version in the meantime."""


@dataclass(frozen=True)
class Version:
    """What a writer has seen: the highest number taken, and the folder in force (none before the first)."""

    number: int
    folder: str | None


def _path(spark: SparkSession, parent: str, *children: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(parent)
    for child in children:
        path = spark._jvm.org.apache.hadoop.fs.Path(path, child)
    return path


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path) -> list[str]:
    files = _files(spark, path)
    return sorted(entry.getPath().getName() for entry in files.listStatus(path)) if files.exists(path) else []


def _read_marker(spark: SparkSession, path) -> str:
    stream = _files(spark, path).open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _markers(spark: SparkSession, report_set: str, table: str) -> list[Version]:
    """All markers by number; one without a name yet has no folder."""
    names = _children(spark, _path(spark, report_set, table))
    return [
        Version(int(name.removeprefix(MARKER)), _read_marker(spark, _path(spark, report_set, table, name)) or None)
        for name in names
        if name.startswith(MARKER)
    ]


def _versions(spark: SparkSession, report_set: str, table: str) -> list[Version]:
    """Published versions, the current one last; numbers have a fixed width."""
    return [marker for marker in _markers(spark, report_set, table) if marker.folder]


def current_version(spark: SparkSession, report_set: str, table: str) -> Version:
    """The version in force, to build the next one from; waits for a switch that is under way."""
    waited = time.monotonic()
    while True:
        markers = _markers(spark, report_set, table)
        if not markers or markers[-1].folder or time.monotonic() - waited > MARKER_SECONDS:
            break
        time.sleep(0.1)
    folders = [marker.folder for marker in markers if marker.folder]
    return Version(markers[-1].number if markers else 0, folders[-1] if folders else None)


def read_version(spark: SparkSession, report_set: str, table: str, version: Version) -> DataFrame:
    if not version.folder:
        raise FileNotFoundError(f"no table {table} in {report_set}")
    return spark.read.parquet(_path(spark, report_set, table, version.folder).toString())


def table_names(spark: SparkSession, report_set: str) -> list[str]:
    names = _children(spark, _path(spark, report_set))
    return [name for name in names if not name.startswith("_") and _versions(spark, report_set, name)]


def read_table(spark: SparkSession, report_set: str, table: str) -> DataFrame:
    versions = _versions(spark, report_set, table)
    return read_version(spark, report_set, table, versions[-1] if versions else Version(0, None))


def publish_table(table_rows: DataFrame, report_set: str, table: str = c.MASTER_TABLE, target: str | None = None) -> None:
    """Replace one table of the set and leave the others untouched.

    With `target`, the set stays as it is and the result, other tables included, goes to `target`.
    The rows may be derived from the table they replace. A job that fails before its last step leaves the old
    table standing; so does a failed switch.
    """
    spark = table_rows.sparkSession
    if target is not None and target != report_set:
        for other in table_names(spark, report_set):
            if other != table:
                _replace(read_table(spark, report_set, other), target, other)
    _replace(table_rows, target or report_set, table)


def publish_version(table_rows: DataFrame, report_set: str, table: str, base: Version) -> Version:
    """Publish the rows as the version after `base`, or fail if that is no longer the last one."""
    spark = table_rows.sparkSession
    before = _versions(spark, report_set, table)
    version = Version(base.number + 1, f"{VERSION}{base.number + 1:010d}-{uuid.uuid4().hex}")
    folder = _path(spark, report_set, table, version.folder)
    table_rows.write.parquet(folder.toString())
    try:
        _switch(spark, report_set, table, version)
    except PublishConflict:
        _files(spark, folder).delete(folder, True)
        raise
    for old in before[:-1]:  # the one before stays for readers that have begun
        _clean(spark, report_set, table, old)
    return version


def _replace(table_rows: DataFrame, report_set: str, table: str) -> None:
    publish_version(table_rows, report_set, table, current_version(table_rows.sparkSession, report_set, table))


def _marker(spark: SparkSession, report_set: str, table: str, version: Version):
    return _path(spark, report_set, table, f"{MARKER}{version.number:010d}")


def _switch(spark: SparkSession, report_set: str, table: str, version: Version) -> None:
    """Create the marker, which must not exist."""
    marker = _marker(spark, report_set, table, version)
    try:
        stream = _files(spark, marker).create(marker, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            raise PublishConflict(f"{table} in {report_set}: version {version.number} is taken") from error
        raise
    try:
        stream.write(version.folder.encode())
    finally:
        stream.close()


def _clean(spark: SparkSession, report_set: str, table: str, version: Version) -> None:
    """Take a version out: first what names it, then its files."""
    for path in (_marker(spark, report_set, table, version), _path(spark, report_set, table, version.folder)):
        _files(spark, path).delete(path, True)
