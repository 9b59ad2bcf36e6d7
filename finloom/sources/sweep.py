"""Mark and sweep: folders that a store has written and that nothing names any more.

Marked are the folders from which the catalog's tables read, and their partitions. Swept are
version folders, and partition folders in them, that are unmarked and older than a given moment,
so that who still reads an earlier version can finish.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STAMP = re.compile(r"^(\d{8}T\d{6})-[0-9a-f]+$")


def _folders(spark: SparkSession, path: str) -> Iterator[tuple[str, str, int]]:
    """(path, name, milliseconds of the last change) of the folders directly under path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*")) or []:
        if status.isDirectory():
            yield status.getPath().toString(), status.getPath().getName(), status.getModificationTime()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _plain(path: str) -> str:
    """A path without its scheme, so that file:/a and file:///a are one."""
    return re.sub(r"^[a-z]+:(?://[^/]*)?", "", path).rstrip("/")


def live_folders(table: DataFrame) -> set[str]:
    """Folders that hold files of a table as the catalog knows it now."""
    place = F.regexp_replace("_metadata.file_path", "/[^/]+$", "")
    return {_plain(r["p"]) for r in table.select(F.url_decode(F.replace(place, F.lit("+"), F.lit("%2B"))).alias("p")).distinct().collect()}


def sweep_versions(spark: SparkSession, base: str, database: str, before: dt.datetime) -> list[str]:
    """Delete version folders under base/TABLES from before a moment that no table reads; returns them.

    A folder's age is the stamp in its name, the moment its job ran for. Folders of tables that the
    catalog does not know, and folders without a stamp, stay."""
    gone = []
    for place, table, _ in _folders(spark, f"{base}/TABLES"):
        if not spark.catalog.tableExists(f"{database}.{table}"):
            continue
        spark.catalog.refreshTable(f"{database}.{table}")
        live = live_folders(spark.table(f"{database}.{table}"))
        for version, name, _ in _folders(spark, place):
            stamp = _STAMP.match(name)
            if not stamp or dt.datetime.strptime(stamp[1], "%Y%m%dT%H%M%S") >= before:
                continue
            inside = _plain(version)
            if not any(f == inside or f.startswith(inside + "/") for f in live):
                gone.append(version)
                continue
            for part, part_name, _ in _folders(spark, version):
                own = _plain(part)
                if "=" in part_name and not any(f == own or f.startswith(own + "/") for f in live):
                    gone.append(part)
    for folder in gone:
        _delete(spark, folder)
    return gone


def sweep_scratch(spark: SparkSession, before: dt.datetime) -> list[str]:
    """Delete scratch folders that were last changed before a moment (UTC), left by runs that have ended."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        return []
    limit = before.replace(tzinfo=dt.timezone.utc).timestamp() * 1000
    gone = [path for path, _, changed in _folders(spark, f"{base.rstrip('/')}/finloom") if changed < limit]
    for folder in gone:
        _delete(spark, folder)
    return gone
