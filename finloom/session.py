"""Session settings and the shared scratch area."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "finloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared folder named by spark.checkpoint.dir.

    Only a local session may fall back to a folder of this machine; on a cluster every
    executor has to see the same files, so an unset folder is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="finloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/finloom/{name}-{uuid.uuid4().hex}"
    for made in _scopes:
        made.append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """Collects the scratch folders named meanwhile, for release once nothing reads them any more."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes[:] = [s for s in _scopes if s is not made]


def release(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete scratch folders, and the shuffle files of plans that nothing refers to."""
    for folder in folders:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Spark drops a shuffle's files when the driver collects its plan; have it do so now."""
    gc.collect()
    spark._jvm.System.gc()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    Cuts the lineage, keeps column pruning for the next step, and survives lost executors.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
