"""Incremental jobs over arriving files.

Each micro-batch writes one `batch_id` folder in overwrite mode, so a repeated batch
replaces its own output and nothing is written twice. Folders are merged level by level
(`levels.py`): a row is rewritten once a level, and a reader opens a few folders a level.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from finloom.operators.merge import insert_new_keys, last_per_key
from finloom.session import materialize
from finloom.streaming.levels import Levels


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(kind)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Work off everything that has arrived, then stop."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _unseen_store(spark: SparkSession, keys: Sequence[str], path: str, schema: T.StructType) -> Levels:
    return Levels(spark, path, schema, keys, filtered=True)


def ingest_unseen(stream: DataFrame, keys: Sequence[str], path: str, checkpoint: str) -> None:
    """Append the distinct rows whose key was in no earlier batch; rows with a NULL key always.

    Of earlier folders, merged level by level, only the buckets whose key filter lets a key of
    the batch through are opened, and the few newest batches.
    """
    schema = stream.schema

    def each(batch: DataFrame, batch_id: int) -> None:
        store = _unseen_store(batch.sparkSession, keys, path, schema)
        if not store.has_merged(batch_id):
            batch = materialize(batch.distinct(), "arrived")  # read more than once below
            runs = [r for r in store.runs() if r.last < batch_id]
            hits = store.may_hold(batch, [r for r in runs if r.level])
            opened = [r for r in runs if r in hits or not r.level]
            store.add(insert_new_keys(store.rows(opened, hits), batch, keys) if opened else batch, batch_id)

    run_available(stream, each, checkpoint)


def ingest_first_seen(
    stream: DataFrame, keys: Sequence[str], event_time: str, lateness: str, path: str, checkpoint: str
) -> None:
    """Append one row per key with bounded state: a key may come back after `lateness`.

    The keys seen are kept by RocksDB on the executors' disks, with changes alone written to the
    checkpoint, so they need not fit in memory.
    """
    conf = stream.sparkSession.conf
    conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    unique = stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(keys))
    query = (
        unique.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _revision_store(
    spark: SparkSession, keys: Sequence[str], order: Sequence[str], path: str, schema: T.StructType, by: Sequence[str] = ()
) -> Levels:
    return Levels(spark, path, schema, keys, lambda rows: last_per_key(rows, keys, [*order, "batch_id"]), by=by)


def ingest_revisions(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, checkpoint: str, by: Sequence[str] = ()
) -> None:
    """Upsert each batch's latest row per key: batch folders are merged per key, level by level.

    `by` are key columns, such as a day, by which merged folders are partitioned.
    """
    schema = stream.schema

    def each(batch: DataFrame, batch_id: int) -> None:
        store = _revision_store(batch.sparkSession, keys, order, path, schema, by)
        if not store.has_merged(batch_id):
            store.add(last_per_key(batch, keys, order), batch_id)

    run_available(stream, each, checkpoint)


def stored_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows that the stream under path has stored."""
    return Levels(spark, path, schema, ()).rows().drop("batch_id")


def current_rows(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """The latest stored row per key, by `order` and then by arrival."""
    store = _revision_store(spark, keys, order, path, schema)
    return store.combine(store.rows()).drop("batch_id")
