"""Streams over several batches equal the batch result; a rerun adds nothing."""

from collections import Counter

from pyspark.sql import functions as F

from finloom.streaming import ingest


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_unseen_over_batches_and_runs(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    make = lambda *r: spark.createDataFrame(list(r), "url string, author string")
    run = lambda: ingest.ingest_unseen(
        ingest.file_stream(spark, source, make(("", "")).schema, files_per_batch=1), ["url"], f"{out}/rows", f"{out}/cp"
    )
    make(("u1", "a"), ("u1", "b"), ("u1", "a")).coalesce(1).write.parquet(f"{source}", mode="append")
    run()
    make(("u1", "late"), ("u2", "a")).coalesce(1).write.parquet(f"{source}", mode="append")
    run()
    run()
    stored = ingest.stored_rows(spark, f"{out}/rows", make(("", "")).schema)
    assert rows(stored) == Counter([("u1", "a"), ("u1", "b"), ("u2", "a")])


def test_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "rows")
    schema = spark.createDataFrame([("", 0, 0)], "k string, v int, n int").schema
    for batch, data in ((0, [("a", 1, 1)]), (1, [("a", 2, 1), ("b", 1, 1)]), (1, [("a", 2, 1), ("b", 1, 1)])):
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{path}/batch_id={batch}")
    assert ingest.stored_rows(spark, path, schema).count() == 3
    current = ingest.current_rows(spark, path, schema, ["k"])
    assert rows(current) == Counter([("a", 2, 1), ("b", 1, 1)])


def test_revisions_latest_wins_with_null(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([("", 0, 0)], "k string, v int, n int").schema
    for data in ([("a", 1, 1), ("b", 1, 1)], [("a", None, 3), ("a", 2, 2)], [("c", 1, 1)]):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)
    stream = ingest.file_stream(spark, source, schema, files_per_batch=1)
    ingest.ingest_revisions(stream, ["k"], ["n"], f"{out}/rows", f"{out}/cp")
    current = ingest.current_rows(spark, f"{out}/rows", schema, ["k"], ["n"])
    assert rows(current) == Counter([("a", None, 3), ("b", 1, 1), ("c", 1, 1)])


def test_empty_store(spark, tmp_path):
    schema = spark.range(1).withColumn("v", F.lit(1)).schema
    assert ingest.stored_rows(spark, str(tmp_path / "nothing"), schema).count() == 0
