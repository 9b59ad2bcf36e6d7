"""Stream folders merged level by level: how many are read, replays, cut-off merges, key filters."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from finloom.operators.merge import insert_if_absent, insert_new_keys, last_per_key
from finloom.streaming import ingest, levels
from finloom.streaming.levels import Levels, Run

SCHEMA = "k string, day date, v int, n int"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def batch_of(spark, rng, number):
    made = [(f"k{rng.randrange(60)}", dt.date(2025, 3, 1 + rng.randrange(3)), rng.choice([None, number]), number) for _ in range(20)]
    return made, spark.createDataFrame(made, SCHEMA).coalesce(1)


@pytest.fixture(scope="module")
def forty(spark, tmp_path_factory):
    """Forty batches of revisions; what is current, and how many folders were read after each."""
    path, rng = str(tmp_path_factory.mktemp("levels")), random.Random(1)
    schema = spark.createDataFrame([], SCHEMA).schema
    keys, order = ["k", "day"], ["n"]
    store = Levels(spark, path, schema, keys, lambda r: last_per_key(r, keys, [*order, "batch_id"]), fanout=4, by=["day"])
    current, counts, last = {}, [], None
    for number in range(40):
        made, _ = batch_of(spark, rng, number)
        single = {(r[0], r[1]): r for r in made}
        last = spark.createDataFrame(list(single.values()), SCHEMA).coalesce(1)
        store.add(last, number)
        current |= single
        counts.append(len(store.runs()))
    return store, current, counts, last


def test_few_folders_are_read_after_any_number_of_batches(forty):
    store, current, counts, _ = forty
    # at most fanout - 1 folders on each of the levels that 40 batches fill
    assert max(counts) <= 3 * 3 and counts[15] == 1 and counts[39] <= 4
    assert rows(store.combine(store.rows()).drop("batch_id")) == Counter(current.values())


def test_a_replayed_batch_changes_nothing(forty):
    store, current, _, last = forty
    before = store.runs()
    for number in (39, 20, 0):
        store.add(last.withColumn("v", F.lit(-1)) if number < 39 else last, number)
    assert store.runs() == before
    assert rows(store.combine(store.rows()).drop("batch_id")) == Counter(current.values())


def test_a_merge_that_is_cut_off_does_not_count(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    store = Levels(spark, str(tmp_path), schema, ["k", "day"], lambda r: last_per_key(r, ["k", "day"], ["n", "batch_id"]), fanout=4)
    day = dt.date(2025, 3, 1)

    def batch(number):
        return spark.createDataFrame([("a", day, number, number), (f"k{number}", day, 0, number)], SCHEMA).coalesce(1)

    for number in range(3):
        store.add(batch(number), number)
    # a merge that wrote some of its files and no mark
    stray = batch(99).withColumns({"batch_id": F.lit(99).cast("long"), "bucket": F.lit(0)})
    stray.write.parquet(f"{tmp_path}/_merged/level=1/run=0-3/bucket=0")
    (tmp_path / "_merged/level=1/run=0-3/bucket=0/_SUCCESS").unlink()
    assert [r.level for r in store.runs()] == [0, 0, 0]
    store.add(batch(3), 3)
    assert store.runs() == [Run(0, 3, 1)]
    assert rows(store.combine(store.rows()).drop("batch_id")) == Counter([("a", day, 3, 3), *[(f"k{n}", day, 0, n) for n in range(4)]])


def test_covered_folders_go_one_merge_later(forty):
    store, *_ = forty
    kept, covered = store._counted()
    assert len(covered) <= 2 * store.fanout and not set(kept) & set(covered)


def test_a_day_is_read_from_its_partitions_alone(spark, forty):
    store, current, *_ = forty
    day = dt.date(2025, 3, 2)
    merged = [r for r in store.runs() if r.level]
    one = store.rows(merged).where(F.col("day") == day)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    found = store.combine(store.rows()).where(F.col("day") == day).drop("batch_id")
    assert rows(found) == Counter(r for r in current.values() if r[1] == day)


def unseen_store(spark, path):
    return Levels(spark, path, spark.createDataFrame([], "url string, n int").schema, ["url"], filtered=True, fanout=4)


def test_folders_whose_filter_excludes_the_batch_stay_closed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(levels, "BUCKET_ROWS", 100)
    store = unseen_store(spark, str(tmp_path))
    for number in range(8):
        store.add(spark.range(500).select(F.concat(F.lit(f"b{number}-"), "id").alias("url"), F.col("id").cast("int").alias("n")), number)
    runs = store.runs()
    assert [(r.first, r.last) for r in runs] == [(0, 3), (4, 7)]
    new = spark.createDataFrame([(f"new-{k}", k) for k in range(200)], "url string, n int")
    assert store.may_hold(new, runs) == {}
    asked = spark.createDataFrame([("b4-77", 1), ("b4-77", 2), ("new", 1)], "url string, n int")
    hits = store.may_hold(asked, runs)
    assert list(hits) == [runs[1]] and len(hits[runs[1]]) == 1
    opened = store.rows(list(hits), hits).inputFiles()
    assert opened and all(f"run=4-7/bucket={hits[runs[1]][0]}/" in f for f in opened)
    whole = store.rows().drop("batch_id")
    assert rows(insert_new_keys(store.rows(list(hits), hits), asked, ["url"])) == rows(insert_if_absent(whole, asked, ["url"])) == Counter([("new", 1)])
    assert store.may_hold(asked.limit(0), runs) == store.may_hold(asked, []) == {}


def test_filters_hold_all_their_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(levels, "BUCKET_ROWS", 50)
    store = unseen_store(spark, str(tmp_path))
    made = spark.range(3000).select(F.when(F.col("id") % 100 > 0, F.concat(F.lit("u"), "id")).alias("url"), F.lit(1).alias("n"))
    for number in range(4):
        store.add(made.where(F.pmod(F.hash("url"), F.lit(4)) == number), number)
    (run,) = store.runs()
    buckets = {r.bucket for r in store.spark.read.parquet(f"{tmp_path}/_merged/level=1/run=0-3").select("bucket").distinct().collect()}
    assert set(store.may_hold(made, [run])[run]) == buckets and len(buckets) > 30


def test_unseen_rows_over_merged_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], "url string, n int").schema
    rng, seen, want = random.Random(2), set(), []
    for number in range(10):
        made = [(rng.choice([None, *[f"u{k}" for k in range(40)]]), number) for _ in range(12)]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(source)
        ingest.ingest_unseen(ingest.file_stream(spark, source, schema, files_per_batch=1), ["url"], out, str(tmp_path / "cp"))
        want += [r for r in set(made) if r[0] is None or r[0] not in seen]
        seen |= {u for u, _ in made}
    assert rows(ingest.stored_rows(spark, out, schema)) == Counter(want)
    assert len(Levels(spark, out, schema, ()).runs()) <= 3
