"""What writes observe, and which folders the jobs touch."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.operators import merge
from finloom.plans import jobs
from finloom.plans.jobs import Store
from finloom.schemas import EARNINGS
from finloom.sources import writers

AS_OF = dt.datetime(2025, 3, 25, 12, 10)


@pytest.fixture
def store(spark, tmp_path):
    name = f"metrics_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield Store(spark, str(tmp_path), name)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def replace(stored, new):
    return merge.replace_by_keys(stored, new, ["k"])


def test_sizes_follow_the_writes_without_counting(spark, store, monkeypatch):
    schema = spark.createDataFrame([], "k int, t string, day string").schema
    first = spark.createDataFrame([(1, "ab", "a"), (2, None, "a"), (3, "é", "b")], schema)
    second = spark.createDataFrame([(1, "longer", "a"), (9, "x", None)], schema)
    assert store.merge("t", schema, ["day"], first, replace, AS_OF, "load_t") == 3

    def counted(self):
        raise AssertionError("counts a frame")

    monkeypatch.setattr(DataFrame, "count", counted)
    assert store.merge("t", schema, ["day"], second, replace, AS_OF + dt.timedelta(hours=1), "load_t") == 4
    assert store.merge("t", schema, ["day"], second.limit(0), replace, AS_OF, "load_t") == 4
    monkeypatch.undo()
    assert spark.table(store.name("t")).count() == 4
    latest = {r.part: (r.rows, r.characters, r.seq) for r in store.metrics.latest().collect()}
    assert latest == {"day=a": (2, 6 + 2, 2), "day=b": (1, 1 + 1, 1), "day=None": (1, 1, 2)}
    assert {(r.job, r.as_of) for r in store.metrics.rows().collect()} == {("load_t", AS_OF), ("load_t", AS_OF + dt.timedelta(hours=1))}


def test_a_table_from_before_the_metrics_is_counted_once(spark, store):
    schema = spark.createDataFrame([], "k int, day string").schema
    path = f"{store.base}/TABLES/old/rows"
    writers.create_table(spark, store.name("old"), schema, path, ["day"])
    writers.append_rows(spark.createDataFrame([(k, "ab"[k % 2]) for k in range(10)], schema), store.name("old"))
    assert store.merge("old", schema, ["day"], spark.createDataFrame([(1, "b"), (77, "b")], schema), replace, AS_OF) == 11
    assert store.total("old", ["day"], AS_OF) == 11 == spark.table(store.name("old")).count()


def test_members_of_other_buckets_stay_where_they_are(spark, store):
    def bodies(*members):
        return spark.createDataFrame([(json.dumps({"responseId": k, "timestamp": f"2025-03-25T0{n}:00:00.000Z", "email": f"{k}{n}@x"}),) for k, n in members], "body string")

    assert jobs.register_members(store, bodies(*[(f"m{k}", 1) for k in range(40)], (None, 1)), AS_OF) == 40
    table = spark.table(store.name("members"))
    places = {r.bucket: r.p for r in table.select("bucket", F.regexp_extract("_metadata.file_path", "(.*)/", 1).alias("p")).distinct().collect()}
    assert jobs.register_members(store, bodies(("m7", 3), ("m7", 2)), AS_OF) == 40
    table = spark.table(store.name("members"))
    now = {r.bucket: r.p for r in table.select("bucket", F.regexp_extract("_metadata.file_path", "(.*)/", 1).alias("p")).distinct().collect()}
    (own,) = {r.bucket for r in table.where("response_id = 'm7'").collect()}
    assert {b for b in now if now[b] != places[b]} == {own}
    assert [r.email_address for r in table.where("response_id = 'm7'").collect()] == ["m73@x"]


def test_a_days_earnings_are_read_from_its_period(spark, store):
    rows = []
    for year in (2024, 2025):
        for quarter in range(1, 5):
            rows.append((f"e{year}{quarter}", "c", dt.datetime(year, 3 * quarter, 9)))
    frame = spark.createDataFrame(rows, "earning_id string, company_id string, call_date timestamp_ntz")
    period = jobs.surrogate_key(F.year("call_date"), F.quarter("call_date"))
    name = store.name("earnings")
    writers.create_table(spark, name, EARNINGS, f"{store.base}/TABLES/earnings/rows", ["period_id"])
    writers.append_rows(jobs.align(frame.withColumn("period_id", period), EARNINGS), name)
    day = dt.date(2025, 6, 9)
    one = spark.table(name).where(F.col("period_id") == jobs.period_of(day))
    assert [r.earning_id for r in one.collect()] == ["e20252"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(1 paths)" in plan and "PartitionFilters: [isnotnull(period_id" in plan
