"""Loads into a table bucketed by key."""

import re
import uuid
from collections import Counter

import pytest

from finloom.operators import merge
from finloom.sources import writers


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def stored(spark, tmp_path):
    name = f"bucketed_{uuid.uuid4().hex}"
    schema = spark.createDataFrame([], "url string, n int, day string").schema
    writers.create_table(spark, name, schema, str(tmp_path), ["day"], 8, ["url"])
    first = spark.createDataFrame([(f"u{k}", k, f"d{k % 3}") for k in range(50)] + [("u1", 1, "d1"), (None, 0, "d0")], schema)
    writers.append_new_keys(first, name, ["url"], 8)
    return name, schema


def test_only_new_keys_are_added(spark, stored):
    name, schema = stored
    assert spark.table(name).count() == 51
    batch = [("u1", 9, "d9"), ("new", 1, "d1"), ("new", 2, "d2"), ("new", 1, "d1"), (None, 7, "d0")]
    before = rows(spark.table(name))
    writers.append_new_keys(spark.createDataFrame(batch, schema), name, ["url"], 8)
    assert rows(spark.table(name)) - before == Counter([("new", 1, "d1"), ("new", 2, "d2"), (None, 7, "d0")])
    writers.append_new_keys(spark.createDataFrame([], schema), name, ["url"], 8)
    assert spark.table(name).count() == 54


def test_the_target_is_not_shuffled(spark, stored):
    name, schema = stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch = spark.createDataFrame([(f"u{k}", k, "d") for k in range(60)], schema)
        asked = batch.select("url").distinct().join(spark.table(name).select("url"), ["url"], "left_anti")
        plan = asked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scan = next(k for k, line in enumerate(lines) if "FileScan" in line)
    depth = re.search(r"[A-Za-z]", lines[scan]).start()
    above, own = [], depth
    for line in reversed(lines[:scan]):  # the operators above the target's scan
        at = re.search(r"[A-Za-z]", line).start()
        if at < own:
            above.append(line)
            own = at
    join = next(k for k, line in enumerate(above) if "Join" in line)
    assert join >= 0 and not any("Exchange" in line for line in above[:join]) and "Bucketed: true" in lines[scan]
    assert plan.count("Exchange hashpartitioning(url") <= 2  # the batch's keys


def test_new_keys_are_those_of_the_plain_insert(spark, stored):
    name, schema = stored
    batch = spark.createDataFrame([(f"u{k}", k % 4, "d") for k in range(30, 90)] * 2, schema)
    got = merge.insert_new_keys(spark.table(name), batch, ["url"])
    assert rows(got) == rows(merge.insert_if_absent(spark.table(name), batch, ["url"]))
