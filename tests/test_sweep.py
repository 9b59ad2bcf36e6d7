"""Folders of replaced versions go, what a table reads stays."""

import datetime as dt
import os
import uuid
from collections import Counter

import pytest

from finloom.operators import merge
from finloom.plans import jobs
from finloom.plans.jobs import Store
from finloom.sources import sweep

AS_OF = dt.datetime(2025, 3, 1, 12)


@pytest.fixture
def store(spark, tmp_path):
    name = f"sweep_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield Store(spark, str(tmp_path), name)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_unread_versions_go(spark, store):
    schema = spark.createDataFrame([], "k int, note string, day string").schema
    replace = lambda stored, new: merge.replace_by_keys(stored, new, ["k"])
    loads = [[(1, "x", "a b"), (2, "x", "c")], [(1, "y", "a b")], [(1, "z", "a b"), (3, "z", None)]]
    for n, rows in enumerate(loads):
        store.merge("t", schema, ["day"], spark.createDataFrame(rows, schema), replace, AS_OF + dt.timedelta(days=n))
        store.publish(spark.createDataFrame(rows, schema), "whole", AS_OF + dt.timedelta(days=n))
    before = {t: Counter(tuple(r) for r in spark.table(store.name(t)).collect()) for t in ("t", "whole")}
    assert sweep.sweep_versions(spark, store.base, store.database, AS_OF) == []
    gone = sweep.sweep_versions(spark, store.base, store.database, AS_OF + dt.timedelta(days=9))
    # of the first load the day that the later ones replaced, of the second one all, and two whole tables
    assert len(gone) == 4 and not any(os.path.exists(g.removeprefix("file:")) for g in gone)
    for t, rows in before.items():
        spark.catalog.refreshTable(store.name(t))
        assert Counter(tuple(r) for r in spark.table(store.name(t)).collect()) == rows
    assert sweep.sweep_versions(spark, store.base, store.database, AS_OF + dt.timedelta(days=9)) == []


def test_recent_versions_and_unknown_folders_stay(spark, store, tmp_path):
    schema = spark.createDataFrame([], "k int").schema
    for n in range(2):
        store.publish(spark.createDataFrame([(n,)], schema), "t", AS_OF + dt.timedelta(days=5 * n))
    (tmp_path / "TABLES/other/20200101T000000-ab").mkdir(parents=True)
    (tmp_path / "TABLES/t/unstamped").mkdir()
    assert jobs.sweep.sweep_versions(spark, store.base, store.database, AS_OF - dt.timedelta(days=1)) == []
    assert len(sweep.sweep_versions(spark, store.base, store.database, AS_OF + dt.timedelta(days=1))) == 1
    assert (tmp_path / "TABLES/other/20200101T000000-ab").exists() and (tmp_path / "TABLES/t/unstamped").exists()


def test_scratch_of_ended_runs_goes(spark, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir")
    old, new = (f"{base}/finloom/{name}-{uuid.uuid4().hex}" for name in ("old", "new"))
    for path in (old, new):
        os.makedirs(path)
    os.utime(old, (1, 1))
    gone = sweep.sweep_scratch(spark, dt.datetime(2000, 1, 1))
    assert [g.removeprefix("file:") for g in gone] == [old] and not os.path.exists(old) and os.path.exists(new)
