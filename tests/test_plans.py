"""What reaches the scans."""

import datetime as dt

from pyspark.sql import functions as F

from finloom.catalog import QUERIES
from finloom.functions.dates import day_bounds, recent_hours
from finloom.operators.markup import page_rows
from finloom.plans.calendar import EVENT_RULES, parsed_events, split_events

SF = "/root/testdata/sf0.01"


def scan_of(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_time_windows_are_pushed(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    for predicate in (
        day_bounds(F.col("ts"), dt.date(2024, 1, 16)),
        recent_hours(F.col("ts"), dt.datetime(2024, 1, 16, 15, 30), 10, "America/New_York"),
    ):
        (scan,) = scan_of(events.where(predicate).select("event_id"))
        pushed = scan.split("PushedFilters: [")[1].split("]")[0]
        assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
        assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in scan


def test_only_needed_columns_are_read(spark):
    scans = " ".join(scan_of(QUERIES["replace_by_keys"](spark, SF)))
    assert "struct<l_orderkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>" in scans
    (scan,) = scan_of(QUERIES["latest_per_partition"](spark, SF))
    assert "props" not in scan


def test_pages_are_parsed_once(spark):
    pages = spark.createDataFrame([("u", "<p>")], "url string, content string")
    events = split_events(parsed_events(pages, F.lit(dt.date(2025, 1, 1))))[0].where("volatility > 0")
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EvalPython") == 1
    rows = pages.select(page_rows(F.col("content"), EVENT_RULES).alias("r")).where("size(r) > 0")
    assert rows._jdf.queryExecution().executedPlan().toString().count("EvalPython") == 1


def test_latest_row_is_combined_before_the_shuffle(spark):
    plan = QUERIES["latest_per_partition"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan.split("Exchange")[1] and "Window" not in plan
