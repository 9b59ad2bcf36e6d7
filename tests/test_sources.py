"""Stored layouts: folders, envelopes, texts, table versions."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from finloom.schemas import EARNING_RECORD, THEMES, row, theme_table, TEXT
from finloom.session import scratch_dir
from finloom.sources import readers, writers
from finloom.operators.project import align, cast_columns


DAYS = [("02", 28), *[("03", d) for d in range(1, 22)]]


def land(base, theme, day, name, page):
    folder = base / theme / f"year=2025/month=03/day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(page, indent=4))


def test_themed_pages(spark, tmp_path):
    page = {"url": "https://x/a-b.html", "timestamp": "2025-03-25T01:02:03", "content": "<p>\n</p>"}
    land(tmp_path, "TECH", "05", "a_b.json", page)
    land(tmp_path, "TECH", "05", "note.txt", page)
    land(tmp_path, "LATEST", "06", "a_b.json", page | {"content": None})
    pages = readers.themed_pages(spark, str(tmp_path))
    assert {(r.theme, r.month, r.day, r.content) for r in pages.collect()} == {
        ("Tech", "03", "05", "<p>\n</p>"), ("Latest", "03", "06", None),
    }
    one_day = readers.themed_pages(spark, str(tmp_path), days=[dt.date(2025, 3, 5)])
    assert [r.theme for r in one_day.collect()] == ["Tech"]
    hourly = readers.themed_pages(spark, str(tmp_path), readers.themes_for_hour(10))
    assert [r.theme for r in hourly.collect()] == ["Latest"]
    assert readers.themed_pages(spark, str(tmp_path / "none")).count() == 0
    assert readers.themes_for_hour(7) == readers.themes_for_hour(21) == THEMES


def test_a_page_of_any_length_is_read(spark, tmp_path):
    long = 20_000_001  # Spark reads JSON texts of up to 20,000,000 characters unless told otherwise
    land(tmp_path, "EVENTS", "05", "day.json", {"url": "u", "timestamp": "2025-03-05T00:00:00", "content": "x" * long})
    pages = readers.calendar_pages(spark, str(tmp_path / "EVENTS"), [dt.date(2025, 3, 5)])
    assert [r.n for r in pages.select(F.length("content").alias("n")).collect()] == [long]


def test_day_window_prunes_folders(spark, tmp_path):
    df = spark.range(40).select(F.date_add(F.lit(dt.date(2025, 2, 10)), F.col("id").cast("int")).alias("d"), "id")
    writers.write_partitions(writers.with_day_columns(df, F.col("d")), str(tmp_path / "t"))
    stored = readers.day_folders(spark, str(tmp_path / "t"), df.schema)
    window = stored.where(readers.in_day_window(dt.date(2025, 3, 1)))
    assert sorted(str(r.d) for r in window.collect()) == ["2025-02-28", "2025-03-01", "2025-03-02"]
    listed = readers.day_folders(
        spark, str(tmp_path / "t"), df.schema, days=readers.window_days(dt.date(2025, 3, 1), 1, 200)
    )
    assert {f.split("/month=")[1][:9] for f in listed.inputFiles()} == {f"{m}/day={d:02}" for m, d in DAYS}
    assert sorted(r.id for r in listed.collect()) == list(range(18, 40))
    assert readers.day_folders(spark, str(tmp_path / "t"), df.schema, days=[dt.date(2020, 1, 1)]).count() == 0
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan.split("PartitionFilters: [")[1].split("],")[0]


def test_dynamic_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "01"), ("b", "02")], "v string, day string")
    writers.write_partitions(df, path, ["day"])
    writers.write_partitions(df.where("day = '02'").withColumn("v", F.lit("c")), path, ["day"])
    writers.write_partitions(df.where("false"), path, ["day"])
    got = spark.read.schema("v string, day string").parquet(path)
    assert {tuple(r) for r in got.collect()} == {("a", "01"), ("c", "02")}


def test_envelopes(spark, tmp_path):
    record = {"company": {"name": "A", "symbol": "a"}, "eps": {"actual": {"value": 1.5, "unit": None}}, "year": 2025}
    (tmp_path / "one.json").write_text(json.dumps({"data": [record, record | {"year": 2024}]}))
    (tmp_path / "bad.json").write_text("{not json")
    (tmp_path / "empty.json").write_text('{"data": []}')
    rows = readers.envelope_rows(spark, str(tmp_path), EARNING_RECORD)
    assert sorted(r.year for r in rows.collect()) == [2024, 2025]
    writers.write_envelopes(rows, str(tmp_path / "out"))
    again = readers.envelope_rows(spark, str(tmp_path / "out"), EARNING_RECORD)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))


def test_latest_text(spark, tmp_path):
    for i, name in enumerate(["b.txt", "a.txt"]):
        (tmp_path / name).write_text(f"{name}\nline")
        os.utime(tmp_path / name, (time.time() + i * 10,) * 2)
    assert readers.latest_text(spark, str(tmp_path)).first().text == "a.txt\nline"
    assert readers.latest_text(spark, str(tmp_path / "none")).count() == 0


def test_members(spark):
    bodies = spark.createDataFrame(
        [('{"responseId": "r", "timestamp": "2025-03-25T01:02:03.000Z", "email": "a@x"}', 1), ("{", 2)], "body string, n int"
    )
    got = readers.member_records(bodies).orderBy("n").collect()
    assert (got[0].response_id, got[0].email_address, got[0].timestamp) == ("r", "a@x", dt.datetime(2025, 3, 25, 1, 2, 3))
    assert got[1].response_id is None


def test_digest_files_are_the_text(spark):
    parts = spark.range(300).select(F.col("id").alias("part"), F.concat(F.col("id").cast("string"), F.lit("\n\n")).alias("text"))
    folder = writers.write_digest(parts.repartition(7), scratch_dir(spark, "d"), "events", dt.datetime(2025, 3, 5, 7, 40))
    assert folder.endswith("/EVENTS/year=2025/month=03/day=05/events_25030507")
    files = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    whole = "".join(open(f"{folder}/{f}").read() for f in files)
    assert whole == "".join(f"{i}\n\n" for i in range(300))
    assert len(files) >= 300 / writers.PARTS_PER_FILE
    again = writers.read_digest(spark, folder).orderBy("part").collect()
    assert "".join(r.text for r in again) == whole


def test_digest_files_are_ordered_by_task_and_file(spark, tmp_path):
    job = "6d1f4a52-c128-4d5e-9abc-0c2345678901"
    names = [f"part-0000{task}-{job}-c00{file}.txt" for task in (0, 1) for file in (0, 1, 2)]
    for i, name in enumerate(names):
        (tmp_path / name).write_text(f"{i}\n")
    parts = writers.read_digest(spark, str(tmp_path)).orderBy("part").collect()
    assert [(r.part >> 32, r.part & 0xFFFFFFFF, r.text) for r in parts] == [(i // 3, i % 3, f"{i}\n") for i in range(6)]


def test_publish_switches_versions(spark):
    base = scratch_dir(spark, "v")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    assert writers.publish(df, "published_t", f"{base}/v1") == 1
    table = spark.table("published_t")
    assert writers.publish(table.union(table).select("v", "id"), "published_t", f"{base}/v2") == 2
    assert {tuple(r) for r in spark.table("published_t").collect()} == {(1, "a")}
    assert spark.read.parquet(f"{base}/v1").count() == 1
    with pytest.raises(Exception):
        writers.publish(df, "published_t", f"{base}/v2")
    spark.sql("DROP TABLE published_t")


def test_staging_by_name(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.createDataFrame([("1", 2.0)], "b string, a double").write.parquet(path)
    got = writers.load_staging(spark, path, row(a=TEXT, b=TEXT, c=TEXT))
    assert tuple(got.first()) == ("2.0", "1", None)


def test_cast_reports_missing(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    out, missing = cast_columns(df, {"a": "smallint", "b": "float", "z": "float"})
    assert tuple(out.first()) == (1, None) and missing == ["z"]
    assert align(df, row(b=TEXT, q=TEXT)).columns == ["b", "q"]


def test_theme_table(spark):
    assert [r.theme for r in theme_table(spark).orderBy("precedence").collect()] == list(THEMES)


def test_scratch_needs_a_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
