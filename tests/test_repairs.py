"""Cases that earlier results got wrong."""

import datetime as dt
import json
import time
import uuid

import pytest
from pyspark.sql import functions as F
from test_jobs import AS_OF, earnings_page, land
from test_pages import event

from finloom.catalog import QUERIES, job_queries
from finloom.catalog.page_queries import event_pages
from finloom.catalog.registry import Tables
from finloom.functions.cells import number_text
from finloom.operators.merge import merge_changes
from finloom.plans import articles, calendar, jobs
from finloom.plans.fanout import sized_parts
from finloom.plans.jobs import Store
from finloom.sources import writers


@pytest.fixture
def store(spark, tmp_path):
    name = f"repairs_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{tmp_path}/db'")
    yield Store(spark, str(tmp_path), name)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_pages_without_content_are_rejects(spark):
    pages = spark.createDataFrame([("u", None, "Tech"), ("v", "<p>", "Tech")], "url string, content string, theme string")
    day = F.lit(dt.date(2025, 3, 25))
    for parsed, split in (
        (calendar.parsed_events(pages, day), calendar.split_events),
        (calendar.parsed_earnings(pages, day), calendar.split_earnings),
    ):
        rows, rejects = split(parsed)
        assert rows.count() == 0
        assert [(r.url, r.position, r.reason) for r in rejects.collect()] == [("u", 0, "no content")]
    rows, rejects = articles.split_articles(articles.parsed_articles(pages))
    assert rows.count() == 0
    assert sorted((r.url, r.reason) for r in rejects.collect()) == [("u", "no content"), ("v", "no article element")]


def test_stored_numbers_print_as_they_were_read(spark):
    numbers = [98.3, 64.7, 100.1, 217.3, 3.0, -0.25, 1e7, None]
    df = spark.createDataFrame([(x,) for x in numbers], "x double").select(F.col("x").cast("float").alias("x"))
    got = [r.t for r in df.select(number_text(F.col("x")).alias("t")).collect()]
    assert got == ["98.3", "64.7", "100.1", "217.3", "3.0", "-0.25", "10000000.0", None]


def test_messages_are_cut_by_length_alone(spark):
    texts = [(k, f"line {k} é\n" * (k % 5)) for k in range(40)]
    whole = "".join(t for _, t in texts)
    for files in (2, 16):
        df = spark.createDataFrame(texts, "part bigint, text string").repartition(files)
        got = [r.text for r in sized_parts(df, 37).orderBy("part").collect()]
        assert "".join(got) == whole
        assert [len(x) for x in got[:-1]] == [37] * (len(got) - 1)
    assert sized_parts(spark.createDataFrame([], "part bigint, text string")).count() == 0


def test_rows_of_a_page_are_loaded_in_page_order(spark, store, tmp_path):
    land(tmp_path, "EVENTS", "25", "event", event(act="9.1%") + event(act="10.2%"))
    page = earnings_page(("Acme", "AC", "9M", "1M"), ("Acme", "AC", "10M", "1M")).replace("<td>3B</td>", "<td>9B</td>", 1)
    page = page.replace("<td>3B</td>", "<td>10B</td>")
    land(tmp_path, "EARNING_CALLS", "25", "earning", page)
    jobs.extract_events(store, AS_OF)
    jobs.extract_earnings(store, AS_OF)
    jobs.load_events(store, AS_OF)
    jobs.load_earning_star(store, AS_OF)
    (row,) = spark.table(store.name("financial_events")).collect()
    assert round(row.actual, 3) == 10.2  # the last one counts
    assert float(spark.table(store.name("earnings")).first().revenue_actual) == 10.0
    assert float(spark.table(store.name("companies")).first().market_cap) == 9.0  # the first one makes the company


def test_events_without_a_time_are_loaded_once(spark, store, tmp_path):
    page = event(title="Holiday").replace('class="first left time js-time"', 'class="first left"')
    land(tmp_path, "EVENTS", "25", "event", page + event())
    jobs.extract_events(store, AS_OF)
    for _ in range(2):
        assert jobs.load_events(store, AS_OF) == 2


def test_any_value_can_be_a_partition(spark, store):
    schema = spark.createDataFrame([], "k int, v int, p string").schema
    rows = [(1, 1, None), (2, 1, "a/b"), (3, 1, "it's+%"), (4, 1, "plain")]
    upsert = lambda old, new: jobs.merge.upsert_unique(old, new, ["k"], ["v"])
    for n in (1, 2):
        df = spark.createDataFrame([(k, n, p) for k, _, p in rows], schema)
        store.merge("parts", schema, ["p"], df, upsert, AS_OF + dt.timedelta(hours=n))
    got = spark.table(store.name("parts")).collect()
    assert sorted((r.k, r.v, r.p) for r in got) == [(k, 2, p) for k, _, p in rows]


def test_rejects_of_a_day_go_when_a_rerun_has_none(spark, store, tmp_path):
    land(tmp_path, "EVENTS", "25", "event", event(time="x"))
    jobs.extract_events(store, AS_OF)
    assert spark.read.parquet(str(tmp_path / "REJECTS/EVENTS")).count() == 1
    land(tmp_path, "EVENTS", "25", "event", event())
    jobs.extract_events(store, AS_OF)
    assert spark.read.parquet(str(tmp_path / "REJECTS/EVENTS")).count() == 0


def test_changes_are_merged_in_one_read_of_each_side(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "c", 3)], "k int, x string, y int").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    latest = spark.createDataFrame([(1, "a", 9), (2, "z", 9), (4, None, 9)], "k int, x string, y int")
    merged = merge_changes(target, latest, ["k"], ["x"])
    assert sorted(map(str, map(tuple, merged.collect()))) == sorted(map(str, [(1, "a", 1), (2, "z", 9), (None, "c", 3), (4, None, 9)]))
    plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1


def test_the_mail_and_messages_of_a_run(spark, store, tmp_path):
    land(tmp_path, "EVENTS", "25", "event", event())
    jobs.extract_events(store, AS_OF)
    jobs.load_events(store, AS_OF)
    (tmp_path / "REGISTRATIONS").mkdir()
    (tmp_path / "REGISTRATIONS/a.txt").write_text(json.dumps({"responseId": "7", "timestamp": "2025-03-25T01:00:00Z", "email": "a@x"}) + "\n")
    assert jobs.register_arrived(store, AS_OF) == 1
    jobs.write_digests(store, AS_OF)
    mail = jobs.mail_of_run(store, AS_OF)
    text = "".join(r.text for r in writers.read_digest(spark, mail).orderBy("part").collect())
    (message,) = spark.read.json(jobs.messages_of_run(store, AS_OF)).collect()
    assert json.loads(message.value)["text"] == text and "CPI" in text


def test_folders_are_named_once_and_not_for_each_row(spark, tmp_path):
    name = f"named_{uuid.uuid4().hex}"
    odd = ["a b+c", "x/y=%2F", "é", None]
    part = F.element_at(F.array(*[F.lit(v) for v in odd]), (F.col("id") % 4 + 1).cast("int"))
    rows = spark.range(200_000).select("id", part.alias("part"))
    writers.create_table(spark, name, rows.schema, str(tmp_path / "rows"), ["part"])
    start = time.monotonic()
    writers.publish_partitions(rows, name, ["part"], str(tmp_path / "version"))
    assert time.monotonic() - start < 12  # some 250 microseconds a row when each row's path was searched
    assert {(r.part, r.n) for r in spark.table(name).groupBy("part").agg(F.count("*").alias("n")).collect()} == {(v, 50_000) for v in odd}


def events_table(spark, folder, rows):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame([(*r, "{}") for r in rows], schema).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def at(day, minute):
    return dt.datetime(2024, 1, day) + dt.timedelta(minutes=minute)


def test_calendar_scan_reads_every_event_of_a_large_day(spark, tmp_path):
    # the day's 26 million characters were one page, which the reader took for one without content
    many = [(i, at(1, i % 1440), i % 97, "view" * 750, i / 4) for i in range(2000)]
    few = [(7, at(2, 1), 5, "click", 1.5), (7, at(2, 1), 5, "click", 1.5), (None, at(2, 2), 6, "error", 2.0)]
    nulls = [(8, None, 5, "view", 1.0), (9, at(3, 0), 5, "view", None), (10, at(2, 3), None, "view", 1.0), (11, at(2, 3), 4, None, 1.0)]
    sf = events_table(spark, tmp_path, [*many, *few, *nulls])
    scanned, each = [QUERIES[name](spark, sf) for name in ("calendar_scan", "event_rows")]
    got, want = [sorted(map(str, df.withColumns({c: F.md5(c) for c in ("country", "title")}).collect())) for df in (scanned, each)]
    assert got == want and len(got) == 2 * (len(many) + len(few))


def test_calendar_pages_have_a_bounded_number_of_events(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(job_queries, "PAGE_EVENTS", 4)
    days = {1: 1, 2: 4, 3: 5, 4: 13}
    rows = [(100 * day + i, at(day, i), 100 * day + i, "view", 1.0) for day, n in days.items() for i in range(n)]
    t = Tables(spark, events_table(spark, tmp_path, rows))
    pages = job_queries.day_pages(t).collect()
    sizes = {day: sorted(p.content.count("theDay") for p in pages if p.day.day == day) for day in days}
    assert sizes == {1: [1], 2: [4], 3: [1, 4], 4: [1, 4, 4, 4]}
    own = event_pages(t).orderBy("url").collect()
    for day in days:  # one after another they are the day's events in the order of urls
        whole = "".join(r.content for r in own if r.day.day == day)
        parts = sorted((p.content for p in pages if p.day.day == day), key=whole.index)
        assert "".join(parts) == whole


def test_calendar_scan_of_no_events(spark, tmp_path):
    assert QUERIES["calendar_scan"](spark, events_table(spark, tmp_path, [])).count() == 0
