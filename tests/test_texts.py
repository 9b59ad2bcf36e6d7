"""Ordered text in parts, mails and member messages."""

import datetime as dt
import json

from pyspark.sql import Observation
from pyspark.sql import functions as F

from finloom.operators.ordered_text import number_rows, ordered_parts
from finloom.plans import digests
from finloom.plans.fanout import member_messages


def test_number_rows(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("x"), F.lit("hot").alias("g"))
    out = number_rows(df.repartition(5), ["g", "x"]).orderBy("x").select("row_no").collect()
    assert [r.row_no for r in out] == list(range(10_000))


def test_parts_make_the_whole_text(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("g"),
        (F.col("id") * 7 % 3001).alias("x"),
        F.concat(F.col("id").cast("string"), F.lit("\n")).alias("line"),
    )
    parts = ordered_parts(df, ["g"], ["x"], "line", lines_per_part=64).collect()
    assert max(p.text.count("\n") for p in parts) <= 64
    for g in "ab":
        whole = "".join(p.text for p in sorted((p for p in parts if p.g == g), key=lambda p: p.part))
        want = "".join(r.line for r in df.where(F.col("g") == g).orderBy("x").collect())
        assert whole == want


def test_mail_order(spark):
    one = spark.createDataFrame([(1, "b"), (0, "a")], "part bigint, text string")
    two = spark.createDataFrame([], "part bigint, text string")
    mail = digests.mail_parts([("X", one), ("Y", two)]).orderBy("section", "part").collect()
    assert "".join(r.text for r in mail) == "【X】\nab\n" + "-" * 116 + "\n\n【Y】\n"


def test_messages(spark):
    members = spark.createDataFrame(
        [("7", "a@x"), ("7", "a@x"), ("7", "b@x"), ("8", "c@x")], "response_id string, email_address string"
    ).withColumn("timestamp", F.current_timestamp())
    text = spark.createDataFrame([('say "hi"\n',)], "text string")
    out = member_messages(members, text).collect()
    assert sorted(json.loads(r.value)["address"] for r in out) == ["a@x", "b@x", "c@x"]
    assert {json.loads(r.value)["text"] for r in out} == {'say "hi"\n'}
    assert {r.key for r in out if "a@x" in r.value or "b@x" in r.value} == {"group-9"}


def earnings_frames(spark):
    earnings = spark.createDataFrame(
        [
            (1, 1, "5", "M", "4", "M", "2025-03-24 09:00:00"),
            (1, 1, "5", "M", "4", "M", "2025-03-24 08:00:00"),
            (1, 1, "0", None, "4", "M", "2025-03-24 08:00:00"),
            (2, 1, None, None, "4", "M", "2025-03-24 08:00:00"),
            (2, 1, "6", "B", "7000", "M", "2025-03-24 23:59:59"),
            (2, 1, "9", "B", "7", "M", "2025-03-25 00:00:00"),
            (3, 1, "9", "B", "7", "M", "2025-03-24 00:00:00"),
        ],
        "company_id int, period_id int, a string, revenue_actual_unit string, f string, revenue_forecast_unit string, d string",
    ).select(
        "*",
        F.col("a").cast("decimal(20,2)").alias("revenue_actual"),
        F.col("f").cast("decimal(20,2)").alias("revenue_forecast"),
        F.col("d").cast("timestamp_ntz").alias("call_date"),
    )
    companies = spark.createDataFrame([(1, "A", "a"), (2, "B", "b")], "company_id int, name string, symbol string")
    periods = spark.createDataFrame([(1, 2025, 1)], "period_id int, year int, quarter int")
    return earnings, companies, periods


def test_earnings_digest(spark):
    rows = digests.earnings_digest(*earnings_frames(spark), day=dt.date(2025, 3, 24))
    out = digests.earning_marks(rows).orderBy("call_date").collect()
    assert [(r.name, r.call_date.hour, r.mark) for r in out] == [("A", 8, "▲"), ("B", 23, "▼")]


def test_news_window_bounds(spark):
    # 21:40 UTC on a summer day is 17:40 in New York; the window starts ten full hours earlier.
    times = ["2025-06-02 06:59:59", "2025-06-02 07:00:00", "2025-06-02 17:39:59", "2025-06-02 17:40:00"]
    df = spark.createDataFrame([(t, t) for t in times], "title string, d string").select(
        "title", F.lit("x").alias("text"), F.col("d").cast("timestamp_ntz").alias("date")
    )
    got = digests.news_window(df, dt.datetime(2025, 6, 2, 21, 40))
    assert sorted(r.title for r in got.collect()) == times[1:3]


def test_event_hours(spark):
    df = spark.createDataFrame(
        [("2025-03-25 08:30:00", "CPI", 1.0), ("2025-03-25 10:00:00", "PMI", None), ("2025-03-26 10:00:00", "X", 1.0)],
        "d string, title string, actual double",
    ).select(
        F.col("d").cast("timestamp_ntz").alias("release_time"), F.lit("America/New_York").alias("timezone"), "title",
        F.lit(1).alias("volatility"), "actual", F.lit(None).cast("double").alias("forecast"),
        F.lit(None).cast("double").alias("previous"), F.lit(None).cast("string").alias("unit"),
    )
    day = dt.date(2025, 3, 25)
    assert digests.events_of_day(df.union(df), day, 21).count() == 2
    assert digests.events_of_day(df, day, 7).count() == 1
    noon = digests.event_lines(df, 12).where("title = 'CPI'").first().line
    assert noon == "21:30 - CPI ★\n\n\n"
    assert digests.event_lines(df, 11).count() == 2


def test_measures(spark):
    df = spark.createDataFrame([("ab",), ("c",)], "line string")
    assert tuple(df.agg(*digests.text_measures("line")).first()) == (2, 3)
    seen = Observation("digest")
    df.observe(seen, *digests.text_measures("line")).collect()
    assert seen.get == {"rows": 2, "characters": 3}
