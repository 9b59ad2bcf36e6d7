"""The daily jobs end to end on hand-written pages."""

import datetime as dt
import json
import os

import pytest
from test_pages import article, by, event

from finloom.__main__ import run
from finloom.plans import jobs
from finloom.plans.jobs import Store
from finloom.sources import readers, writers

AS_OF = dt.datetime(2025, 3, 25, 12, 10)  # 21:10 in Seoul, 08:10 in New York


def land(base, kind, day, name, content):
    folder = base / "RAW" / kind / f"year=2025/month=03/day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    page = {"url": f"https://x/{name}.html", "timestamp": "2025-03-25T01:02:03", "content": content}
    (folder / f"{name}.json").write_text(json.dumps(page, indent=4))


def earnings_page(*rows):
    body = "".join(
        f'<tr><td class="flag"><span title="US"></span></td><td class="left noWrap earnCalCompany" title="{n}"><a>{s}</a></td>'
        f"<td>1</td><td>/2</td><td>{actual}</td><td>/{forecast}</td><td>3B</td></tr>"
        for n, s, actual, forecast in rows
    )
    return f'<table id="earningsCalendarData"><tbody><tr><td>h</td></tr>{body}</tbody></table>'


def text_of(folder):
    files = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    return "".join(open(f"{folder}/{f}", encoding="utf-8").read() for f in files)


def test_whole_day(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS daily LOCATION '{tmp_path}/db'")
    store = Store(spark, str(tmp_path), "daily")
    page = article(by("<a>Ann</a><a>Bo</a>"), stamp="2025-03-25T11:30:00.000Z")
    land(tmp_path, "ARTICLES/TECH", "25", "a", page)
    land(tmp_path, "ARTICLES/LATEST", "25", "a", page)
    land(tmp_path, "ARTICLES/LATEST", "25", "b", article(by("<a>Cy</a>"), wrap="none"))
    land(tmp_path, "ARTICLES/LATEST", "24", "old", page)
    land(tmp_path, "EVENTS", "24", "event", event(title="Old"))
    land(tmp_path, "EVENTS", "25", "event", event() + event(time="10:00", title="Late", act="") + event(time="x"))
    land(tmp_path, "EARNING_CALLS", "24", "earning", earnings_page(("Acme", "AC", "1.5B", "1,400M"), ("Zed", "Z", "--", "2M")))
    land(tmp_path, "EARNING_CALLS", "25", "earning", earnings_page(("Bee", "B", "--", "--")))

    for _ in range(2):  # a rerun changes nothing
        ran = run(store, AS_OF, ["extract_articles", "extract_events", "extract_earnings", "load_articles"])
        assert ran["load_articles"] == 2
    themes = spark.table("daily.financial_articles").select("theme", "url").distinct().collect()
    assert [tuple(r) for r in themes] == [("Tech", "https://x/a.html")]

    for _ in range(2):
        assert jobs.load_events(store, AS_OF) == 3
        assert jobs.load_earning_calls(store, AS_OF) == 3
        assert jobs.load_earning_star(store, AS_OF) == {"companies": 3, "earning_periods": 1, "earnings": 3}

    other = spark.table("daily.financial_events").where("release_day = '2025-03-24'").inputFiles()
    land(tmp_path, "EVENTS", "25", "event", event(act="7%"))
    land(tmp_path, "EVENTS", "24", "event", "")
    later = AS_OF + dt.timedelta(hours=30)  # the window is now 25 to 27 March
    jobs.extract_events(store, later)
    assert jobs.load_events(store, later) == 3
    stored = spark.table("daily.financial_events")
    assert stored.where("title = 'CPI'").first().actual == 7
    assert stored.where("release_day = '2025-03-24'").inputFiles() == other

    folders = jobs.write_digests(store, AS_OF)
    assert folders["events"].endswith("SUMMARY/EVENTS/year=2025/month=03/day=25/events_25032521")
    assert text_of(folders["articles"]) == "title: T &b\ncontent\none\ntwo\nthree\nfour\n\n"
    assert text_of(folders["events"]) == (
        "21:30 - CPI ★★\n(예상: 1.3%, 이전: 1.1%)\n\n23:00 - Late ★★\n(예상: 1.3%, 이전: 1.1%)\n\n"
    )
    assert text_of(folders["earnings"]) == "Acme(AC)\n실제: 1.50B / 기대: 1400.00M → ▲\n\n"

    final = jobs.write_mail(store, folders, AS_OF)
    assert text_of(final).startswith("【미국 뉴스】\ntitle: T &b\n")
    assert "\n" + "-" * 116 + "\n\n【지표 발표】\n21:30 - CPI" in text_of(final)

    bodies = [
        {"responseId": "7", "timestamp": "2025-03-25T01:00:00.000Z", "email": "old@x"},
        {"responseId": "7", "timestamp": "2025-03-25T02:00:00.000Z", "email": "new@x"},
    ]
    df = spark.createDataFrame([(json.dumps(b),) for b in bodies], "body string")
    assert jobs.register_members(store, df, AS_OF) == 1
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts/final.txt").write_text("hello\n")
    out = jobs.write_messages(store, readers.latest_text(spark, str(tmp_path / "texts")), AS_OF)
    (message,) = spark.read.json(out).collect()
    assert message.key == "group-9" and json.loads(message.value) == {"text": "hello\n", "address": "new@x"}
    out = jobs.write_messages(store, writers.read_digest(spark, final), AS_OF)
    sent = sorted((json.loads(m.value) for m in spark.read.json(out).collect()), key=lambda m: m["part"])
    assert "".join(m["text"] for m in sent) == text_of(final)

    # the later run's page of 25 March has no unreadable row, and replaced the day's rejects
    assert spark.read.parquet(str(tmp_path / "REJECTS/EVENTS")).count() == 0
    spark.sql("DROP DATABASE daily CASCADE")


def test_first_run_without_files(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bare LOCATION '{tmp_path}/db'")
    store = Store(spark, str(tmp_path), "bare")
    assert jobs.load_articles(store, AS_OF) == 0
    assert jobs.load_events(store, AS_OF) == 0
    assert jobs.load_earning_calls(store, AS_OF) == 0
    assert jobs.load_earning_star(store, AS_OF) == {"earnings": 0}
    folders = jobs.write_digests(store, AS_OF)
    assert {text_of(f) for f in folders.values()} == {""}
    with pytest.raises(ValueError):
        run(store, AS_OF, ["no_such_job"])
    spark.sql("DROP DATABASE bare CASCADE")
