"""The daily jobs from stored pages to tables, digests and messages.

Every job takes the moment it runs for (`as_of`, UTC) instead of reading the clock, and a
Store that says where files and tables are.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.functions import lines
from finloom.functions.dates import from_epoch_ms
from finloom.functions.keys import surrogate_key
from finloom.operators import merge
from finloom.operators.lookup import lookup_join
from finloom.operators.project import align
from finloom.plans import articles, calendar, digests, fanout, star
from finloom.schemas import (
    ARTICLES,
    COMPANIES,
    EARNING_CALLS,
    EARNING_PERIODS,
    EARNING_RECORD,
    EARNINGS,
    FINANCIAL_EVENTS,
    MARKET_ZONE,
    MEMBERS,
    PAGE_PLACE,
    READER_ZONE,
    STORED_ARTICLES,
    empty_table,
    row,
    theme_table,
)
from finloom.session import materialize
from finloom.sources import readers, sweep, writers
from finloom.sources.metrics import Metrics, Observed, part_name

# The mail's sections, in order.
MAIL_SECTIONS = (("articles", "미국 뉴스"), ("events", "지표 발표"), ("earnings", "실적 발표"))
EVENT_KEYS = ("title", "release_time")
CALL_KEYS = ("company_name", "symbol", "year", "quarter")

# Stored events have their release date as folder column; it depends on the key.
STORED_EVENTS = row(**{f.name: f.dataType for f in FINANCIAL_EVENTS.fields}, release_day=T.StringType())
NO_DAY = "none"
# Stored members have a hash bucket of their key as folder column.
MEMBER_BUCKETS = 64
STORED_MEMBERS = row(**{f.name: f.dataType for f in MEMBERS.fields}, bucket=T.IntegerType())
# An earning record as its envelope holds it, with the place where it stood.
PLACED_RECORD = T.StructType([*EARNING_RECORD.fields, *PAGE_PLACE.fields])

Combine = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Store:
    """Folders under `base` and tables in `database`."""

    spark: SparkSession
    base: str
    database: str = "default"
    key_buckets: int = 64

    def folder(self, stage: str, kind: str) -> str:
        return f"{self.base}/{stage}/{kind}"

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str, schema) -> DataFrame:
        """The stored table, or an empty one before the first load."""
        name = self.name(table)
        return self.spark.table(name) if self.spark.catalog.tableExists(name) else empty_table(self.spark, schema)

    def version(self, table: str, as_of: dt.datetime) -> str:
        """A new folder for a table's files; a repeated run gets its own."""
        return f"{self.base}/TABLES/{table}/{as_of:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"

    @property
    def metrics(self) -> Metrics:
        """Rows and characters of each table's parts, as each run wrote them."""
        return Metrics(self.spark, self.folder("METRICS", "WRITTEN"))

    def publish(self, df: DataFrame, table: str, as_of: dt.datetime) -> int:
        return writers.publish(df, self.name(table), self.version(table, as_of))

    def merge(
        self,
        table: str,
        schema: T.StructType,
        by: Sequence[str],
        staged: DataFrame,
        combine: Combine,
        as_of: dt.datetime,
        job: str = "merge",
    ) -> int:
        """Combine staged rows with the partitions of the table that they touch, and replace these.

        `by` are partition columns that depend on the key, so no other partition can match. Returns
        the rows of the table, from the sizes of its partitions that the writes have observed.
        """
        name = self.name(table)
        writers.create_table(self.spark, name, schema, f"{self.base}/TABLES/{table}/rows", by)
        touched = staged.select(*by).distinct().collect()  # few: days or quarters of one batch
        if not touched:
            return self.total(table, by, as_of)
        same = {part_name(r.asDict()): reduce(and_, [F.col(c).eqNullSafe(F.lit(r[c])) for c in by]) for r in touched}
        self.metrics.seed(table, self.spark.table(name), tuple(by), as_of)
        merged = Observed(combine(self.spark.table(name).where(reduce(or_, same.values())), staged), same)
        writers.publish_partitions(merged.frame, name, by, self.version(table, as_of))
        return self.metrics.record(job, table, as_of, merged.sizes())

    def total(self, table: str, by: Sequence[str], as_of: dt.datetime) -> int:
        self.metrics.seed(table, self.spark.table(self.name(table)), tuple(by), as_of)
        known = self.metrics.known(table)
        return known[0] if known else 0


def local_day(as_of: dt.datetime, zone: str = MARKET_ZONE) -> dt.date:
    return local_time(as_of, zone).date()


def local_time(as_of: dt.datetime, zone: str) -> dt.datetime:
    return as_of.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zone)).replace(tzinfo=None)


def _load_order() -> Column:
    """Later days are loaded first, so that the earlier day's file wins, as in a run day by day."""
    return (-F.datediff(readers.calendar_day(), F.lit(dt.date(1970, 1, 1)))).alias("load_order")


def _in_files(table: T.StructType, moment: str) -> T.StructType:
    """A table's columns as its day files hold them: the moment as epoch milliseconds, no folder columns,
    and where the row stood."""
    kinds = {f.name: f.dataType for f in (*table.fields, *PAGE_PLACE.fields) if f.name not in writers.DAY_COLUMNS}
    return row(**kinds | {moment: T.LongType()})


# The order in which rows count as loaded: day files, then pages by address, then page order.
LOADED = ("load_order", *PAGE_PLACE.fieldNames())


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"page": F.coalesce("page", F.lit("")), "position": F.coalesce("position", F.lit(-1))})


def extract_articles(store: Store, as_of: dt.datetime) -> None:
    """Today's raw article pages of the hour's themes -> themed article rows and rejects."""
    day = local_day(as_of)
    themes = readers.themes_for_hour(local_time(as_of, READER_ZONE).hour)
    pages = readers.spread_pages(readers.themed_pages(store.spark, store.folder("RAW", "ARTICLES"), themes, [day]))
    parsed = materialize(articles.parsed_articles(pages), "articles")
    rows, rejects = articles.split_articles(parsed)
    dated = writers.with_day_columns(rows.withColumn("theme", F.upper("theme")), F.lit(day))
    writers.write_partitions(dated, store.folder("TRANSFORMED", "ARTICLES"), ("theme", *writers.DAY_COLUMNS))
    for theme in themes:
        own = writers.with_day_columns(rejects.where(F.upper("theme") == theme.upper()), F.lit(day)).drop("theme")
        writers.write_day_rejects(own, f"{store.folder('REJECTS', 'ARTICLES')}/theme={theme.upper()}", [day])


def _calendar_window(store: Store, kind: str, as_of: dt.datetime) -> DataFrame:
    pages = readers.calendar_pages(store.spark, store.folder("RAW", kind), readers.window_days(local_day(as_of)))
    return readers.spread_pages(pages)


def extract_events(store: Store, as_of: dt.datetime) -> None:
    """Calendar pages of yesterday, today and tomorrow -> event rows per day, and rejects."""
    pages = _calendar_window(store, "EVENTS", as_of)
    parsed = materialize(calendar.parsed_events(pages, readers.calendar_day(), keep=writers.DAY_COLUMNS), "events")
    rows, rejects = calendar.split_events(parsed, keep=writers.DAY_COLUMNS, placed=True)
    writers.write_partitions(rows, store.folder("TRANSFORMED", "EVENTS"))
    writers.write_day_rejects(rejects, store.folder("REJECTS", "EVENTS"), readers.window_days(local_day(as_of)))


def extract_earnings(store: Store, as_of: dt.datetime) -> None:
    """Earnings pages of the three days -> nested envelopes and flat rows per day, and rejects."""
    pages = _calendar_window(store, "EARNING_CALLS", as_of)
    # A record's own year is that of its folder, so it serves as the folder column too.
    keep, days = writers.DAY_COLUMNS[1:], writers.DAY_COLUMNS
    parsed = materialize(calendar.parsed_earnings(pages, readers.calendar_day(), keep), "earnings")
    records = calendar.split_earnings(parsed, keep, placed=True)[0]
    rejects = parsed.where("reject IS NOT NULL").select("url", "position", F.col("reject").alias("reason"), *days)
    envelope = F.array(F.struct(*PLACED_RECORD.fieldNames())).alias("data")
    writers.write_partitions(records.select(envelope, *days), store.folder("OLTP", "EARNING_CALLS"), kind="json")
    flat = calendar.earning_calls(records, [*PAGE_PLACE.fieldNames(), *keep])
    writers.write_partitions(flat, store.folder("TRANSFORMED", "EARNING_CALLS"))
    writers.write_day_rejects(rejects, store.folder("REJECTS", "EARNING_CALLS"), readers.window_days(local_day(as_of)))


def load_articles(store: Store, as_of: dt.datetime) -> int:
    """Append today's articles whose url is new; of several themes the first one keeps a url."""
    name, spark = store.name("financial_articles"), store.spark
    place, buckets = f"{store.base}/TABLES/financial_articles/rows", store.key_buckets
    writers.create_table(spark, name, STORED_ARTICLES, place, ["day"], buckets, ["url"])
    path = store.folder("TRANSFORMED", "ARTICLES")
    staged = readers.day_folders(spark, path, ARTICLES, days=[local_day(as_of)], above="theme=*/")
    ranks = theme_table(spark).select(F.upper("theme").alias("theme"), F.col("theme").alias("_name"), "precedence")
    themed = staged.join(F.broadcast(ranks), "theme")  # eight fixed rows
    first = themed.groupBy("url").agg(F.min("precedence").alias("precedence"))
    kept = lookup_join(themed, first, ["url", "precedence"], "left_semi").withColumn("theme", F.col("_name"))
    by_day = align(kept, ARTICLES).withColumn("day", F.coalesce(F.date_format("date", "yyyy-MM-dd"), F.lit(NO_DAY)))
    store.metrics.seed("financial_articles", spark.table(name), (), as_of)
    added = writers.append_new_keys(materialize(by_day, "arrived"), name, ["url"], buckets)
    return store.metrics.record("load_articles", "financial_articles", as_of, added, added=True)


def _staged(store: Store, stage: str, kind: str, as_of: dt.datetime, schema: T.StructType, files: str) -> DataFrame:
    """The day files around today, with their load order."""
    days = readers.window_days(local_day(as_of))
    rows = readers.day_folders(store.spark, store.folder(stage, kind), schema, files, days=days)
    return rows.withColumn("load_order", _load_order())


def load_events(store: Store, as_of: dt.datetime) -> int:
    """Upsert the three days' events by title and release time."""
    stored = _in_files(FINANCIAL_EVENTS, "release_time")
    rows = _staged(store, "TRANSFORMED", "EVENTS", as_of, stored, "parquet")
    rows = rows.withColumn("release_time", from_epoch_ms(F.col("release_time")))
    day = F.coalesce(F.date_format("release_time", "yyyy-MM-dd"), F.lit(NO_DAY))
    staged = _placed(rows).withColumn("release_day", day)
    # Events without a time or title are one row per key too: a rerun does not add them again.
    combine = lambda stored, new: merge.upsert_unique(stored, new, EVENT_KEYS, LOADED)
    return store.merge("financial_events", STORED_EVENTS, ["release_day"], staged, combine, as_of, "load_events")


def load_earning_calls(store: Store, as_of: dt.datetime) -> int:
    """Replace the calls of the staged companies and periods with the staged rows."""
    stored = _in_files(EARNING_CALLS, "call_date")
    calls = _staged(store, "TRANSFORMED", "EARNING_CALLS", as_of, stored, "parquet").withColumns(
        {"call_date": from_epoch_ms(F.col("call_date")), "year": F.col("year").cast("smallint")}
    )
    # A day loaded later deletes what an earlier day brought in for the same keys.
    newest = calls.groupBy(*CALL_KEYS).agg(F.max("load_order").alias("load_order"))
    whole = F.expr(" AND ".join(f"{k} IS NOT NULL" for k in CALL_KEYS))
    staged = lookup_join(calls.where(whole), newest, [*CALL_KEYS, "load_order"], "left_semi")
    staged = align(staged.unionByName(calls.where(~whole)), EARNING_CALLS)
    combine = lambda stored, new: merge.replace_by_keys(stored, new, CALL_KEYS)
    return store.merge("earning_calls", EARNING_CALLS, ["year", "quarter"], staged, combine, as_of, "load_earning_calls")


def load_earning_star(store: Store, as_of: dt.datetime) -> dict[str, int]:
    """Add new companies and periods, and insert or update earnings that changed.

    Earnings are stored by period, so only the batch's periods are read and replaced.
    """
    files = _staged(store, "OLTP", "EARNING_CALLS", as_of, row(data=T.ArrayType(PLACED_RECORD)), "json")
    ordered = materialize(_placed(files.select("load_order", F.inline("data"))), "records")
    dims = {"companies": COMPANIES, "earning_periods": EARNING_PERIODS}
    companies, periods = [store.table(name, schema) for name, schema in dims.items()]
    counts = {}

    def combine(stored: DataFrame, _: DataFrame) -> DataFrame:
        loaded = star.load_star(ordered, companies, periods, stored, order=LOADED)
        # Published before the earnings that refer to them.
        counts.update({n: store.publish(loaded[p], n, as_of) for n, p in zip(dims, ("companies", "periods"))})
        return loaded["earnings"]

    touched = ordered.select(surrogate_key(F.col("year"), F.col("quarter")).alias("period_id"))
    loaded = store.merge("earnings", EARNINGS, ["period_id"], touched, combine, as_of, "load_earning_star")
    return {"earnings": loaded, **counts}


def period_of(day: dt.date) -> Column:
    """The id of a day's quarter. A call's period follows from its day, so a day's calls are all
    in one folder of the stored earnings; the id is a constant, which Spark prunes folders by."""
    return surrogate_key(F.lit(day.year), F.lit((day.month + 2) // 3))


def write_digests(store: Store, as_of: dt.datetime) -> dict[str, str]:
    """The three digest texts of this run; returns their folders.

    Texts and file stamps follow the readers' clock; "today" in the tables is the UTC date,
    which at the morning and the evening run is also the market's date.
    """
    now, day = local_time(as_of, READER_ZONE), as_of.date()
    days = [(local_day(as_of) - dt.timedelta(days=n)).isoformat() for n in (0, 1)]
    articles_of = store.table("financial_articles", STORED_ARTICLES).where(F.col("day").isin(days))
    news = digests.news_window(articles_of, as_of)
    stored = store.table("financial_events", STORED_EVENTS).where(F.col("release_day") == day.isoformat())
    events = digests.events_of_day(stored, day, now.hour)
    called = day - dt.timedelta(days=1)
    earnings = digests.earnings_digest(
        store.table("earnings", EARNINGS).where(F.col("period_id") == period_of(called)),
        store.table("companies", COMPANIES),
        store.table("earning_periods", EARNING_PERIODS),
        called,
    )
    parts = {
        "articles": digests.digest_parts(digests.article_lines(news), "line", ["date", "title", "line"]),
        "events": digests.digest_parts(digests.event_lines(events, now.hour), "line", ["release_time", "title", "line"]),
        "earnings": digests.digest_parts(digests.earning_lines(earnings), "line", ["call_date", "name", "line"]),
    }
    return {kind: writers.write_digest(p, f"{store.base}/SUMMARY", kind, now) for kind, p in parts.items()}


def write_mail(store: Store, folders: dict[str, str], as_of: dt.datetime) -> str:
    """The sections of a run put together as the final text; returns its folder.

    The subject, which names the readers' hour, stands in a folder of the same name with `_subject`.
    """
    sections = [(title, writers.read_digest(store.spark, folders[kind])) for kind, title in MAIL_SECTIONS]
    mail, now = digests.mail_parts(sections), local_time(as_of, READER_ZONE)
    subject = store.spark.range(1).select(lines.subject(F.lit(now.hour)).alias("text"))
    subject.coalesce(1).write.mode("overwrite").text(f"{writers.digest_folder(store.base, 'final', now)}_subject")
    return writers.write_digest(mail, store.base, "final", now, order=("section", "part"))


def _run_folder(store: Store, kind: str, as_of: dt.datetime) -> str:
    base = store.base if kind == "final" else f"{store.base}/SUMMARY"
    return writers.digest_folder(base, kind, local_time(as_of, READER_ZONE))


def mail_of_run(store: Store, as_of: dt.datetime) -> str:
    """write_mail over the digests that this run has written."""
    return write_mail(store, {kind: _run_folder(store, kind, as_of) for kind, _ in MAIL_SECTIONS}, as_of)


def messages_of_run(store: Store, as_of: dt.datetime) -> str:
    """write_messages over the mail that this run has written."""
    return write_messages(store, writers.read_digest(store.spark, _run_folder(store, "final", as_of)), as_of)


def register_arrived(store: Store, as_of: dt.datetime) -> int:
    """register_members over the registration bodies, one a line, under REGISTRATIONS."""
    path = f"{store.base}/REGISTRATIONS"
    if not readers.path_exists(store.spark, path):
        return 0
    return register_members(store, store.spark.read.text(path).withColumnRenamed("value", "body"), as_of)


def write_messages(store: Store, texts: DataFrame, as_of: dt.datetime) -> str:
    """One message row per member and text; a long text is cut by its length. Returns the folder.

    `texts` is readers.latest_text of a folder, or writers.read_digest of a written mail.
    """
    out = f"{store.base}/MESSAGES/{as_of:%Y%m%dT%H%M%S}"
    parts = fanout.sized_parts(texts) if "part" in texts.columns else texts
    fanout.member_messages(store.table("members", STORED_MEMBERS).drop("bucket"), parts).write.mode("overwrite").json(out)
    return out


def register_members(store: Store, bodies: DataFrame, as_of: dt.datetime) -> int:
    """Upsert members from registration bodies (column body); the latest timestamp wins.

    Members are stored by a hash bucket of their key, so a batch reads and rewrites its buckets only.
    """
    staged = readers.member_records(bodies.select("body")).where("response_id IS NOT NULL")
    staged = staged.withColumn("_mail", F.coalesce("email_address", F.lit("")))
    staged = staged.withColumn("_when", F.coalesce("timestamp", F.timestamp_seconds(F.lit(0))))
    staged = staged.withColumn("bucket", F.pmod(F.hash("response_id"), F.lit(MEMBER_BUCKETS)))
    combine = lambda stored, new: merge.upsert_unique(stored, new, ["response_id"], ["_when", "_mail"])
    return store.merge("members", STORED_MEMBERS, ["bucket"], staged, combine, as_of, "register_members")


#: Days for which a replaced version of a table can still be read.
KEPT_DAYS = 7


def sweep_store(store: Store, as_of: dt.datetime) -> int:
    """Delete table versions that no table reads any more and scratch folders of ended runs; returns how many."""
    before = as_of - dt.timedelta(days=KEPT_DAYS)
    gone = sweep.sweep_versions(store.spark, store.base, store.database, before)
    return len(gone) + len(sweep.sweep_scratch(store.spark, before))
