"""Written and re-read layouts of the given tables. Every run writes to a new scratch folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.catalog.digest_queries import _CALENDAR_SQL, _LINES_SQL, _event_lines
from finloom.catalog.merge_queries import order_records
from finloom.catalog.registry import Tables, query
from finloom.operators import merge
from finloom.operators.ordered_text import ordered_parts
from finloom.operators.project import flatten_earnings
from finloom.plans.jobs import Store, register_members
from finloom.schemas import EARNING_RECORD, RAW_PAGE, TEXT, THEMES, row, theme_table
from finloom.session import scratch_dir
from finloom.sources import readers, writers
from finloom.sources.reconcile import read_united


@query(
    "partition_window_scan",
    """SELECT event_id, user_id, event_type, ts, value, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-17'""",
)
def partition_window_scan(t: Tables):
    path = scratch_dir(t.spark, "events-by-day")
    rows = t.events.drop("props")
    writers.write_partitions(writers.with_day_columns(rows, F.col("ts")), path)
    days = readers.window_days(dt.date(2024, 1, 16))
    return readers.day_folders(t.spark, path, rows.schema, suffix="parquet", days=days)


@query(
    "partition_overwrite",
    """SELECT event_id, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-16' THEN value + 1 ELSE value END AS value,
  strftime(ts, '%Y-%m-%d') AS day FROM events""",
)
def partition_overwrite(t: Tables):
    """All days written, then one day again: only that day's folder is replaced."""
    path = scratch_dir(t.spark, "events-rewritten")
    rows = writers.with_day_columns(t.events, F.col("ts")).select("event_id", "value", *writers.DAY_COLUMNS)
    writers.write_partitions(rows, path)
    again = rows.where("month = '01' AND day = '16'").withColumn("value", F.col("value") + 1)
    writers.write_partitions(again, path)
    stored = readers.day_folders(t.spark, path, t.events.select("event_id", "value").schema)
    return stored.select("event_id", "value", F.concat_ws("-", *writers.DAY_COLUMNS).alias("day"))


_THEME = "CASE WHEN {host} LIKE 'm.%' THEN 'Stock Market' WHEN {host} LIKE 'blog.%' THEN 'Latest' ELSE 'Tech' END"


@query(
    "raw_pages_roundtrip",
    f"""WITH p AS (SELECT *, {_THEME.format(host="regexp_extract(url, '//([^/]*)', 1)")} AS t FROM pages)
SELECT url, '2024-01-' || lpad((length(html) % 3 + 14)::VARCHAR, 2, '0') || 'T08:00:00' AS timestamp, html AS content,
  replace(replace(regexp_extract(url, '[^/]*$'), '.html', ''), '-', '_') AS slug, upper(replace(t, ' ', '_')) AS theme,
  '2024' AS year, '01' AS month, lpad((length(html) % 3 + 14)::VARCHAR, 2, '0') AS day
FROM p WHERE t <> 'Tech'""",
)
def raw_pages_roundtrip(t: Tables):
    """Pages landed by theme and day, then two themes read back."""
    path = scratch_dir(t.spark, "raw-pages")
    host = F.regexp_extract("url", "//([^/]*)", 1)
    theme = F.when(host.like("m.%"), "Stock Market").when(host.like("blog.%"), "Latest").otherwise("Tech")
    day = F.lpad((F.length("html") % 3 + 14).cast("string"), 2, "0")
    landed = t.pages.select(
        "url",
        F.concat(F.lit("2024-01-"), day, F.lit("T08:00:00")).alias("timestamp"),
        F.col("html").alias("content"),
        theme.alias("theme"),
    )
    writers.write_pages(landed, path, F.col("timestamp").cast("timestamp_ntz"))
    schema = row(**{f.name: f.dataType for f in RAW_PAGE.fields}, slug=TEXT, theme=TEXT)
    stored = readers.day_folders(t.spark, path, schema, "json", "json")
    return stored.where(F.col("theme").isin("STOCK_MARKET", "LATEST"))


@query(
    "theme_precedence",
    """WITH th AS (SELECT doc_id, sha256(text) AS url, CASE lang WHEN 'en' THEN 'Latest' WHEN 'de' THEN 'Tech' WHEN 'fr' THEN 'Stock_Market' ELSE 'Housing' END AS theme FROM documents),
r AS (SELECT *, CASE theme WHEN 'Stock_Market' THEN 0 WHEN 'Tech' THEN 4 WHEN 'Housing' THEN 5 ELSE 7 END AS precedence FROM th)
SELECT url, theme, doc_id FROM r WHERE theme IN ('Latest', 'Tech', 'Stock_Market', 'Housing')
QUALIFY row_number() OVER (PARTITION BY url ORDER BY precedence, doc_id) = 1""",
)
def theme_precedence(t: Tables):
    """One row per text over all themes; the theme that is loaded first keeps it."""
    theme = (
        F.when(F.col("lang") == "en", "Latest")
        .when(F.col("lang") == "de", "Tech")
        .when(F.col("lang") == "fr", "Stock_Market")
        .otherwise("Housing")
    )
    staged = t.documents.select("doc_id", F.sha2("text", 256).alias("url"), theme.alias("theme"))
    # The theme table is a fixed list of eight rows.
    ranked = staged.join(F.broadcast(theme_table(t.spark).drop("listing_url")), "theme")
    wanted = ranked.where(F.col("theme").isin(*readers.themes_for_hour(21)))
    return merge.first_per_key(wanted, ["url"], ["precedence", "doc_id"]).drop("precedence")


_FLAT_SQL = """SELECT 'Company ' || o_custkey AS company_name, CASE WHEN o_orderpriority <> '5-LOW' THEN 'S' || o_custkey END AS symbol,
  o_orderstatus AS country, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
  floor(o_totalprice) / 1000 AS eps_actual_value, NULL::VARCHAR AS eps_actual_unit,
  CASE WHEN o_orderstatus <> 'P' THEN 1.5::DOUBLE END AS eps_forecast_value, NULL::VARCHAR AS eps_forecast_unit,
  o_totalprice AS revenue_actual_value, 'M' AS revenue_actual_unit,
  CASE WHEN o_orderpriority <> '2-HIGH' THEN floor(o_totalprice) END AS revenue_forecast_value, 'M' AS revenue_forecast_unit,
  o_orderkey::DOUBLE AS market_cap_value, 'B' AS market_cap_unit, epoch_us(o_orderdate) // 1000 AS call_date, 'America/New_York' AS timezone
FROM orders"""


@query("nested_flat_roundtrip", _FLAT_SQL)
def nested_flat_roundtrip(t: Tables):
    """Nested records written as JSON envelopes, read back and flattened."""
    path = scratch_dir(t.spark, "envelopes")
    writers.write_envelopes(order_records(t).drop("o_orderkey"), path)
    return flatten_earnings(readers.envelope_rows(t.spark, path, EARNING_RECORD))


@query(
    "swap_publish",
    """WITH first AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
staged AS (SELECT o_orderkey, 'N' AS o_orderstatus, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
SELECT * FROM first WHERE o_orderkey NOT IN (SELECT o_orderkey FROM staged) UNION ALL SELECT * FROM staged""",
)
def swap_publish(t: Tables):
    """A table built, then rebuilt from itself and staged rows, and switched to the new version."""
    base, table = scratch_dir(t.spark, "published"), f"finloom_orders_{uuid.uuid4().hex}"
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    writers.publish(t.orders.where("o_orderdate < TIMESTAMP_NTZ '2000-01-01'").select(*columns), table, f"{base}/v1")
    staging = f"{base}/staging"
    late = t.orders.where("o_orderdate >= TIMESTAMP_NTZ '1999-01-01'").withColumn("o_orderstatus", F.lit("N"))
    late.select(*reversed(columns)).write.parquet(staging)
    current = t.spark.table(table)
    staged = writers.load_staging(t.spark, staging, current.schema)
    writers.publish(merge.replace_by_keys(current, staged, ["o_orderkey"]), table, f"{base}/v2")
    return t.spark.table(table)


@query(
    "partition_upsert",
    """WITH early AS (SELECT user_id, event_type, CAST(ts AS DATE)::VARCHAR AS day, max(ts) AS ts, max(value) AS value
  FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY ALL),
late AS (SELECT user_id, event_type, CAST(ts AS DATE)::VARCHAR AS day, max(ts) AS ts, -max(value) AS value
  FROM events WHERE ts >= TIMESTAMP '2024-01-18' AND (event_type <> 'view' OR ts >= TIMESTAMP '2024-01-20') GROUP BY ALL)
SELECT * FROM late UNION ALL
SELECT * FROM early e WHERE NOT EXISTS (SELECT 1 FROM late l WHERE l.user_id = e.user_id AND l.event_type = e.event_type AND l.day = e.day)""",
)
def partition_upsert(t: Tables):
    """A table stored by day; a late batch rewrites only the days it touches."""
    store, table = Store(t.spark, scratch_dir(t.spark, "by-day")), f"finloom_days_{uuid.uuid4().hex}"
    early = t.events.where("ts < TIMESTAMP_NTZ '2024-01-20'")
    late = t.events.where(
        "ts >= TIMESTAMP_NTZ '2024-01-18' AND (event_type <> 'view' OR ts >= TIMESTAMP_NTZ '2024-01-20')"
    )

    def upsert(stored: DataFrame, new: DataFrame) -> DataFrame:
        return merge.upsert_unique(stored, new, ["user_id", "event_type", "day"], ["ts"])

    for i, (batch, sign) in enumerate(((early, 1), (late, -1))):
        rows = _by_day(batch).withColumn("value", F.col("value") * sign)
        store.merge(table, rows.schema, ["day"], rows, upsert, dt.datetime(2024, 2, 1, i))
    return t.spark.table(table)


def _by_day(events: DataFrame) -> DataFrame:
    days = events.withColumn("day", F.to_date("ts").cast("string")).groupBy("user_id", "event_type", "day")
    return days.agg(F.max("ts").alias("ts"), F.max("value").alias("value")).select(
        "user_id", "event_type", "ts", "value", "day"
    )


@query(
    "append_new_rows",
    "SELECT DISTINCT text, lang FROM documents",
)
def append_new_rows(t: Tables):
    """A declared table filled batch by batch with the rows whose text it lacks."""
    location, table = scratch_dir(t.spark, "appended"), f"finloom_documents_{uuid.uuid4().hex}"
    rows = t.documents.select("text", "lang")
    writers.create_table(t.spark, table, rows.schema, location)
    batches = [rows.where("lang = 'en'"), rows.where("lang IS NULL OR lang <> 'en'"), rows.where("lang = 'en'")]
    for batch in batches:
        fresh = merge.insert_if_absent(t.spark.table(table), batch, ["text", "lang"])
        writers.append_rows(fresh, table)
    return t.spark.table(table)


@query(
    "digest_files",
    f"""WITH {_CALENDAR_SQL}, {_LINES_SQL}, l AS (SELECT unnest(string_split(line, chr(10))) AS value FROM lines WHERE kind = 'recap')
SELECT value, 'EVENTS/year=2024/month=01/day=31/events_24013107' AS folder FROM l WHERE value <> ''""",
)
def digest_files(t: Tables):
    """The digest written as text files, read back line by line."""
    base = scratch_dir(t.spark, "digest")
    parts = ordered_parts(_event_lines(t).where("kind = 'recap'"), [], ["release_time", "event_id"], "line")
    folder = writers.write_digest(parts, base, "events", dt.datetime(2024, 1, 31, 7))
    return t.spark.read.text(folder).where("value <> ''").withColumn("folder", F.lit(folder.removeprefix(f"{base}/")))


def _preview(df: DataFrame, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(5)


@query("preview_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def preview_rows(t: Tables):
    return _preview(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"])


@query(
    "theme_rows",
    "SELECT CASE event_type WHEN 'click' THEN 'Latest' ELSE 'Tech' END AS theme, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1",
)
def theme_rows(t: Tables):
    """The hourly theme subset of a themed table."""
    themed = t.events.withColumn("theme", F.when(F.col("event_type") == "click", THEMES[-1]).otherwise("Tech"))
    return themed.where(F.col("theme").isin(*readers.themes_for_hour(10))).groupBy("theme").agg(F.count("*").alias("n"))


@query(
    "united_folders",
    """SELECT o_orderkey::BIGINT AS key, o_custkey::BIGINT AS customer, o_totalprice::DOUBLE AS price, NULL::VARCHAR AS status,
  NULL::VARCHAR AS note FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, NULL, floor(o_totalprice)::DOUBLE, o_orderstatus, o_custkey::VARCHAR FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderkey, o_custkey, NULL, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 3 = 2""",
)
def united_folders(t: Tables):
    """Three folders whose columns, number types and kinds of a note differ, read as one table."""
    path, key = scratch_dir(t.spark, "differing"), F.col("o_orderkey")
    third = lambda k: t.orders.where(F.pmod(key, F.lit(3)) == k)
    third(0).select(key.cast("int").alias("key"), F.col("o_custkey").cast("int").alias("customer"), F.col("o_totalprice").cast("double").alias("price")).write.parquet(f"{path}/a")
    third(1).select(key.cast("bigint").alias("key"), F.floor("o_totalprice").cast("int").alias("price"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").cast("bigint").alias("note")).write.parquet(f"{path}/b")
    third(2).select(key.cast("bigint").alias("key"), F.col("o_custkey").cast("bigint").alias("customer"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("note")).write.parquet(f"{path}/c")
    return read_united(t.spark, path)[0]


@query(
    "united_report",
    """SELECT * FROM (VALUES ('value', ['date', 'double'], 2::BIGINT)) AS r(column, types, files)
WHERE (SELECT count(*) FROM events) > 0""".replace("r(column,", 'r("column",'),
)
def united_report(t: Tables):
    """The column of two event folders whose kinds cannot be united."""
    path = scratch_dir(t.spark, "torn")
    t.events.select("event_id", "value").coalesce(1).write.parquet(f"{path}/a")
    t.events.select(F.col("event_id").cast("int").alias("event_id"), F.to_date("ts").alias("value")).coalesce(1).write.parquet(f"{path}/b")
    return read_united(t.spark, path)[1]


@query(
    "bucketed_loads",
    """SELECT l_partkey, l_suppkey, min(l_quantity) AS quantity, CAST(min(l_orderkey % 2) AS INTEGER) AS load
FROM lineitem GROUP BY l_partkey, l_suppkey""",
)
def bucketed_loads(t: Tables):
    """Two loads of new keys into a table bucketed by key; the second one leaves the first's rows in place."""
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = t.lineitem.groupBy("l_partkey", "l_suppkey", F.pmod("l_orderkey", F.lit(2)).cast("int").alias("load"))
    least = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.min("l_quantity").alias("quantity"))
    loads = rows.agg(F.count("*").alias("n")).join(least, ["l_partkey", "l_suppkey"]).select("l_partkey", "l_suppkey", "quantity", "load")
    keys, path = ["l_partkey", "l_suppkey"], scratch_dir(t.spark, "bucketed")
    writers.create_table(t.spark, name, loads.schema, path, buckets=16, bucket_by=keys)
    for k in range(2):
        writers.append_new_keys(loads.where(F.col("load") == k), name, keys, 16)
    return t.spark.table(name)


@query(
    "load_metrics",
    """WITH first AS (SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0),
second AS (SELECT o_orderkey, o_orderpriority || '!' AS o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 4 < 2),
now AS (SELECT * FROM second UNION ALL SELECT * FROM first f WHERE NOT EXISTS (SELECT 1 FROM second s WHERE s.o_orderkey = f.o_orderkey))
SELECT 'o_orderstatus=' || o_orderstatus AS part, count(*) AS rows, sum(length(o_orderpriority) + length(o_orderstatus))::BIGINT AS characters
FROM now GROUP BY o_orderstatus""",
)
def load_metrics(t: Tables):
    """Rows and characters of a table's partitions after two loads, as the writes observed them."""
    store, table = Store(t.spark, scratch_dir(t.spark, "metered")), f"finloom_metered_{uuid.uuid4().hex}"
    rows, key = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"), F.col("o_orderkey")
    louder = F.concat("o_orderpriority", F.lit("!"))
    second = rows.where((F.col("o_orderstatus") == "F") & (F.pmod(key, F.lit(4)) < 2)).withColumn("o_orderpriority", louder)
    replace = lambda stored, new: merge.replace_by_keys(stored, new, ["o_orderkey"])
    for hour, batch in enumerate((rows.where(F.pmod(key, F.lit(2)) == 0), second)):
        store.merge(table, rows.schema, ["o_orderstatus"], batch, replace, dt.datetime(2024, 2, 1, hour))
    return store.metrics.latest().select("part", "rows", "characters")


@query(
    "member_loads",
    """WITH b AS (SELECT o_custkey::VARCHAR AS response_id, o_orderdate AS timestamp, o_orderpriority || o_orderkey AS email_address,
  CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END AS load FROM orders)
SELECT response_id, timestamp, email_address FROM b
QUALIFY row_number() OVER (PARTITION BY response_id ORDER BY load DESC, timestamp DESC, email_address DESC) = 1""",
)
def member_loads(t: Tables):
    """Two batches of registrations, members stored by hash bucket: the later batch wins."""
    base = scratch_dir(t.spark, "registered")
    database = f"members_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/db'")
    store, key = Store(t.spark, base, database), F.col("o_custkey").cast("string")
    body = F.to_json(
        F.struct(
            key.alias("responseId"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
            F.concat("o_orderpriority", F.col("o_orderkey").cast("string")).alias("email"),
        )
    )
    for k in range(2):
        bodies = t.orders.where(F.pmod("o_orderkey", F.lit(2)) == k).select(body.alias("body"))
        register_members(store, bodies, dt.datetime(2024, 2, 1, k))
    stored = t.spark.table(store.name("members"))
    return stored.select("response_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "email_address")
