"""The incremental jobs run to the end on files cut from the given tables; results equal the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.catalog.page_queries import _EVENT_ROWS_SQL, ARTICLE_ROWS_SQL, article_pages, earning_pages, event_pages
from finloom.catalog.registry import Tables, query
from finloom.operators.merge import last_per_key
from finloom.plans.calendar import parsed_events, split_events
from finloom.schemas import ARTICLES, MEMBERS, TEXT, row
from finloom.session import materialize, scratch_dir
from finloom.sources.readers import member_records
from finloom.streaming import ingest
from finloom.streaming.levels import Levels
from finloom.streaming.pages import ingest_articles, ingest_earnings, ingest_events

_BATCHES = 4


def _arrivals(df: DataFrame, name: str, kind: str = "parquet") -> tuple[str, int]:
    """df as files, one per task, and the number of files that makes about _BATCHES batches."""
    path = scratch_dir(df.sparkSession, name)
    df.write.format(kind).save(path)
    return path, max(1, len(df.sparkSession.read.schema(df.schema).format(kind).load(path).inputFiles()) // _BATCHES)


@query("stream_ingest", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def stream_ingest(t: Tables):
    rows = t.spread("events", "event_id").select("user_id", "event_type", F.to_date("ts").alias("day"))
    (source, files), out = _arrivals(rows, "arrivals"), scratch_dir(t.spark, "unseen")
    stream = ingest.file_stream(t.spark, source, rows.schema, files_per_batch=files)
    ingest.ingest_unseen(stream, rows.columns, f"{out}/rows", f"{out}/checkpoint")
    return ingest.stored_rows(t.spark, f"{out}/rows", rows.schema)


@query("stream_first_seen", "SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(t: Tables):
    rows = t.spread("events", "event_id").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    (source, files), out = _arrivals(rows, "arrivals"), scratch_dir(t.spark, "first-seen")
    stream = ingest.file_stream(t.spark, source, rows.schema, files_per_batch=files)
    ingest.ingest_first_seen(stream, ["user_id", "event_type"], "ts", "60 days", f"{out}/rows", f"{out}/checkpoint")
    return t.spark.read.schema(rows.schema).parquet(f"{out}/rows").select("user_id", "event_type")


@query(
    "stream_revision",
    """SELECT user_id, event_type, CAST(ts AS DATE) AS day, ts, event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""",
)
def stream_revision(t: Tables):
    value = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    rows = t.spread("events", "event_id").select("user_id", "event_type", F.to_date("ts").alias("day"), "ts", "event_id", value)
    (source, files), out = _arrivals(rows, "revisions"), scratch_dir(t.spark, "revised")
    keys, order = ["user_id", "event_type", "day"], ["ts", "event_id"]
    stream = ingest.file_stream(t.spark, source, rows.schema, files_per_batch=files)
    ingest.ingest_revisions(stream, keys, order, f"{out}/rows", f"{out}/checkpoint", by=["day"])
    return ingest.current_rows(t.spark, f"{out}/rows", rows.schema, keys, order)


@query(
    "stream_levels",
    """SELECT l_suppkey, l_partkey, l_shipdate, l_orderkey, l_linenumber, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1""",
)
def stream_levels(t: Tables):
    """Revisions in batches of one order-key slice each, merged three folders at a time on two levels."""
    rows = t.lineitem.select("l_suppkey", "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    keys, order = ["l_suppkey", "l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"]
    out = scratch_dir(t.spark, "levels")
    store = Levels(t.spark, out, rows.schema, keys, lambda r: last_per_key(r, keys, [*order, "batch_id"]), fanout=3)
    for batch in range(10):
        store.add(materialize(last_per_key(rows.where(F.pmod("l_orderkey", F.lit(10)) == batch), keys, order), "slice"), batch)
    return store.combine(store.rows()).drop("batch_id")


@query(
    "stream_members",
    """SELECT o_custkey::VARCHAR AS response_id, max(o_orderdate) AS timestamp,
  max_by('c' || o_custkey || '@' || lower(o_orderpriority) || o_orderkey, (o_orderdate, 'c' || o_custkey || '@' || lower(o_orderpriority) || o_orderkey)) AS email_address
FROM orders GROUP BY o_custkey""",
)
def stream_members(t: Tables):
    key = F.col("o_custkey").cast("string")
    body = F.struct(
        key.alias("responseId"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.concat(F.lit("c"), key, F.lit("@"), F.lower("o_orderpriority"), F.col("o_orderkey").cast("string")).alias("email"),
    )
    bodies = t.spread("orders", "o_orderkey").select(F.to_json(body).alias("body"))
    (source, files), out = _arrivals(bodies, "registrations", "json"), scratch_dir(t.spark, "members")
    stream = member_records(ingest.file_stream(t.spark, source, row(body=TEXT), "json", files_per_batch=files))
    order = ["timestamp", "email_address"]
    ingest.ingest_revisions(stream, ["response_id"], order, f"{out}/rows", f"{out}/checkpoint")
    members = ingest.current_rows(t.spark, f"{out}/rows", MEMBERS, ["response_id"], order)
    return members.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("stream_pages", ARTICLE_ROWS_SQL)
def stream_pages(t: Tables):
    """Article pages landed as JSON files and parsed as they arrive."""
    pages = article_pages(t)
    (source, files), out = _arrivals(pages, "landed", "json"), scratch_dir(t.spark, "parsed-pages")
    ingest_articles(ingest.file_stream(t.spark, source, pages.schema, "json", files), out, f"{out}/checkpoint")
    return ingest.stored_rows(t.spark, f"{out}/rows", ARTICLES)


@query("stream_event_pages", _EVENT_ROWS_SQL)
def stream_event_pages(t: Tables):
    """Calendar pages landed as JSON files and parsed as they arrive."""
    pages = event_pages(t)
    (source, files), out = _arrivals(pages, "landed-events", "json"), scratch_dir(t.spark, "parsed-events")
    ingest_events(ingest.file_stream(t.spark, source, pages.schema, "json", files), F.col("day"), out, f"{out}/checkpoint")
    return t.spark.read.schema(event_row_schema(t)).parquet(f"{out}/rows").drop("batch_id")


def event_row_schema(t: Tables):
    return split_events(parsed_events(event_pages(t).limit(0), F.col("day")))[0].schema


@query(
    "stream_earning_rejects",
    "SELECT 'earnings/' || o_orderkey AS url, 3 AS position, 'too few cells' AS reason FROM orders",
)
def stream_earning_rejects(t: Tables):
    """What cannot be read on earnings pages that arrive as JSON files."""
    pages = earning_pages(t)
    (source, files), out = _arrivals(pages, "landed-earnings", "json"), scratch_dir(t.spark, "parsed-earnings")
    ingest_earnings(ingest.file_stream(t.spark, source, pages.schema, "json", files), F.col("day"), out, f"{out}/checkpoint")
    return t.spark.read.schema("url string, position int, reason string").parquet(f"{out}/rejects").drop("batch_id")
