"""Digest rows, digest texts and member messages on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.catalog.registry import Tables, query
from finloom.catalog.scalar_queries import HASH_SQL
from finloom.functions import lines
from finloom.functions.lines import LABELS
from finloom.plans import digests
from finloom.plans.fanout import member_messages
from finloom.plans.jobs import MAIL_SECTIONS
from finloom.schemas import MARKET_ZONE

_UNITS = "CASE o_orderpriority WHEN '1-URGENT' THEN 'K' WHEN '2-HIGH' THEN 'M' WHEN '3-MEDIUM' THEN 'B' WHEN '4-NOT SPECIFIED' THEN 'T' END"
_FORECAST = """CASE o_orderstatus WHEN 'F' THEN CAST({price} AS DECIMAL(20,2)) WHEN 'O' THEN CAST(floor({price}) + 0.25 AS DECIMAL(20,2))
  ELSE CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor({price} / 1000) AS DECIMAL(20,2)) END END"""
_ACTUAL = "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN CAST(0 AS DECIMAL(20,2)) ELSE CAST(o_totalprice AS DECIMAL(20,2)) END"
_FORECAST_UNIT = f"CASE WHEN o_orderstatus = 'P' THEN 'M' ELSE {_UNITS} END"


def _order_star(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders as earnings, customers as companies, order quarters as periods."""
    period = F.year("o_orderdate") * 10 + F.quarter("o_orderdate")
    earnings = t.orders.select(
        F.col("o_custkey").alias("company_id"),
        period.alias("period_id"),
        F.expr(_ACTUAL).alias("revenue_actual"),
        F.expr(_UNITS).alias("revenue_actual_unit"),
        F.expr(_FORECAST.format(price="o_totalprice")).alias("revenue_forecast"),
        F.expr(_FORECAST_UNIT).alias("revenue_forecast_unit"),
        F.col("o_orderdate").alias("call_date"),
    )
    companies = t.customer.select(
        F.col("c_custkey").alias("company_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("symbol")
    )
    periods = t.orders.select(
        period.alias("period_id"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")
    ).distinct()
    return earnings, companies, periods


def _digest_sql(where: str) -> str:
    return f"""e AS (SELECT o_custkey, o_orderdate AS call_date, {_ACTUAL} AS revenue_actual, {_UNITS} AS revenue_actual_unit,
  {_FORECAST.format(price="o_totalprice")} AS revenue_forecast, {_FORECAST_UNIT} AS revenue_forecast_unit,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter FROM orders),
d AS (SELECT c_name AS name, c_mktsegment AS symbol, year, quarter, revenue_forecast, revenue_forecast_unit, revenue_actual, revenue_actual_unit,
  min(call_date) AS call_date FROM e JOIN customer ON o_custkey = c_custkey WHERE revenue_actual <> 0 AND {where} GROUP BY ALL)"""


def _size_sql(unit: str) -> str:
    return f"CAST(CASE {unit} WHEN 'K' THEN 1000 WHEN 'M' THEN 1000000 WHEN 'B' THEN 1000000000 WHEN 'T' THEN 1000000000000 ELSE 1 END AS DECIMAL(13,0))"


def _real_mark_sql(a: str, b: str) -> str:
    return _mark_sql(f"CAST({a} AS FLOAT)", f"CAST({b} AS FLOAT)")


def _mark_sql(a: str, b: str) -> str:
    return f"CASE WHEN {a} > {b} THEN '▲' WHEN {a} < {b} THEN '▼' ELSE '=' END"


_REVENUE_MARK = _mark_sql(
    f"revenue_actual * {_size_sql('revenue_actual_unit')}", f"revenue_forecast * {_size_sql('revenue_forecast_unit')}"
)


@query("earnings_digest_rows", f"WITH {_digest_sql('true')} SELECT *, {_REVENUE_MARK} AS mark FROM d")
def earnings_digest_rows(t: Tables):
    return digests.earning_marks(digests.earnings_digest(*_order_star(t)))


_EARNING_LINE = f"""name || '(' || symbol || ')' || chr(10) || '실제: ' || revenue_actual::VARCHAR || coalesce(revenue_actual_unit, '') ||
  CASE WHEN revenue_forecast <> 0 THEN ' / 기대: ' || revenue_forecast::VARCHAR || coalesce(revenue_forecast_unit, '') || ' → ' || {_REVENUE_MARK}
  ELSE '' END || chr(10) || chr(10)"""


@query(
    "earnings_digest_day",
    f"""WITH {_digest_sql("call_date >= TIMESTAMP '1998-08-02' AND call_date < TIMESTAMP '1998-08-03'")}
SELECT name, symbol, call_date, {_EARNING_LINE} AS line FROM d ORDER BY call_date, name""",
)
def earnings_digest_day(t: Tables):
    rows = digests.earnings_digest(*_order_star(t), day=dt.date(1998, 8, 2))
    return digests.earning_lines(rows).select("name", "symbol", "call_date", "line").orderBy("call_date", "name")


@query(
    "news_window",
    """SELECT event_type AS title, props AS text, min(ts) AS date FROM events
WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' AND ts < TIMESTAMP '2024-01-16 10:30:00' GROUP BY ALL ORDER BY date""",
)
def news_window(t: Tables):
    stories = t.events.select(F.col("event_type").alias("title"), F.col("props").alias("text"), F.col("ts").alias("date"))
    return digests.news_window(stories, dt.datetime(2024, 1, 16, 15, 30)).orderBy("date", "title", "text")


# Events as calendar rows: the forecast is the number in props, the previous value half the user number.
_CALENDAR_SQL = """cal AS (SELECT event_id, ts AS release_time, 'America/New_York' AS timezone, event_type AS country,
  CAST(user_id % 4 AS SMALLINT) AS volatility,
  CASE event_type WHEN 'error' THEN 'Chair ' || user_id || ' Speaks' ELSE event_type END AS title,
  CASE WHEN event_type <> 'signup' THEN CASE WHEN user_id < 3 THEN 0.0 ELSE value END END AS actual,
  CASE WHEN event_type <> 'view' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS forecast,
  CASE WHEN user_id % 5 <> 0 THEN user_id / 2.0 END AS previous,
  CASE event_type WHEN 'click' THEN '%' WHEN 'error' THEN 'K' END AS unit FROM events)"""


def _calendar(t: Tables, *extra: str) -> DataFrame:
    rows = t.events.selectExpr("*", "user_id AS u", "get_json_object(props, '$.k') AS k")
    return rows.select(
        *extra,
        F.col("ts").alias("release_time"),
        F.lit(MARKET_ZONE).alias("timezone"),
        F.col("event_type").alias("country"),
        (F.col("u") % 4).cast("smallint").alias("volatility"),
        F.when(
            F.col("event_type") == "error", F.concat(F.lit("Chair "), F.col("u").cast("string"), F.lit(" Speaks"))
        ).otherwise(F.col("event_type")).alias("title"),
        F.when(F.col("event_type") != "signup", F.when(F.col("u") < 3, F.lit(0.0)).otherwise(F.col("value"))).alias("actual"),
        F.when(F.col("event_type") != "view", F.col("k").cast("double")).alias("forecast"),
        F.when(F.col("u") % 5 != 0, F.col("u") / F.lit(2.0)).alias("previous"),
        F.when(F.col("event_type") == "click", "%").when(F.col("event_type") == "error", "K").alias("unit"),
    )


_DAY_SQL = "release_time >= TIMESTAMP '2024-01-16' AND release_time < TIMESTAMP '2024-01-17'"


@query(
    "events_today_pre",
    f"WITH {_CALENDAR_SQL} SELECT DISTINCT * EXCLUDE (event_id) FROM cal WHERE {_DAY_SQL} ORDER BY release_time",
)
def events_today_pre(t: Tables):
    return digests.events_of_day(_calendar(t), dt.date(2024, 1, 16), 21).orderBy("release_time", "title")


@query(
    "events_today_post",
    f"WITH {_CALENDAR_SQL} SELECT DISTINCT * EXCLUDE (event_id) FROM cal WHERE {_DAY_SQL} AND actual IS NOT NULL ORDER BY release_time",
)
def events_today_post(t: Tables):
    return digests.events_of_day(_calendar(t), dt.date(2024, 1, 16), 7).orderBy("release_time", "title")


def _number_sql(x: str) -> str:
    text = f"CAST(CAST(CAST(CAST({x} AS FLOAT) AS VARCHAR) AS DECIMAL(30,6)) AS VARCHAR)"
    return f"regexp_replace(regexp_replace({text}, '0+$', ''), '\\.$', '.0')"


_CLOCK_SQL = "strftime(timezone('Asia/Seoul', timezone(timezone, release_time)), '%H:%M')"
_HEAD_SQL = f"{_CLOCK_SQL} || ' - ' || title || ' ' || repeat('★', volatility) || chr(10)"
_U = "coalesce(unit, '')"
_PREVIEW_SQL = f"""{_HEAD_SQL} || CASE WHEN contains(title, 'Speaks') THEN ''
  WHEN forecast <> 0 AND previous <> 0 THEN '(예상: ' || {_number_sql("forecast")} || {_U} || ', 이전: ' || {_number_sql("previous")} || {_U} || ')'
  WHEN forecast <> 0 THEN '(예상: ' || {_number_sql("forecast")} || {_U} || ')'
  WHEN previous <> 0 THEN '(이전: ' || {_number_sql("previous")} || {_U} || ')' ELSE '' END || chr(10) || chr(10)"""
_RECAP_SQL = f"""{_HEAD_SQL} || CASE WHEN contains(title, 'Speaks') THEN '' ELSE '실제: ' || {_number_sql("actual")} || {_U} ||
  CASE WHEN forecast <> 0 AND previous <> 0 THEN ' → 예상(' || {_number_sql("forecast")} || {_U} || '): ' || {_real_mark_sql("actual", "forecast")}
      || ', 이전(' || {_number_sql("previous")} || {_U} || '): ' || {_real_mark_sql("actual", "previous")}
    WHEN forecast <> 0 THEN ' → 예상(' || {_number_sql("forecast")} || {_U} || '): ' || {_real_mark_sql("actual", "forecast")}
    WHEN previous <> 0 THEN ' → 이전(' || {_number_sql("previous")} || {_U} || '): ' || {_real_mark_sql("actual", "previous")}
    ELSE '' END END || chr(10) || chr(10)"""
_LINES_SQL = f"""lines AS (SELECT event_id, 'preview' AS kind, release_time, {_PREVIEW_SQL} AS line FROM cal
  UNION ALL SELECT event_id, 'recap', release_time, {_RECAP_SQL} FROM cal WHERE actual IS NOT NULL)"""


def _stored_events(t: Tables) -> DataFrame:
    """The calendar rows with their numbers as the event table stores them, REAL."""
    return _calendar(t, "event_id").withColumns({c: F.col(c).cast("float") for c in ("actual", "forecast", "previous")})


def _event_lines(t: Tables) -> DataFrame:
    rows = _stored_events(t)
    parts = [
        digests.event_lines(rows, hour).select("event_id", F.lit(kind).alias("kind"), "release_time", "line")
        for kind, hour in (("preview", 21), ("recap", 7))
    ]
    return parts[0].unionByName(parts[1])


@query("events_digest_lines", f"WITH {_CALENDAR_SQL}, {_LINES_SQL} SELECT event_id, kind, line FROM lines")
def events_digest_lines(t: Tables):
    return _event_lines(t).select("event_id", "kind", "line")


def _parts_sql(source: str, groups: str, order: str, line: str, per_part: int) -> str:
    by = ", ".join(x for x in (groups, order) if x)
    lead = groups + ", " if groups else ""
    return f"""SELECT {lead}n // {per_part} AS part, string_agg({line}, '' ORDER BY n) AS text
FROM (SELECT *, row_number() OVER (ORDER BY {by}) - 1 AS n FROM {source}) GROUP BY {lead}n // {per_part}"""


@query(
    "digest_text",
    f"WITH {_CALENDAR_SQL}, {_LINES_SQL} {_parts_sql('lines', 'kind', 'release_time, event_id', 'line', 500)}",
)
def digest_text(t: Tables):
    return digests.digest_parts(_event_lines(t), "line", ["release_time", "event_id"], ["kind"])


_ARTICLE_LINE_SQL = "'title: ' || source || chr(10) || 'content' || chr(10) || text || chr(10) || chr(10)"


@query(
    "article_digest_text",
    f"""WITH b AS (SELECT lang, doc_id, {_ARTICLE_LINE_SQL} AS line FROM documents)
{_parts_sql('b', 'lang', 'doc_id', 'line', 20)}""",
)
def article_digest_text(t: Tables):
    blocks = t.documents.select("lang", "doc_id", lines.article_block(F.col("source"), F.col("text")).alias("line"))
    return digests.digest_parts(blocks, "line", ["doc_id"], ["lang"], lines_per_part=20)


@query(
    "mail_text",
    f"""WITH {_CALENDAR_SQL}, {_LINES_SQL}, recap AS (SELECT * FROM lines WHERE kind = 'recap'), {_digest_sql("true")},
blocks AS (SELECT doc_id, {_ARTICLE_LINE_SQL} AS line FROM documents),
money AS (SELECT *, {_EARNING_LINE} AS line FROM d)
SELECT 0 AS section, part, text FROM ({_parts_sql('blocks', '', 'doc_id', 'line', 20)})
UNION ALL SELECT 1, part, text FROM ({_parts_sql('recap', '', 'release_time, event_id', 'line', 500)})
UNION ALL SELECT 2, part, text FROM ({_parts_sql('money', '', 'call_date, name, revenue_actual, line', 'line', 500)})
UNION ALL SELECT unnest([0, 1, 2]), -1, unnest(['【미국 뉴스】', '【지표 발표】', '【실적 발표】']) || chr(10)
UNION ALL SELECT unnest([0, 1]), 4611686018427387904, chr(10) || repeat('-', 116) || chr(10) || chr(10)""",
)
def mail_text(t: Tables):
    blocks = t.documents.select("doc_id", lines.article_block(F.col("source"), F.col("text")).alias("line"))
    recap = digests.event_lines(_stored_events(t), 7)
    money = digests.earning_lines(digests.earnings_digest(*_order_star(t)))
    return digests.mail_parts(
        [
            (MAIL_SECTIONS[0][1], digests.digest_parts(blocks, "line", ["doc_id"], lines_per_part=20)),
            (MAIL_SECTIONS[1][1], digests.digest_parts(recap, "line", ["release_time", "event_id"])),
            (MAIL_SECTIONS[2][1], digests.digest_parts(money, "line", ["call_date", "name", "revenue_actual", "line"])),
        ]
    )


@query(
    "digest_measures",
    f"""WITH {_CALENDAR_SQL}, {_LINES_SQL} SELECT kind, strftime(timezone('Asia/Seoul', timezone('UTC', max(release_time))), '%-H') || '시 뉴스 요약' AS subject,
  count(*) AS rows, CAST(sum(length(line)) AS BIGINT) AS characters FROM lines GROUP BY kind""",
)
def digest_measures(t: Tables):
    latest = F.hour(F.convert_timezone(F.lit("UTC"), F.lit("Asia/Seoul"), F.max("release_time")))
    return (
        _event_lines(t)
        .groupBy("kind")
        .agg(lines.subject(latest, LABELS).alias("subject"), *digests.text_measures("line"))
    )


@query(
    "fanout_groups",
    f"""WITH digest AS (SELECT string_agg(n_name || chr(10), '' ORDER BY n_nationkey) AS text FROM nation),
m AS (SELECT DISTINCT o_custkey::VARCHAR AS response_id, 'c' || o_custkey || '@' || lower(o_orderstatus) || '.example' AS address FROM orders)
SELECT 'group-' || {HASH_SQL.format(x="response_id", n=10)} AS key, to_json({{'text': text, 'address': address}})::VARCHAR AS value FROM m, digest""",
)
def fanout_groups(t: Tables):
    key = F.col("o_custkey").cast("string")
    members = t.orders.select(
        key.alias("response_id"),
        F.concat(F.lit("c"), key, F.lit("@"), F.lower("o_orderstatus"), F.lit(".example")).alias("email_address"),
    )
    # The 25 nation names are the text: one row of fixed size.
    text = t.nation.select("n_nationkey", F.concat("n_name", F.lit("\n")).alias("line")).agg(
        F.expr("listagg(line, '') WITHIN GROUP (ORDER BY n_nationkey)").alias("text")
    )
    return member_messages(members, text)
