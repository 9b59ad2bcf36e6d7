"""Cells, text, dates and keys on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from finloom.catalog.registry import Tables, query
from finloom.functions import cells, dates, text
from finloom.functions.cells import WHITE_SPACE
from finloom.functions.keys import hash_remainder, message_group
from finloom.operators.project import cast_columns, one_row_per_item, with_defaults
from finloom.schemas import MARKET_ZONE, READER_ZONE

SPACE_SQL = "'" + WHITE_SPACE + "'"
NUMBER_SQL = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def number_sql(x: str) -> str:
    plain = f"trim(replace({x}, ',', ''), {SPACE_SQL})"
    return f"CASE WHEN regexp_matches({plain}, {NUMBER_SQL}) THEN TRY_CAST({plain} AS DOUBLE) END"


_CELL = """CASE o_orderpriority
  WHEN '1-URGENT' THEN concat('/', {thousands}, '.5B')
  WHEN '2-HIGH' THEN concat(CAST(o_orderkey AS {string}), 'K')
  WHEN '3-MEDIUM' THEN '--'
  WHEN '4-NOT SPECIFIED' THEN concat(' ', CAST(o_custkey AS {string}), '.25 ')
  ELSE CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN '-' ELSE concat('1.2.', CAST(o_custkey AS {string}), 'x') END
END"""


@query(
    "parse_value_cells",
    f"""WITH c AS (SELECT o_orderkey, {_CELL.format(thousands="format('{:,}', o_orderkey * 1000 + o_custkey)", string="VARCHAR")} AS cell FROM orders),
s AS (SELECT *, trim(cell, {SPACE_SQL}) AS t, trim(ltrim(cell, '/'), {SPACE_SQL}) AS u FROM c)
SELECT o_orderkey, cell,
  CASE WHEN u = '--' THEN NULL WHEN u <> '' AND NOT regexp_matches(u, '[0-9]$') THEN {number_sql("left(u, length(u) - 1)")} ELSE {number_sql("u")} END AS value,
  CASE WHEN u <> '--' AND u <> '' AND NOT regexp_matches(u, '[0-9]$') THEN right(u, 1) END AS unit,
  CASE WHEN t = '--' THEN NULL WHEN t <> '' AND NOT regexp_matches(t, '[0-9]$') THEN {number_sql("left(t, length(t) - 1)")} ELSE {number_sql("t")} END AS value_with_lead
FROM s""",
)
def parse_value_cells(t: Tables):
    cell = F.expr(_CELL.format(thousands="format_number(o_orderkey * 1000 + o_custkey, 0)", string="STRING"))
    return (
        t.orders.select("o_orderkey", cell.alias("cell"))
        .withColumn("p", cells.parse_value(F.col("cell"), "/"))
        .withColumn("q", cells.parse_value(F.col("cell")))
        .select("o_orderkey", "cell", "p.value", "p.unit", F.col("q.value").alias("value_with_lead"))
    )


_EVENT_CELLS = """l_orderkey, l_linenumber,
  CASE l_returnflag WHEN 'N' THEN '' WHEN 'A' THEN concat(CAST(CAST(l_quantity AS INT) AS {string}), '.5%')
    ELSE CAST(CAST(l_quantity AS INT) AS {string}) END AS previous,
  CASE l_linestatus WHEN 'O' THEN '' ELSE concat({thousands},
    CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linenumber = 1) THEN '%' ELSE '' END) END AS actual,
  concat(CAST(l_linenumber AS {string}), '.1', CASE l_returnflag WHEN 'A' THEN '%' ELSE '' END) AS forecast"""


@query(
    "event_unit_rule",
    f"""WITH c AS (SELECT {_EVENT_CELLS.format(string="VARCHAR", thousands="format('{:,}', CAST(floor(l_extendedprice) AS BIGINT))")} FROM lineitem),
u AS (SELECT *, previous <> '' AND NOT regexp_matches(previous, '[0-9]$') AS has_unit FROM c),
x AS (SELECT l_orderkey, l_linenumber, CASE WHEN has_unit THEN right(previous, 1) END AS unit,
  CASE WHEN has_unit AND actual <> '' THEN left(actual, length(actual) - 1) ELSE actual END AS a,
  CASE WHEN has_unit AND forecast <> '' THEN left(forecast, length(forecast) - 1) ELSE forecast END AS f,
  CASE WHEN has_unit THEN left(previous, length(previous) - 1) ELSE previous END AS p FROM u)
SELECT l_orderkey, l_linenumber, unit, {number_sql("a")} AS actual, {number_sql("f")} AS forecast, {number_sql("p")} AS previous,
  (a <> '' AND ({number_sql("a")}) IS NULL) OR (f <> '' AND ({number_sql("f")}) IS NULL) OR (p <> '' AND ({number_sql("p")}) IS NULL) AS unreadable
FROM x""",
)
def event_unit_rule(t: Tables):
    raw = t.lineitem.selectExpr(
        *_split_columns(
            _EVENT_CELLS.format(string="STRING", thousands="format_number(CAST(floor(l_extendedprice) AS BIGINT), 0)")
        )
    )
    values = cells.event_values(F.col("actual"), F.col("forecast"), F.col("previous"))
    return raw.select("l_orderkey", "l_linenumber", values.alias("v")).select("l_orderkey", "l_linenumber", "v.*")


def _split_columns(select_list: str) -> list[str]:
    """Top-level commas of a select list."""
    out, depth, quoted = [""], 0, False
    for ch in select_list:
        quoted ^= ch == "'"
        depth += 0 if quoted else (ch == "(") - (ch == ")")
        if ch == "," and not quoted and depth == 0:
            out.append("")
        else:
            out[-1] += ch
    return out


@query(
    "slug_urls",
    r"""SELECT page_id, replace(replace(regexp_extract(url, '[^/]*$'), '.html', ''), '-', '_') AS slug,
  regexp_replace(url, '[^/]*$', '') AS folder,
  upper(replace(replace(regexp_extract(url, '//([^/]*)', 1), '.', ' '), ' ', '_')) AS theme
FROM pages""",
)
def slug_urls(t: Tables):
    url = F.col("url")
    host = F.replace(F.regexp_extract(url, "//([^/]*)", 1), F.lit("."), F.lit(" "))
    return t.pages.select(
        "page_id",
        text.slug(url).alias("slug"),
        text.parent_folder(url).alias("folder"),
        text.theme_key(host).alias("theme"),
    )


_MARKED = """concat('【', CAST(n_chars AS {string}), ':', CAST(doc_id AS {string}), '†', source, '】 ', text, {nl}, {nl}, '  【4:0†', lang, '】tail')"""
# DuckDB's \s is ASCII only; the other white space is listed.
_SPACE_CLASS = "[" + WHITE_SPACE + "]"


@query(
    "citation_clean",
    f"""WITH m AS (SELECT doc_id, regexp_replace({_MARKED.format(string="VARCHAR", nl="chr(10)")}, '【[0-9]+:[0-9]+†[^\\n]*?】', '', 'g') AS t FROM documents)
SELECT doc_id, regexp_replace(t, '(?m)^{_SPACE_CLASS}+', '', 'g') AS cleaned,
  length(regexp_replace(t, '(?m)^{_SPACE_CLASS}+', '', 'g')) AS characters FROM m""",
)
def citation_clean(t: Tables):
    marked = F.expr(_MARKED.format(string="STRING", nl="char(10)"))
    cleaned = t.documents.select("doc_id", text.clean_text(marked).alias("cleaned"))
    return cleaned.withColumn("characters", F.length("cleaned").cast("bigint"))


@query(
    "decimal_default",
    """SELECT c_custkey, coalesce(CAST(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS DECIMAL(20,2)), 0)::DECIMAL(20,2) AS balance,
  coalesce(CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END, '') AS name FROM customer""",
)
def decimal_default(t: Tables):
    rows = t.customer.select(
        "c_custkey",
        cells.decimal_or_zero(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")), 20, 2).alias("balance"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("name"),
    )
    return with_defaults(rows, {"name": ""})


@query(
    "cast_by_map",
    """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
  CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_discount AS FLOAT) AS l_discount, CAST(l_shipdate AS DATE) AS l_shipdate,
  'America/New_York' AS timezone, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter,
  'l_missing' AS not_found FROM lineitem""",
)
def cast_by_map(t: Tables):
    kinds = {
        "l_orderkey": "string",
        "l_linenumber": "smallint",
        "l_quantity": "float",
        "l_discount": "float",
        "l_shipdate": "date",
        "l_missing": "float",
    }
    rows, missing = cast_columns(t.lineitem, kinds)
    return rows.select(
        *[c for c in kinds if c not in missing],
        F.lit(MARKET_ZONE).alias("timezone"),
        F.year("l_shipdate").alias("year"),
        F.quarter("l_shipdate").alias("quarter"),
        F.lit(",".join(missing)).alias("not_found"),
    )


@query(
    "epoch_roundtrip",
    """SELECT event_id, (epoch_us(ts) // 1000) AS ms, make_timestamp((epoch_us(ts) // 1000) * 1000) AS back,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%H:%M') AS clock, date_trunc('minute', ts)::TIMESTAMP AS released,
  CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter,
  (epoch_us(date_trunc('day', ts)::TIMESTAMP) // 1000) AS midnight, CAST(ts AS DATE) - 1 AS day_before, CAST(ts AS DATE) + 1 AS day_after,
  strftime(ts, '%y%m%d%H') AS stamp FROM events""",
)
def epoch_roundtrip(t: Tables):
    ts = F.col("ts")
    day = F.to_date(ts)
    return t.events.select(
        "event_id",
        dates.to_epoch_ms(ts).alias("ms"),
        dates.from_epoch_ms(dates.to_epoch_ms(ts)).alias("back"),
        dates.iso_text(ts).alias("iso"),
        F.date_format(ts, "HH:mm").alias("clock"),
        dates.clock_on(day, F.date_format(ts, "HH:mm")).alias("released"),
        F.year(ts).alias("year"),
        F.quarter(ts).alias("quarter"),
        dates.midnight_ms(day).alias("midnight"),
        F.date_sub(day, 1).alias("day_before"),
        F.date_add(day, 1).alias("day_after"),
        F.date_format(ts, "yyMMddHH").alias("stamp"),
    )


@query(
    "tz_shift",
    """WITH s AS (SELECT event_id, ts, CASE event_type WHEN 'view' THEN 'UTC' ELSE 'America/New_York' END AS zone,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') || 'Z' AS stamp FROM events)
SELECT event_id, zone, timezone('Asia/Seoul', timezone(zone, ts)) AS seoul, timezone('America/New_York', timezone('UTC', ts)) AS market,
  strftime(timezone('Asia/Seoul', timezone(zone, ts)), '%H:%M') AS clock,
  timezone('America/New_York', timezone('UTC', make_timestamp((epoch_us(ts) // 1000) * 1000))) AS parsed FROM s""",
)
def tz_shift(t: Tables):
    zone = F.when(F.col("event_type") == "view", "UTC").otherwise(MARKET_ZONE)
    seoul = dates.shift_zone(F.col("zone"), READER_ZONE, F.col("ts"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return t.events.withColumn("zone", zone).select(
        "event_id",
        "zone",
        seoul.alias("seoul"),
        dates.shift_zone("UTC", MARKET_ZONE, F.col("ts")).alias("market"),
        F.date_format(seoul, "HH:mm").alias("clock"),
        dates.parse_utc_stamp(stamp, MARKET_ZONE).alias("parsed"),
    )


# The age a listing card would show for an event when the listing is read at the end of January.
_CARD = """concat(event_type, ' • ', CAST(user_id AS {string}), ' • ', CASE
  WHEN {minutes} < 60 THEN concat(CAST({minutes} AS {string}), CASE {minutes} WHEN 1 THEN ' minute ago' ELSE ' minutes ago' END)
  WHEN {minutes} < 1440 THEN concat(CAST({hours} AS {string}), ' hours ago')
  WHEN {minutes} < 2880 THEN 'yesterday'
  WHEN {minutes} < 4320 THEN 'last week'
  ELSE concat(CAST({days} AS {string}), ' days ago') END, ' ')"""
_MINUTES_SPARK = "(1706659200000 - unix_millis(CAST(ts AS TIMESTAMP))) DIV 60000"
_MINUTES_DUCK = "((1706659200000 - (epoch_us(ts) // 1000)) // 60000)"
_CARD_SPARK = _CARD.format(
    string="STRING", minutes=f"({_MINUTES_SPARK})", hours=f"({_MINUTES_SPARK}) DIV 60", days=f"({_MINUTES_SPARK}) DIV 1440"
)
_CARD_DUCK = _CARD.format(
    string="VARCHAR", minutes=_MINUTES_DUCK, hours=f"({_MINUTES_DUCK} // 60)", days=f"({_MINUTES_DUCK} // 1440)"
)
_AGES_SQL = f"""ages AS (SELECT event_id, event_type, ts, trim(regexp_extract({_CARD_DUCK}, '[^•]*$')) AS age FROM events)"""


def _ages(t: Tables):
    return t.events.select("event_id", "event_type", "ts", text.age_text(F.expr(_CARD_SPARK)).alias("age"))


@query(
    "age_filters",
    f"""WITH {_AGES_SQL} SELECT event_id, age, age <> 'yesterday' AS not_yesterday,
  regexp_matches(age, '([0-9]+)\\s*(minutes?)') AS minutes_old FROM ages""",
)
def age_filters(t: Tables):
    age = F.col("age")
    return _ages(t).select(
        "event_id",
        "age",
        text.is_not_yesterday(age).alias("not_yesterday"),
        text.is_minutes_old(age).alias("minutes_old"),
    )


@query(
    "listing_freshness",
    f"""WITH {_AGES_SQL} SELECT event_type, CAST(ts AS DATE) AS day, bool_or(regexp_matches(age, '[0-9]')) AS fresh,
  count(*) AS cards FROM ages GROUP BY ALL""",
)
def listing_freshness(t: Tables):
    return (
        _ages(t)
        .groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(F.bool_or(text.has_digit(F.col("age"))).alias("fresh"), F.count("*").alias("cards"))
    )


@query(
    "authors_1nf",
    """WITH b AS (SELECT c_custkey, n_name || ' Press' AS publisher,
  string_split(c_name || ' and ' || c_mktsegment || ', ' || n_name || ',  Desk ' || c_nationkey || ' and  Co ', ', ') AS names
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
i AS (SELECT c_custkey, publisher, unnest(names) AS name, generate_subscripts(names, 1) - 1 AS i FROM b),
k AS (SELECT c_custkey, trim(name) AS name, publisher FROM i WHERE i = 0 OR NOT contains(publisher, trim(name)))
SELECT c_custkey, publisher, trim(unnest(string_split(name, ' and '))) AS author FROM k""",
)
def authors_1nf(t: Tables):
    byline = F.concat_ws(
        "",
        "c_name",
        F.lit(" and "),
        "c_mktsegment",
        F.lit(", "),
        "n_name",
        F.lit(",  Desk "),
        F.col("c_nationkey").cast("string"),
        F.lit(" and  Co "),
    )
    none = F.array().cast("array<string>")
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.concat("n_name", F.lit(" Press")).alias("publisher"), byline.alias("byline")
    )
    names = text.byline_authors(none, F.lit(None).cast("string"), F.col("byline"))
    listed = rows.select("c_custkey", "publisher", text.clean_authors(names, F.col("publisher")).alias("author"))
    return one_row_per_item(listed, ["author"])


HASH_SQL = (
    "CAST(list_reduce(list_transform(range(1, 65), lambda i: CAST(strpos('0123456789abcdef', "
    "substr(sha256(CAST({x} AS VARCHAR)), CAST(i AS INTEGER), 1)) - 1 AS BIGINT)), lambda a, b: (a * 16 + b) % {n}) AS BIGINT)"
)


@query(
    "hash_groups",
    f"""SELECT c_custkey, 'group-' || {HASH_SQL.format(x="c_custkey", n=10)} AS message_group,
  {HASH_SQL.format(x="c_name", n=997)} AS name_bucket FROM customer""",
)
def hash_groups(t: Tables):
    return t.customer.select(
        "c_custkey",
        message_group(F.col("c_custkey")).alias("message_group"),
        hash_remainder(F.col("c_name"), 997).alias("name_bucket"),
    )
