"""Page extraction: the stored pages, and calendar and article pages that Spark builds from tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.catalog.registry import Tables, query
from finloom.catalog.scalar_queries import SPACE_SQL
from finloom.functions import text
from finloom.functions.cells import strip
from finloom.operators.markup import PageRules, Step, Take, page_rows
from finloom.plans import articles, calendar

_LINK = '<a href="([^"]*)">([^<]*)</a>'


@query(
    "page_titles",
    f"""SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1), {SPACE_SQL}) AS title,
  contains(html, ' the ') AS has_the FROM pages""",
)
def page_titles(t: Tables):
    return t.pages.select(
        "page_id",
        strip(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"),
        F.contains(F.col("html"), F.lit(" the ")).alias("has_the"),
    )


@query(
    "page_links",
    f"""WITH l AS (SELECT page_id, regexp_extract_all(html, '{_LINK}', 1) AS h, regexp_extract_all(html, '{_LINK}', 2) AS w FROM pages),
x AS (SELECT page_id, unnest(h) AS link, unnest(w) AS words, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS position FROM l)
SELECT page_id, position, link, words FROM x WHERE position > 0""",
)
def page_links(t: Tables):
    links, words = [F.regexp_extract_all("html", F.lit(_LINK), F.lit(i)) for i in (1, 2)]
    found = t.pages.select(
        "page_id", F.posexplode(F.arrays_zip(links.alias("link"), words.alias("words"))).alias("position", "a")
    )
    return found.where("position > 0").select("page_id", "position", "a.link", "a.words")


@query(
    "page_icon_counts",
    """SELECT page_id, CAST(len(regexp_extract_all(html, '<p>')) AS INTEGER) AS paragraphs,
  CAST(len(regexp_extract_all(html, '<b>')) AS INTEGER) AS bolds FROM pages""",
)
def page_icon_counts(t: Tables):
    return t.pages.select(
        "page_id",
        F.regexp_count("html", F.lit("<p>")).alias("paragraphs"),
        F.regexp_count("html", F.lit("<b>")).alias("bolds"),
    )


_ARTICLE_PART = "regexp_extract(html, '(?s)<article>(.*)</article>', 1)"


@query(
    "page_body_text",
    f"""WITH a AS (SELECT page_id, array_to_string(list_filter(list_transform(regexp_split_to_array({_ARTICLE_PART}, '<[^>]*>'),
  lambda r: trim(r, {SPACE_SQL})), lambda r: r <> ''), chr(10)) AS body FROM pages)
SELECT page_id, body, length(body) AS characters FROM a""",
)
def page_body_text(t: Tables):
    body = text.text_after_tags(F.regexp_extract("html", "(?s)<article>(.*)</article>", 1))
    return t.pages.select("page_id", body.alias("body")).withColumn("characters", F.length("body").cast("bigint"))


STORED_PAGE_RULES = PageRules(
    {
        "title": Take((Step("title"),)),
        "head": Take((Step("article"), Step("h1")), "tight"),
        "links": Take((Step("nav"), Step("a")), "all tight"),
        "first_href": Take((Step("nav"), Step("a")), "attribute", "href"),
        "paragraphs": Take((Step("p"),), "count"),
        "body": Take((Step("article"),), "lines"),
        "footer": Take((Step("footer"),)),
    }
)

# The entities that occur in the stored pages; HTML allows them without the semicolon.
_ENTITIES = {"copy": "©", "middot": "·", "lt": "<", "gt": ">", "quot": '"', "nbsp": "\u00a0", "amp": "&"}


def _decoded_sql(x: str) -> str:
    for entity, char in _ENTITIES.items():
        x = f"regexp_replace({x}, '&{entity};?', '{char}', 'g')"
    return x


@query(
    "page_fields",
    f"""WITH a AS (SELECT page_id, html, list_filter(list_transform(regexp_split_to_array({_ARTICLE_PART}, '<[^>]*>'),
    lambda r: trim({_decoded_sql("r")}, {SPACE_SQL})), lambda r: r <> '') AS runs FROM pages)
SELECT page_id, trim({_decoded_sql("regexp_extract(html, '<title>([^<]*)</title>', 1)")}, {SPACE_SQL}) AS title,
  trim({_decoded_sql("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}, {SPACE_SQL}) AS head,
  array_to_string(list_transform(regexp_extract_all(html, '{_LINK}', 2), lambda w: trim(w, {SPACE_SQL})), '|') AS links,
  regexp_extract(html, '{_LINK}', 1) AS first_href,
  CAST(len(regexp_extract_all(html, '<p>')) AS INTEGER) AS paragraphs,
  array_to_string(runs, chr(10)) AS body,
  trim({_decoded_sql("regexp_extract(html, '<footer>([^<]*)</footer>', 1)")}, {SPACE_SQL}) AS footer
FROM a""",
)
def page_fields(t: Tables):
    parsed = t.pages.select("page_id", page_rows(F.col("html"), STORED_PAGE_RULES)[0].alias("f"))
    return parsed.select("page_id", "f.*").withColumn("links", F.array_join("links", "|"))


def _markup(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _escaped(x: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        x = F.replace(x, F.lit(char), F.lit(entity))
    return x


def event_pages(t: Tables, events: DataFrame | None = None, keep: Sequence[str] = ()):
    """One calendar page per event: a released row, a speech, and a row without a time.

    Of all events, or of rows of that table that are dealt already, whose columns of `keep` are carried along.
    """
    value = F.col("value").cast("decimal(10,2)").cast("string")
    unit = F.when(F.col("event_type") == "click", "%").when(F.col("event_type") == "error", "K").otherwise("")

    def row(clock: str | Column, icons: Column, title: str | Column, act: Column, fore: Column, prev: Column) -> Column:
        return _markup(
            '<tr class="js-event-item even" id="r"><td class="first left time js-time">',
            clock,
            '</td><td class="left flagCur noWrap"><span title="',
            F.col("event_type"),
            '" class="flag">&nbsp;</span> USD</td><td class="sentiment">',
            F.repeat(F.lit('<i class="grayFullBullishIcon"></i>'), icons),
            '<i class="grayEmptyBullishIcon"></i></td><td class="left event"><a>',
            title,
            '</a></td><td class="bold act">',
            act,
            '</td><td class="fore">',
            fore,
            '</td><td class="prev"><span>',
            prev,
            "</span></td></tr>",
        )

    none, user = F.lit("&nbsp;"), F.col("user_id").cast("string")
    icons = (F.col("user_id") % 4).cast("int")
    forecast = F.when(F.col("event_type") == "view", "").otherwise(F.concat(F.lit("1,"), F.lpad(user, 3, "0"), unit))
    actual = F.when(F.col("event_type") == "signup", "").otherwise(F.concat(value, unit))
    content = _markup(
        '<html><body><table><tbody><tr class="theDay"><td>Day</td></tr>',
        row(F.date_format("ts", " HH:mm "), icons, F.concat(F.col("event_type"), F.lit(" &amp; sons")), actual, forecast,
            F.concat(user, F.lit(".5"), unit)),
        row("09:05", F.lit(1), "Chair Speaks", none, none, none),
        row("All Day", F.lit(0), "Holiday", none, none, none),
        "</tbody></table></body></html>",
    )
    events = t.spread("events", "event_id") if events is None else events
    return events.select(
        *keep,
        F.concat(F.lit("calendar/"), F.col("event_id").cast("string")).alias("url"),
        F.to_date("ts").alias("day"),
        content.alias("content"),
    )


_EVENT_ROWS_SQL = """WITH e AS (SELECT *, CASE event_type WHEN 'click' THEN '%' WHEN 'error' THEN 'K' ELSE '' END AS u FROM events),
full_rows AS (SELECT epoch_us(date_trunc('minute', ts)::TIMESTAMP) // 1000 AS release_time, event_type AS country,
    CAST(user_id % 4 AS SMALLINT) AS volatility, event_type || ' & sons' AS title,
    CAST(CASE WHEN event_type <> 'signup' THEN CAST(value AS DECIMAL(10,2))::VARCHAR::DOUBLE END AS FLOAT) AS actual,
    CAST(CASE WHEN event_type <> 'view' THEN ('1' || lpad(user_id::VARCHAR, 3, '0'))::DOUBLE END AS FLOAT) AS forecast,
    CAST((user_id::VARCHAR || '.5')::DOUBLE AS FLOAT) AS previous, CASE WHEN u <> '' THEN u END AS unit FROM e),
speeches AS (SELECT epoch_us(date_trunc('day', ts)::TIMESTAMP + INTERVAL 545 MINUTE) // 1000 AS release_time, event_type AS country,
    CAST(1 AS SMALLINT) AS volatility, 'Chair Speaks' AS title, NULL::FLOAT AS actual, NULL::FLOAT AS forecast, NULL::FLOAT AS previous, NULL::VARCHAR AS unit FROM e)
SELECT *, 'America/New_York' AS timezone FROM full_rows UNION ALL SELECT *, 'America/New_York' FROM speeches"""


@query("event_rows", _EVENT_ROWS_SQL)
def event_rows(t: Tables):
    return calendar.split_events(calendar.parsed_events(event_pages(t), F.col("day")))[0]


@query(
    "event_rejects",
    "SELECT 'calendar/' || event_id AS url, 2 AS position, 'time' AS reason FROM events",
)
def event_rejects(t: Tables):
    return calendar.split_events(calendar.parsed_events(event_pages(t), F.col("day")))[1]


@query(
    "event_rows_iso",
    f"""SELECT strftime(make_timestamp(release_time * 1000), '%Y-%m-%dT%H:%M:%S') AS time, 'ET' AS utc,
  country, volatility, title, actual, forecast, previous, unit FROM ({_EVENT_ROWS_SQL})""",
)
def event_rows_iso(t: Tables):
    return calendar.events_with_iso_time(event_rows(t))


def earning_pages(t: Tables):
    """One earnings page per order: a heading, a full row, a row still open and a row cut short."""
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    dollars = F.format_number(F.floor("o_totalprice"), 0)

    def row(name: Column, symbol: str | Column, cells: list[str | Column]) -> Column:
        head = [
            '<tr><td class="flag"><span title="', F.col("o_orderpriority"), '" class="ceFlags"></span></td>',
            '<td class="left noWrap earnCalCompany" title="', name, '"><span>', name, "</span> (", symbol, ")</td>",
        ]
        return _markup(*head, *[p for c in cells for p in ("<td class=x> ", c, " </td>")], "</tr>")

    company = F.concat(F.lit("Company "), cust)
    content = _markup(
        '<table id="earningsCalendarData"><thead><tr><th>x</th></tr></thead><tbody><tr><td>day</td></tr>',
        row(company, _markup("<a> S", cust, " </a>"),
            [_markup(cust, ".25"), _markup("/&nbsp;&nbsp;", cust, ".5"), _markup(dollars, "M"), _markup("/&nbsp;", dollars, ".5B"),
             _markup(key, "T")]),
        row(F.concat(company, F.lit(" &amp; Co")), "none", ["--", "/&nbsp;--", "--", "/", ""]),
        row(company, _markup("<a>", key, "</a>"), ["1", "/2"]),
        "</tbody></table>",
    )
    return t.spread("orders", "o_orderkey").select(
        F.concat(F.lit("earnings/"), key).alias("url"), F.to_date("o_orderdate").alias("day"), content.alias("content")
    )


_CALLS = """epoch_us(o_orderdate) // 1000 AS call_date, 'America/New_York' AS timezone,
  CAST(year(o_orderdate) AS SMALLINT) AS year, CAST(quarter(o_orderdate) AS SMALLINT) AS quarter, o_orderpriority AS country"""


@query(
    "earning_rows",
    f"""SELECT 'Company ' || o_custkey AS company_name, 'S' || o_custkey AS symbol, {_CALLS},
  CAST((o_custkey::VARCHAR || '.25')::DOUBLE AS FLOAT) AS eps_actual_value, NULL::VARCHAR AS eps_actual_unit,
  CAST((o_custkey::VARCHAR || '.5')::DOUBLE AS FLOAT) AS eps_forecast_value, NULL::VARCHAR AS eps_forecast_unit,
  CAST(floor(o_totalprice) AS FLOAT) AS revenue_actual_value, 'M' AS revenue_actual_unit,
  CAST(floor(o_totalprice) + 0.5 AS FLOAT) AS revenue_forecast_value, 'B' AS revenue_forecast_unit,
  CAST(o_orderkey::DOUBLE AS FLOAT) AS market_cap_value, 'T' AS market_cap_unit FROM orders
UNION ALL SELECT 'Company ' || o_custkey || ' & Co', NULL, {_CALLS},
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM orders""",
)
def earning_rows(t: Tables):
    parsed = calendar.parsed_earnings(earning_pages(t), F.col("day"))
    return calendar.earning_calls(calendar.split_earnings(parsed)[0])


@query(
    "earning_rejects",
    "SELECT 'earnings/' || o_orderkey AS url, 3 AS position, 'too few cells' AS reason FROM orders",
)
def earning_rejects(t: Tables):
    return calendar.split_earnings(calendar.parsed_earnings(earning_pages(t), F.col("day")))[1]


def article_pages(t: Tables):
    """One article page per document; French ones have an image byline, German ones a text byline,
    and Spanish ones lack the article element."""
    paragraphs = F.replace(_escaped(F.col("text")), F.lit("\n"), F.lit("</p><p>"))
    byline = (
        F.when(F.col("lang") == "fr", _markup('<a href="#"><img alt="', F.col("source"), ', staff"></a>'))
        .when(F.col("lang") == "de", _markup(" ", F.col("source"), " , Wire,  Ana "))
        .otherwise(_markup("<a>Ann and ", F.col("source"), "</a><a>Wire</a><a> Bo </a>"))
    )
    stamp = _markup("2025-03-", F.lpad((F.col("n_chars") % 28 + 1).cast("string"), 2, "0"), "T12:30:00.250Z")
    content = _markup(
        '<div class="top-header"><span><a class="subtle-link fin" title="The Wire">x</a></span></div><div class="',
        F.when(F.col("lang") == "es", "plain").otherwise("caas-article-wrap x"),
        '"><div class="cover-title y"> ', F.col("source"), " <b>", F.col("lang"), '</b></div><div class="byline-attr-author">',
        byline,
        '</div><time class="byline-attr-meta-time" data-timestamp="', stamp,
        '">then</time></div><div class="body-wrap"><!-- ad --><div class="body z"><p>',
        paragraphs,
        "</p><script>var x = '<p>no</p>';</script></div></div>",
    )
    return t.spread("documents", "doc_id").select(
        F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string"), F.lit(".html")).alias("url"),
        content.alias("content"),
        F.when(F.col("lang") == "en", "Tech").otherwise("Latest").alias("theme"),
    )


_ARTICLE_BASE_SQL = f"""a AS (SELECT 'https://news.example/' || doc_id || '.html' AS url, source || lang AS title,
  timezone('America/New_York', timezone('UTC', CAST('2025-03-' || lpad((n_chars % 28 + 1)::VARCHAR, 2, '0') || ' 12:30:00.25' AS TIMESTAMP))) AS date,
  CASE lang WHEN 'en' THEN 'Tech' ELSE 'Latest' END AS theme, source, lang,
  array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda r: trim(r, {SPACE_SQL})), lambda r: r <> ''), chr(10)) AS text
  FROM documents WHERE lang <> 'es')"""


ARTICLE_ROWS_SQL = f"""WITH {_ARTICLE_BASE_SQL}, n AS (SELECT *, unnest(CASE lang WHEN 'fr' THEN [source] WHEN 'de' THEN [source, 'Ana']
    ELSE ['Ann', source, 'Bo'] END) AS one FROM a)
SELECT 'The Wire' AS article_publisher, one AS authors, date, text, theme, 'America/New_York' AS timezone, title, url FROM n"""


@query("article_rows", ARTICLE_ROWS_SQL)
def article_rows(t: Tables):
    return articles.split_articles(articles.parsed_articles(article_pages(t)))[0]


@query(
    "article_rejects",
    """SELECT 'https://news.example/' || doc_id || '.html' AS url, 'Latest' AS theme, 'no article element' AS reason
FROM documents WHERE lang = 'es'""",
)
def article_rejects(t: Tables):
    return articles.split_articles(articles.parsed_articles(article_pages(t)))[1]


@query(
    "article_rows_plain",
    f"""WITH {_ARTICLE_BASE_SQL}, n AS (SELECT *, unnest(CASE lang WHEN 'fr' THEN [source] WHEN 'de' THEN [source, 'Wire', 'Ana']
    ELSE ['Ann and ' || source, 'Wire', 'Bo'] END) AS one FROM a)
SELECT '' AS article_publisher, one AS authors, date, text, theme, 'America/New_York' AS timezone, title, url FROM n""",
)
def article_rows_plain(t: Tables):
    parsed = articles.parsed_articles(article_pages(t), articles.PLAIN_ARTICLE_RULES)
    return articles.split_articles(parsed)[0]


@query(
    "article_fields_native",
    """SELECT 'https://news.example/' || doc_id || '.html' AS url, 'The Wire' AS publisher,
  '2025-03-' || lpad((n_chars % 28 + 1)::VARCHAR, 2, '0') || 'T12:30:00.250Z' AS stamp FROM documents""",
)
def article_fields_native(t: Tables):
    """Attributes of regular article pages without a parse."""
    html = F.col("content")
    return article_pages(t).select(
        "url",
        text.tag_attribute(text.opening_tag(html, "a", "subtle-link"), "title").alias("publisher"),
        text.tag_attribute(text.opening_tag(html, "time", "byline-attr-meta-time"), "data-timestamp").alias("stamp"),
    )


@query(
    "event_icons_native",
    "SELECT 'calendar/' || event_id AS url, CAST(user_id % 4 + 1 AS INTEGER) AS icons FROM events",
)
def event_icons_native(t: Tables):
    return event_pages(t).select("url", text.class_count(F.col("content"), "i", "grayFullBullishIcon").alias("icons"))


@query(
    "listing_links",
    """WITH o AS (SELECT o_orderkey, o_orderpriority FROM orders),
c AS (SELECT o_orderkey, 0 AS position, '/a-' || o_orderkey AS link, '5 minutes ago' AS age FROM o
  UNION ALL SELECT o_orderkey, 1, '/b-' || o_orderkey, lower(o_orderpriority) FROM o)
SELECT 'listing/' || o_orderkey AS url, position, link, age FROM c""",
)
def listing_links(t: Tables):
    key = F.col("o_orderkey").cast("string")

    def card(href: str | Column, footer: str | Column) -> Column:
        return _markup('<div class="yf content x"><a href="', href, '">t</a>', footer, "</div>")

    age = _markup('<div class="footer"><div class="publishing y">Wire <i>•</i> x • ', F.lower("o_orderpriority"), " </div></div>")
    content = _markup(
        "<section>",
        card(_markup("/a-", key), '<div class="footer"><div class="publishing">Wire • 5 minutes ago</div></div>'),
        card(_markup("/b-", key), age),
        card(_markup("/c-", key), ""),
        '<div class="content"><div class="footer"><div class="publishing">Wire • 1 hour ago</div></div></div></section>',
    )
    pages = t.spread("orders", "o_orderkey").select(F.concat(F.lit("listing/"), key).alias("url"), content.alias("content"))
    return articles.listing_links(pages)
