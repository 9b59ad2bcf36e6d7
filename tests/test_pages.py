"""Hand-written pages of each kind."""

import datetime as dt

from pyspark.sql import functions as F

from finloom.operators.markup import PageRules, Step, Take, read_page
from finloom.plans import articles, calendar

def day():
    return F.lit(dt.date(2025, 3, 25))


def article(byline, stamp="2025-03-25T12:30:00.000Z", wrap="caas article-wrap no-bb", publisher="Reuters Inc"):
    return f"""<div class="top-header"><a class="subtle-link y" title="{publisher}">r</a></div>
<div class="{wrap}"><div class="x cover-title z"> T &amp; <b>b</b> </div>{byline}
<time class="byline-attr-meta-time" data-timestamp="{stamp}">x</time></div>
<div class="body-wrap"><div class="body yf"><p>one <b>two</b></p><script>no</script><!-- c --><p>three<p>four</div>after</div>"""


def by(inner):
    return f'<div class="byline-attr-author y">{inner}</div>'


ARTICLES = {
    "links": article(by("<a>Ann Lee and Bob Ray</a>, <a>Reuters</a> <a> Cy </a>")),
    "image": article(by('<a href="#"><img alt="Dee Poe, writer"></a>'), stamp=""),
    "commas": article(by(" Ann , Bo ")),
    "own": article(by("<a>Reuters</a>")),
    "nobody": article(""),
    "no article": article(by("<a>Ann</a>"), wrap="other"),
}


def parsed(spark, rules=articles.ARTICLE_RULES):
    pages = spark.createDataFrame([(k, v, "Tech") for k, v in ARTICLES.items()], "url string, content string, theme string")
    return articles.parsed_articles(pages, rules)


def test_articles(spark):
    rows, rejects = articles.split_articles(parsed(spark))
    got = {(r.url, r.authors) for r in rows.collect()}
    assert got == {
        ("links", "Ann Lee"), ("links", "Bob Ray"), ("links", "Cy"), ("image", "Dee Poe"),
        ("commas", "Ann"), ("commas", "Bo"), ("own", "Reuters"),
    }
    one = rows.where("authors = 'Cy'").first()
    assert one.title == "T &b" and one.text == "one\ntwo\nthree\nfour"
    assert one.date == dt.datetime(2025, 3, 25, 8, 30) and one.article_publisher == "Reuters Inc"
    assert rows.where("url = 'image'").first().date is None
    assert [tuple(r) for r in rejects.collect()] == [("no article", "Tech", "no article element")]


def test_articles_keep_empty(spark):
    rows, _ = articles.split_articles(parsed(spark), keep_empty=True)
    assert rows.where("url = 'nobody'").first().authors is None


def test_articles_plain_rules(spark):
    rows, _ = articles.split_articles(parsed(spark, articles.PLAIN_ARTICLE_RULES))
    assert {r.authors for r in rows.where("url = 'links'").collect()} == {"Ann Lee and Bob Ray", "Reuters", "Cy"}


def event(time="08:30", title="CPI", act="1.2%", fore="1.3%", prev="1.1%", icons=2):
    bulls = '<i class="grayFullBullishIcon"></i>' * icons
    return f"""<tr class="js-event-item"><td class="first left time js-time"> {time} </td>
<td class="left flagCur noWrap"><span title="United States"></span>USD</td><td class="sentiment">{bulls}<i class="grayEmptyBullishIcon"></i></td>
<td class="left event"><a> {title} </a></td><td class="bold act">{act}</td><td class="fore">{fore}</td><td class="prev"><span>{prev}</span></td></tr>"""


def test_events(spark):
    page = "<table>" + "".join(
        [
            event(),
            event(title="Blank", act="&nbsp;", fore="", prev=""),
            event(title="Big", act="1,200K", fore="", prev="1,100K"),
            event(time="All Day", title="Holiday"),
            event(title="Odd", act="5%", fore="", prev=""),
            event(title="Zero", act="0", fore="0", prev="1", icons=0),
            "<tr class='js-event-item'><td class='event'>Bare</td></tr>",
        ]
    ) + "</table>"
    parsed = calendar.parsed_events(spark.createDataFrame([("u", page)], "url string, content string"), day())
    rows, rejects = calendar.split_events(parsed)
    got = {r.title: r for r in rows.collect()}
    ms = int(dt.datetime(2025, 3, 25, 8, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)
    first = got["CPI"]
    assert (first.release_time, first.country, first.volatility, first.unit) == (ms, "United States", 2, "%")
    assert round(first.actual, 5) == 1.2 and round(first.previous, 5) == 1.1
    assert (got["Blank"].actual, got["Blank"].unit) == (None, None)
    assert (got["Big"].actual, got["Big"].forecast, got["Big"].previous, got["Big"].unit) == (1200.0, None, 1100.0, "K")
    assert (got["Zero"].actual, got["Zero"].volatility) == (0.0, 0)
    assert got["Odd"].actual is None and got["Bare"].release_time is None and "Holiday" not in got
    assert {(r.position, r.reason) for r in rejects.collect()} == {(3, "time"), (4, "number")}
    assert calendar.events_with_iso_time(rows).where("title = 'CPI'").first().time == "2025-03-25T08:30:00"


def test_earnings(spark):
    def row(cells, name="Acme Inc", symbol="<a> ACM </a>"):
        tds = "".join(f"<td>{c}</td>" for c in cells)
        return (
            '<tr><td class="flag"><span title="Japan"></span></td>'
            f'<td class="left noWrap earnCalCompany" title="{name}">x {symbol}</td>{tds}</tr>'
        )

    full = ["1.2", "/&nbsp;&nbsp;1.1", "/1,234.5B", "/&nbsp;--", "3T", "time"]
    page = (
        '<div><table id="earningsCalendarData"><tbody><tr><td>Tuesday</td></tr>'
        + row(full)
        + row(["--", "/ 2K", "", "/", "--", ""], symbol="")
        + row(["1", "2"])
        + "</tbody></table><table><tbody><tr><td>x</td></tr></tbody></table></div>"
    )
    parsed = calendar.parsed_earnings(spark.createDataFrame([("u", page)], "url string, content string"), day())
    records, rejects = calendar.split_earnings(parsed)
    first, second = records.orderBy(F.desc("company.symbol")).collect()
    assert first.company == ("Acme Inc", "ACM") and first.country == "Japan"
    assert first.eps.actual.value == 1.2 and first.eps.forecast.value == 1.1
    assert tuple(first.revenue.actual) == (None, "B") and tuple(first.revenue.forecast) == (None, None)
    assert tuple(first.market_cap) == (3.0, "T") and (first.year, first.quarter) == (2025, 1)
    assert second.company.symbol is None and tuple(second.eps.forecast) == (2.0, "K")
    assert [(r.position, r.reason) for r in rejects.collect()] == [(3, "too few cells")]
    assert calendar.records_without_period(records).columns[-1] == "market cap"
    flat = calendar.earning_calls(records)
    assert len(flat.columns) == 17 and dict(flat.dtypes)["eps_actual_value"] == "float"


def test_listing(spark):
    card = '<div class="x content">{}<div class="footer"><div class="publishing">Wire • {}</div></div></div>'
    page = (
        card.format('<a href="/a">t</a>', " 5 minutes ago ")
        + card.format("", "1 hour ago")
        + '<div class="content"><a href="/b">no age</a></div>'
    )
    rows = articles.listing_links(spark.createDataFrame([("u", page)], "url string, content string"))
    assert [tuple(r) for r in rows.collect()] == [("u", 0, "/a", "5 minutes ago")]


def test_tolerant_markup():
    rules = PageRules({"a": Take((Step("div", id="m"),), "lines"), "n": Take((Step("p"),), "count")})
    html = "<div id=m><p>one<p>two<br/>three</b></div>x<p>&lt;y&gt; <!-- <p> -->z"
    assert read_page(html, rules) == [{"a": "one\ntwo\nthree", "n": 3}]
    assert read_page(None, rules) == [{"a": None, "n": 0}]
