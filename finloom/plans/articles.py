"""Article pages -> article rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.functions.cells import strip
from finloom.functions.dates import parse_utc_stamp
from finloom.functions.text import age_text, byline_authors, clean_authors
from finloom.operators.markup import PageRules, Step, Take, page_rows
from finloom.operators.project import align, one_row_per_item
from finloom.schemas import ARTICLES, MARKET_ZONE

_WRAP = Step("div", class_part="article-wrap")
_BYLINE = Step("div", class_part="byline-attr-author")

# Where the fields of an article page are.
ARTICLE_RULES = PageRules(
    {
        "wraps": Take((_WRAP,), "count"),
        "title": Take((_WRAP, Step("div", class_part="cover-title")), "tight"),
        "publisher": Take((Step(classes=("top-header",)), Step(classes=("subtle-link",))), "attribute", "title"),
        "links": Take((_WRAP, _BYLINE, Step("a")), "all tight"),
        "image_alt": Take((_WRAP, _BYLINE, Step("a"), Step("img")), "attribute", "alt"),
        "byline": Take((_WRAP, _BYLINE), "raw"),
        "stamp": Take((_WRAP, Step("time", class_part="byline-attr-meta-time")), "attribute", "data-timestamp"),
        "text": Take((Step("div", class_part="body-wrap"), Step("div", class_part="body")), "lines"),
    }
)
# The reduced rules: no publisher and no author clean-up.
PLAIN_ARTICLE_RULES = PageRules({k: v for k, v in ARTICLE_RULES.fields.items() if k != "publisher"})


def parsed_articles(pages: DataFrame, rules: PageRules = ARTICLE_RULES) -> DataFrame:
    """One record per page, with a list of authors.

    `wraps` = 0 marks a page that is no article, -1 one without content.
    """
    parsed = pages.withColumn("_a", page_rows(F.coalesce("content", F.lit("")), rules)[0])
    blank = F.lit("")
    authors = byline_authors(F.col("_a.links"), F.col("_a.image_alt"), F.col("_a.byline"))
    publisher = F.coalesce(F.col("_a.publisher"), blank) if "publisher" in rules.fields else blank
    return parsed.select(
        F.coalesce(F.col("_a.title"), blank).alias("title"),
        F.coalesce(F.col("_a.stamp"), blank).alias("date"),
        F.lit(MARKET_ZONE).alias("timezone"),
        (clean_authors(authors, publisher) if "publisher" in rules.fields else authors).alias("authors"),
        publisher.alias("article_publisher"),
        "url",
        F.coalesce(F.col("_a.text"), blank).alias("text"),
        "theme",
        F.when(F.col("content").isNull(), -1).otherwise(F.col("_a.wraps")).alias("wraps"),
    )


def split_articles(parsed: DataFrame, keep_empty: bool = False) -> tuple[DataFrame, DataFrame]:
    """(articles, rejects): one article row per author, dates as market wall clock.

    Pages without content or the article element are rejects (url, theme, reason). Store `parsed`
    first when both sides are needed, so that the pages are parsed once.
    """
    found = one_row_per_item(parsed.where("wraps > 0"), ["authors"], keep_empty)
    dated = found.withColumn("date", parse_utc_stamp(F.col("date"), MARKET_ZONE))
    reason = F.when(F.col("wraps") < 0, "no content").otherwise("no article element")
    rejects = parsed.where("wraps <= 0").select("url", "theme", reason.alias("reason"))
    return align(dated, ARTICLES), rejects


LISTING_RULES = PageRules(
    {
        "age": Take((Step("div", class_part="footer"), Step("div", class_part="publishing")), "raw", any_branch=True),
        "link": Take((Step("a"),), "attribute", "href"),
    },
    rows=(Step("div", class_part="content"),),
)


def listing_links(pages: DataFrame) -> DataFrame:
    """(url, position, link, age) of every dated, linked card on stored listing pages."""
    cards = pages.select("url", F.posexplode(page_rows(F.col("content"), LISTING_RULES)).alias("position", "card"))
    return cards.select(
        "url", "position", F.col("card.link").alias("link"), age_text(F.col("card.age")).alias("age")
    ).where(F.col("age").isNotNull() & (strip(F.coalesce("link", F.lit(""))) != ""))
