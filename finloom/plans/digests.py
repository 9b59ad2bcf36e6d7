"""The digest queries and their texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.functions import lines
from finloom.functions.cells import scaled
from finloom.functions.dates import day_bounds, recent_hours
from finloom.operators.lookup import lookup_join
from finloom.operators.ordered_text import ordered_parts
from finloom.schemas import MARKET_ZONE

# The run hour that lists events before release, and the split between both texts.
PREVIEW_HOUR = 21
NOON = 12

EARNING_DIGEST_COLUMNS = (
    "name",
    "symbol",
    "year",
    "quarter",
    "revenue_forecast",
    "revenue_forecast_unit",
    "revenue_actual",
    "revenue_actual_unit",
)


def earnings_digest(
    earnings: DataFrame, companies: DataFrame, periods: DataFrame, day: dt.date | None = None
) -> DataFrame:
    """Distinct reported revenues with company and period, and the first call date of each.

    With `day`, only the calls of that day. The earnings are reduced to distinct rows before
    the joins, so repeated rows of one company are combined where they are read.
    """
    rows = earnings.where("revenue_actual <> 0")
    if day is not None:
        rows = rows.where(day_bounds(F.col("call_date"), day))
    facts = [c for c in EARNING_DIGEST_COLUMNS if c.startswith("revenue")]
    firsts = rows.groupBy("company_id", "period_id", *facts).agg(F.min("call_date").alias("call_date"))
    names, quarters = companies.select("company_id", "name", "symbol"), periods.select("period_id", "year", "quarter")
    named = lookup_join(firsts, names, ["company_id"], sketch=rows)
    placed = lookup_join(named, quarters, ["period_id"], sketch=rows)
    # Two ids may carry the same name and period, so distinct again on what is shown.
    return placed.groupBy(*EARNING_DIGEST_COLUMNS).agg(F.min("call_date").alias("call_date"))


def earning_marks(rows: DataFrame) -> DataFrame:
    """Digest rows with the mark of actual against forecast in full amounts."""
    return rows.withColumn(
        "mark",
        lines.mark(
            scaled(F.col("revenue_actual"), F.col("revenue_actual_unit")),
            scaled(F.col("revenue_forecast"), F.col("revenue_forecast_unit")),
        ),
    )


def earning_lines(rows: DataFrame) -> DataFrame:
    block = lines.earning_block(
        *[
            F.col(c)
            for c in (
                "name",
                "symbol",
                "revenue_actual",
                "revenue_actual_unit",
                "revenue_forecast",
                "revenue_forecast_unit",
            )
        ]
    )
    return rows.withColumn("line", block).where("line IS NOT NULL")


def news_window(
    articles: DataFrame, as_of_utc: dt.datetime, hours: int = 10, shown: tuple[str, ...] = ("title", "text")
) -> DataFrame:
    """Distinct articles of the last full hours on the market clock, with their first date."""
    recent = articles.where(recent_hours(F.col("date"), as_of_utc, hours, MARKET_ZONE))
    return recent.groupBy(*shown).agg(F.min("date").alias("date"))


def article_lines(articles: DataFrame) -> DataFrame:
    return articles.withColumn("line", lines.article_block(F.col("title"), F.col("text")))


def events_of_day(events: DataFrame, day: dt.date | None, hour: int) -> DataFrame:
    """Distinct events; outside the preview hour only those already released."""
    rows = events if day is None else events.where(day_bounds(F.col("release_time"), day))
    if hour != PREVIEW_HOUR:
        rows = rows.where("actual IS NOT NULL")
    return rows.distinct()


def event_lines(events: DataFrame, hour: int) -> DataFrame:
    """events with their digest line: a preview from noon on, a recap of released events before."""
    clock = lines.reader_clock(F.col("release_time"), F.col("timezone"))
    head = (clock, F.coalesce("title", F.lit("")), F.coalesce("volatility", F.lit(0)))
    numbers = [F.col(c) for c in ("forecast", "previous", "unit")]
    if hour >= NOON:
        return events.withColumn("line", lines.event_preview(*head, *numbers))
    released = events.where("actual IS NOT NULL")
    return released.withColumn("line", lines.event_recap(*head, F.col("actual"), *numbers))


def digest_parts(
    rows: DataFrame, line: str, order: list[str], groups: list[str] | None = None, lines_per_part: int = 500
) -> DataFrame:
    """The text of digest rows in order, as parts of at most lines_per_part lines."""
    return ordered_parts(rows, groups or [], order, line, lines_per_part)


# Part numbers that put a section's heading before its text and the rule after it.
_HEAD_PART, _RULE_PART = -1, 2**62


def mail_parts(sections: list[tuple[str, DataFrame]]) -> DataFrame:
    """(section, part, text) of a whole mail: each section's heading, its parts, and a rule between two.

    `sections` are (title, parts with columns part and text) in mail order.
    """
    spark = sections[0][1].sparkSession
    frame = [(i, _HEAD_PART, title, "head") for i, (title, _) in enumerate(sections)]
    frame += [(i, _RULE_PART, None, "rule") for i in range(len(sections) - 1)]
    text = F.when(F.col("kind") == "head", lines.section_head(F.col("title"))).otherwise(lines.SECTION_RULE)
    mail = spark.createDataFrame(frame, "section int, part bigint, title string, kind string").select(
        "section", "part", text.alias("text")
    )
    for i, (_, parts) in enumerate(sections):
        body = parts.select(F.lit(i).alias("section"), F.col("part").cast("bigint").alias("part"), "text")
        mail = mail.unionByName(body)
    return mail


def text_measures(text: str) -> list[Column]:
    """Run metrics of a digest, for DataFrame.observe or agg: rows and characters."""
    return [F.count("*").alias("rows"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("characters")]
