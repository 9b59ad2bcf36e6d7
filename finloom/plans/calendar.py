"""Calendar pages -> event rows and earning records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.functions.cells import event_values, parse_value
from finloom.functions.dates import clock_on, iso_text, midnight_ms, to_epoch_ms
from finloom.operators.markup import PageRules, Step, Take, page_rows
from finloom.operators.project import align, cast_columns, flatten_earnings
from finloom.schemas import EARNING_RECORD, MARKET_ZONE, PAGE_PLACE

NO_CONTENT = "no content"

# Where the fields of a calendar row are.
EVENT_RULES = PageRules(
    {
        "clock": Take((Step("td", ("time",)),)),
        "country": Take(
            (Step("td", ("left", "flagCur", "noWrap")), Step("span")), "attribute", "title", any_branch=True
        ),
        "volatility": Take((Step("i", ("grayFullBullishIcon",)),), "count"),
        "title": Take((Step("td", ("event",)),)),
        "actual": Take((Step("td", ("act",)),)),
        "forecast": Take((Step("td", ("fore",)),)),
        "previous": Take((Step("td", ("prev",)),)),
    },
    rows=(Step("tr", ("js-event-item",)),),
)
_COMPANY = Step("td", ("left", "noWrap", "earnCalCompany"))
EARNING_RULES = PageRules(
    {
        "country": Take((Step("td", ("flag",)), Step("span")), "attribute", "title", any_branch=True),
        "name": Take((_COMPANY,), "attribute", "title"),
        "symbol": Take((_COMPANY, Step("a")), any_branch=True),
        "cells": Take((Step("td"),), "all text"),
    },
    rows=(Step(id="earningsCalendarData"), Step("tbody"), Step("tr")),
)
# The cell positions (from 1) of the measures, and the character cut off in front.
EARNING_CELLS = {
    ("eps", "actual"): (3, ""),
    ("eps", "forecast"): (4, "/"),
    ("revenue", "actual"): (5, ""),
    ("revenue", "forecast"): (6, "/"),
    ("market_cap", None): (7, ""),
}
EARNING_COLUMN_KINDS = {
    "company_name": "string",
    "symbol": "string",
    "country": "string",
    "year": "smallint",
    "quarter": "smallint",
    **{
        f"{name}_{leaf}": kind
        for name in ("eps_actual", "eps_forecast", "revenue_actual", "revenue_forecast", "market_cap")
        for leaf, kind in (("value", "float"), ("unit", "string"))
    },
    "timezone": "string",
}
EVENT_COLUMN_KINDS = {"volatility": "smallint", "actual": "float", "forecast": "float", "previous": "float"}


def _rows_or_none(rules: PageRules) -> Column:
    """(position, r) of each row of a page, and one empty row for a page without content."""
    rows = page_rows(F.coalesce("content", F.lit("")), rules)
    return F.posexplode(F.when(F.col("content").isNull(), F.array(F.lit(None))).otherwise(rows)).alias("position", "r")


def parsed_events(pages: DataFrame, day: Column, keep: Sequence[str] = ()) -> DataFrame:
    """One row per event of the calendar pages, with `reject` = no content, time, number or NULL.

    A page without content, such as one whose JSON cannot be read, gives one row that says so.
    `day` is the page's calendar day; the page columns of `keep` are carried along.
    """
    rows = pages.select(*keep, "url", "content", day.alias("_day"), _rows_or_none(EVENT_RULES))
    read = rows.withColumn(
        "v", event_values(F.col("r.actual"), F.col("r.forecast"), F.col("r.previous"))
    ).withColumn("release_wall", clock_on(F.col("_day"), F.col("r.clock")))
    bad_time = F.col("r.clock").isNotNull() & F.col("release_wall").isNull()
    return read.select(
        *keep,
        "url",
        "position",
        F.when(F.col("content").isNull(), NO_CONTENT)
        .when(bad_time, "time")
        .when(F.col("v.unreadable"), "number")
        .alias("reject"),
        to_epoch_ms(F.col("release_wall")).alias("release_time"),
        F.lit(MARKET_ZONE).alias("timezone"),
        F.col("r.country").alias("country"),
        F.col("r.volatility").alias("volatility"),
        F.col("r.title").alias("title"),
        "v.actual",
        "v.forecast",
        "v.previous",
        "v.unit",
    )


def split_events(
    parsed: DataFrame, keep: Sequence[str] = (), placed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(events, rejects) of parsed_events.

    An event whose numbers cannot be read is kept with NULLs and also listed in rejects;
    one whose time cannot be read, and a page without content, only go to rejects. With
    `placed` events carry their page and their position in it.
    """
    kept = parsed.where("reject IS NULL OR reject = 'number'").drop("reject")
    kept = kept.withColumnRenamed("url", "page") if placed else kept.drop("url", "position")
    rejects = parsed.where("reject IS NOT NULL").select("url", "position", F.col("reject").alias("reason"), *keep)
    return cast_columns(kept, EVENT_COLUMN_KINDS)[0], rejects


def events_with_iso_time(events: DataFrame, zone_label: str = "ET") -> DataFrame:
    """The older event layout: `time` as ISO text and a `utc` label."""
    wall = F.timestamp_millis(F.col("release_time")).cast("timestamp_ntz")
    return events.select(
        iso_text(wall).alias("time"),
        F.lit(zone_label).alias("utc"),
        *[c for c in events.columns if c not in ("release_time", "timezone")],
    )


def parsed_earnings(pages: DataFrame, day: Column, keep: Sequence[str] = ()) -> DataFrame:
    """One record per row of the earnings pages, the heading row left out.

    `reject` tells why a row is incomplete; a page without content gives one row that says so.
    """
    rows = pages.select(*keep, "url", "content", day.alias("_day"), _rows_or_none(EARNING_RULES))
    rows = rows.where("position > 0 OR content IS NULL")
    last_cell = max(position for position, _ in EARNING_CELLS.values())

    def cell(name: str, side: str | None = None) -> Column:
        position, lead = EARNING_CELLS[name, side]
        return parse_value(F.get("r.cells", F.lit(position - 1)), lead)

    def pair(name: str) -> Column:
        return F.struct(*[cell(name, side).alias(side) for side in ("actual", "forecast")]).alias(name)

    return rows.select(
        *keep,
        "url",
        "position",
        F.when(F.col("content").isNull(), NO_CONTENT)
        .when(F.size("r.cells") < last_cell, "too few cells")
        .alias("reject"),
        F.struct(F.col("r.name").alias("name"), F.col("r.symbol").alias("symbol")).alias("company"),
        F.col("r.country").alias("country"),
        pair("eps"),
        pair("revenue"),
        cell("market_cap").alias("market_cap"),
        F.year("_day").alias("year"),
        F.quarter("_day").alias("quarter"),
        midnight_ms(F.col("_day")).alias("call_date"),
        F.lit(MARKET_ZONE).alias("timezone"),
    )


def split_earnings(
    parsed: DataFrame, keep: Sequence[str] = (), placed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of parsed_earnings. With `placed` records carry their page and position."""
    rejects = parsed.where("reject IS NOT NULL").select("url", "position", F.col("reject").alias("reason"), *keep)
    spots = PAGE_PLACE.fields if placed else []
    kept = T.StructType([*EARNING_RECORD.fields, *spots, *[parsed.schema[c] for c in keep]])
    return align(parsed.where("reject IS NULL").withColumn("page", F.col("url")), kept), rejects


def earning_calls(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The flat earnings columns in their table types."""
    return cast_columns(flatten_earnings(records, keep), EARNING_COLUMN_KINDS)[0]


def records_without_period(records: DataFrame) -> DataFrame:
    """The older nested layout: no period and call columns, market cap under `market cap`."""
    return records.select("company", "country", "eps", "revenue", F.col("market_cap").alias("market cap"))
