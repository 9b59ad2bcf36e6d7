"""Arriving page files -> parsed rows, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from finloom.plans.articles import parsed_articles, split_articles
from finloom.plans.calendar import earning_calls, parsed_earnings, parsed_events, split_earnings, split_events
from finloom.session import materialize
from finloom.streaming.ingest import run_available

Split = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def ingest_pages(
    stream: DataFrame, parse: Callable[[DataFrame], DataFrame], split: Split, path: str, checkpoint: str
) -> None:
    """Parse each batch of pages once and write its rows and rejects to their batch folders."""

    def each(batch: DataFrame, batch_id: int) -> None:
        rows, rejects = split(materialize(parse(batch), "parsed"))
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        rejects.write.mode("overwrite").parquet(f"{path}/rejects/batch_id={batch_id}")

    run_available(stream, each, checkpoint)


def ingest_articles(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Raw article pages (url, content, theme) as they arrive -> article rows."""
    ingest_pages(stream, parsed_articles, split_articles, path, checkpoint)


def ingest_events(stream: DataFrame, day: Column, path: str, checkpoint: str) -> None:
    """Raw calendar pages (url, content) as they arrive -> event rows; `day` is a page's calendar day."""
    ingest_pages(stream, lambda pages: parsed_events(pages, day), split_events, path, checkpoint)


def ingest_earnings(stream: DataFrame, day: Column, path: str, checkpoint: str) -> None:
    """Raw earnings pages (url, content) as they arrive -> flat earnings rows."""

    def split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
        records, rejects = split_earnings(parsed)
        return earning_calls(records), rejects

    ingest_pages(stream, lambda pages: parsed_earnings(pages, day), split, path, checkpoint)
