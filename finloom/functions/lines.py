"""Digest lines: marks, stars and row templates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from finloom.functions.cells import number_text, scaled
from finloom.functions.dates import shift_zone
from finloom.schemas import READER_ZONE


@dataclass(frozen=True)
class Labels:
    """Words and signs of the digest text."""

    actual: str = "실제"
    expected: str = "기대"
    forecast: str = "예상"
    previous: str = "이전"
    up: str = "▲"
    down: str = "▼"
    equal: str = "="
    star: str = "★"
    arrow: str = "→"
    speech: str = "Speaks"
    subject: str = "시 뉴스 요약"


LABELS = Labels()

# The line between two mail sections.
SECTION_RULE = "\n" + "-" * 116 + "\n\n"


def mark(actual: Column, other: Column, labels: Labels = LABELS) -> Column:
    return (
        F.when(actual > other, labels.up).when(actual < other, labels.down).otherwise(labels.equal)
    )


def stars(count: Column, labels: Labels = LABELS) -> Column:
    return F.repeat(F.lit(labels.star), count.cast("int"))


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _present(value: Column) -> Column:
    return value.isNotNull() & (value != 0)


def article_block(title: Column, text: Column) -> Column:
    blank = F.lit("")
    return _text("title: ", F.coalesce(title, blank), "\ncontent\n", F.coalesce(text, blank), "\n\n")


def earning_block(
    name: Column,
    symbol: Column,
    actual: Column,
    actual_unit: Column,
    forecast: Column,
    forecast_unit: Column,
    labels: Labels = LABELS,
) -> Column:
    """Company line plus the actual and/or expected revenue; NULL when both are missing or 0."""
    blank = F.lit("")
    head = _text(F.coalesce(name, blank), "(", F.coalesce(symbol, blank), ")\n")
    got = _text(f"{labels.actual}: ", actual.cast("string"), F.coalesce(actual_unit, blank))
    hoped = _text(f"{labels.expected}: ", forecast.cast("string"), F.coalesce(forecast_unit, blank))
    sign = mark(scaled(actual, actual_unit), scaled(forecast, forecast_unit), labels)
    return (
        F.when(
            _present(actual) & _present(forecast),
            _text(head, got, " / ", hoped, f" {labels.arrow} ", sign, "\n\n"),
        )
        .when(_present(actual), _text(head, got, "\n\n"))
        .when(_present(forecast), _text(head, hoped, "\n\n"))
    )


def reader_clock(wall: Column, zone: Column) -> Column:
    return F.date_format(shift_zone(zone, READER_ZONE, wall), "HH:mm")


def _event_frame(clock: Column, title: Column, count: Column, values: Column, labels: Labels) -> Column:
    shown = F.when(F.contains(title, F.lit(labels.speech)), "").otherwise(values)
    return _text(clock, " - ", title, " ", stars(count, labels), "\n", shown, "\n\n")


def event_preview(
    clock: Column,
    title: Column,
    count: Column,
    forecast: Column,
    previous: Column,
    unit: Column,
    labels: Labels = LABELS,
) -> Column:
    """An event still to come: forecast and previous value, each only when known and not 0."""
    unit = F.coalesce(unit, F.lit(""))
    hoped = _text(f"{labels.forecast}: ", number_text(forecast), unit)
    before = _text(f"{labels.previous}: ", number_text(previous), unit)
    values = (
        F.when(_present(forecast) & _present(previous), _text("(", hoped, ", ", before, ")"))
        .when(_present(forecast), _text("(", hoped, ")"))
        .when(_present(previous), _text("(", before, ")"))
        .otherwise("")
    )
    return _event_frame(clock, title, count, values, labels)


def event_recap(
    clock: Column,
    title: Column,
    count: Column,
    actual: Column,
    forecast: Column,
    previous: Column,
    unit: Column,
    labels: Labels = LABELS,
) -> Column:
    """A released event: the actual value marked against forecast and previous value."""
    unit = F.coalesce(unit, F.lit(""))
    got = _text(f"{labels.actual}: ", number_text(actual), unit)

    def against(word: str, other: Column) -> Column:
        return _text(f"{word}(", number_text(other), unit, "): ", mark(actual, other, labels))

    arrow = f" {labels.arrow} "
    hoped, before = against(labels.forecast, forecast), against(labels.previous, previous)
    values = (
        F.when(_present(forecast) & _present(previous), _text(got, arrow, hoped, ", ", before))
        .when(_present(forecast), _text(got, arrow, hoped))
        .when(_present(previous), _text(got, arrow, before))
        .otherwise(got)
    )
    return _event_frame(clock, title, count, values, labels)


def section_head(title: str | Column) -> Column:
    return _text("【", title, "】\n")


def subject(hour: Column, labels: Labels = LABELS) -> Column:
    return _text(hour.cast("string"), labels.subject)
