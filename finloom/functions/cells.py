"""Numbers and units out of table-cell text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space for text cells, from the Unicode rule itself.
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Size of each amount unit.
UNIT_SIZES = {"K": 10**3, "M": 10**6, "B": 10**9, "T": 10**12}

# A cell holding this has not been published yet.
NO_VALUE = "--"

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def to_number(text: Column) -> Column:
    """Double from text with thousands separators; NULL when the text is not a number."""
    plain = strip(F.replace(text, F.lit(","), F.lit("")))
    return F.when(plain.rlike(_NUMBER), plain.try_cast("double"))


def _ends_in_digit(text: Column) -> Column:
    return F.right(text, F.lit(1)).rlike("[0-9]")


def _without_last(text: Column) -> Column:
    return F.left(text, F.length(text) - 1)


def parse_value(cell: Column, lead: str = "") -> Column:
    """struct<value, unit> of a cell such as '/1,234.5B'; `lead` lists characters cut off in front."""
    text = strip(F.ltrim(cell, F.lit(lead)) if lead else cell)
    has_unit = (text != "") & ~_ends_in_digit(text)
    missing = text == NO_VALUE
    value = F.when(~missing, to_number(F.when(has_unit, _without_last(text)).otherwise(text)))
    unit = F.when(~missing & has_unit, F.right(text, F.lit(1)))
    return F.struct(value.alias("value"), unit.alias("unit"))


def event_values(actual: Column, forecast: Column, previous: Column) -> Column:
    """struct<actual, forecast, previous, unit, unreadable> of the three cells of one event.

    The unit is taken from `previous`; when it has one, all three cells lose their last
    character. `unreadable` marks a non-empty cell that gave no number.
    """
    cells = {
        "actual": strip(F.coalesce(actual, F.lit(""))),
        "forecast": strip(F.coalesce(forecast, F.lit(""))),
        "previous": strip(F.coalesce(previous, F.lit(""))),
    }
    has_unit = (cells["previous"] != "") & ~_ends_in_digit(cells["previous"])
    texts = {k: F.when(has_unit & (c != ""), _without_last(c)).otherwise(c) for k, c in cells.items()}
    numbers = {k: to_number(c) for k, c in texts.items()}
    unreadable = F.lit(False)
    for k in cells:
        unreadable = unreadable | ((texts[k] != "") & numbers[k].isNull())
    return F.struct(
        *[numbers[k].alias(k) for k in cells],
        F.when(has_unit, F.right(cells["previous"], F.lit(1))).alias("unit"),
        unreadable.alias("unreadable"),
    )


def scaled(value: Column, unit: Column) -> Column:
    """The full amount, exactly: 1.5 with unit 'K' is 1500."""
    size = F.lit(1)
    for name, factor in UNIT_SIZES.items():
        size = F.when(unit == name, F.lit(factor)).otherwise(size)
    return value.cast("decimal(20,2)") * size.cast("decimal(13,0)")


def decimal_or_zero(value: Column, precision: int, scale: int) -> Column:
    kind = f"decimal({precision},{scale})"
    return F.coalesce(value.cast(kind), F.lit(0).cast(kind))


def number_text(value: Column) -> Column:
    """A plain number for a digest line: at most six decimals, no trailing zeros, '3.0' for 3.

    It goes through the shortest text of the column's own type, so that a REAL 98.3 reads 98.3.
    """
    text = value.cast("string").try_cast("decimal(30,6)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", ".0")
