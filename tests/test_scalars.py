"""Expression builders on hand-made rows and against plain Python models."""

import datetime as dt
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finloom.functions import cells, dates, keys, lines, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_parse_value_edges(spark):
    cases = {
        "--": (None, None),
        "/1,234.5B": (1234.5, "B"),
        "1.2": (1.2, None),
        "": (None, None),
        "-": (None, "-"),
        "3.5%": (3.5, "%"),
        "abc": (None, "c"),
        " 7 ": (7.0, None),
        "3.5 %": (3.5, "%"),
        "1.5f%": (None, "%"),
    }
    out = values(spark, [(c,) for c in cases], "c string", cells.parse_value(F.col("c"), "/").alias("p"))
    assert [(p.value, p.unit) for (p,) in out] == list(cases.values())


def parse_model(cell, lead):
    t = cell.lstrip(lead).strip()
    if t == "--":
        return None, None
    unit = None
    if t and t[-1] not in "0123456789":
        t, unit = t[:-1], t[-1]
    try:
        return float(t.replace(",", "")), unit
    except ValueError:
        return None, unit


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.,-+/ %KMBe\t ", max_size=9), min_size=20, max_size=60))
def test_parse_value_model(spark, texts):
    out = values(spark, [(c,) for c in texts], "c string", cells.parse_value(F.col("c"), "/").alias("p"))
    assert [(p.value, p.unit) for (p,) in out] == [parse_model(c, "/") for c in texts]


def test_event_values(spark):
    rows = [
        ("1.2%", "1.3%", "1.1%"),
        ("", "", "5.0K"),
        ("1,200", "", ""),
        ("1.2%", "", ""),
        (None, None, None),
        ("1.2", "x", "3"),
    ]
    v = cells.event_values(F.col("a"), F.col("f"), F.col("p"))
    out = [tuple(r[0]) for r in values(spark, rows, "a string, f string, p string", v)]
    assert out == [
        (1.2, 1.3, 1.1, "%", False),
        (None, None, 5.0, "K", False),
        (1200.0, None, None, None, False),
        (None, None, None, None, True),
        (None, None, None, None, False),
        (1.2, None, 3.0, None, True),
    ]


def test_units_are_full_amounts(spark):
    rows = [("1.1", "K"), ("1.5", "B"), ("2", "T"), ("3", None), ("3", "%")]
    out = values(spark, rows, "v string, u string", cells.scaled(F.col("v").cast("decimal(20,2)"), F.col("u")))
    assert [float(x) for (x,) in out] == [1100.0, 1.5e9, 2e12, 3.0, 3.0]


def test_decimal_or_zero(spark):
    out = values(spark, [(None,), (1.005,)], "v double", cells.decimal_or_zero(F.col("v"), 20, 2))
    assert [str(x) for (x,) in out] == ["0.00", "1.01"]


def test_number_text_is_python_text(spark):
    numbers = [0.0, 3.0, 3.5, -2.25, 200.0, 12345678.0, 0.1, 1e-06]
    out = values(spark, [(n,) for n in numbers], "v double", cells.number_text(F.col("v")))
    assert [x for (x,) in out] == ["0.0", "3.0", "3.5", "-2.25", "200.0", "12345678.0", "0.1", "0.000001"]


def test_slug_and_theme(spark):
    rows = [("https://x/news/a-b-c.html", "stock market")]
    out = values(
        spark, rows, "u string, t string",
        text.slug(F.col("u")), text.parent_folder(F.col("u")), text.theme_key(F.col("t")),
    )
    assert out == [("a_b_c", "https://x/news/", "STOCK_MARKET")]


def test_age_filters(spark):
    rows = [("W • 5 minutes ago",), ("W • yesterday ",), ("2 hours ago",), ("W • 1 minute",)]
    age = text.age_text(F.col("c"))
    out = values(spark, rows, "c string", age, text.is_not_yesterday(age), text.is_minutes_old(age), text.has_digit(age))
    assert out == [
        ("5 minutes ago", True, True, True),
        ("yesterday", False, False, False),
        ("2 hours ago", True, False, True),
        ("1 minute", True, True, True),
    ]


def test_clean_text(spark):
    rows = [("【4:0†a】x【1:2†b】 y\n\n  z【9:9†line\nbreak】",)]
    assert values(spark, rows, "c string", text.clean_text(F.col("c"))) == [("x y\nz【9:9†line\nbreak】",)]


def test_authors(spark):
    rows = [
        (["Ann Lee and Bob Ray", "Reuters", "Cy"], None, "x", "Reuters Inc"),
        ([""], "Dee Poe, writer", "", ""),
        ([""], None, "", ""),
        ([], None, " Ann , Bo, , Wire ", "The Wire"),
        ([], None, " Solo ", ""),
        ([], None, None, ""),
    ]
    names = text.byline_authors(F.col("l"), F.col("alt"), F.col("b"))
    out = values(
        spark, rows, "l array<string>, alt string, b string, p string", text.clean_authors(names, F.col("p"))
    )
    assert [x for (x,) in out] == [["Ann Lee", "Bob Ray", "Cy"], ["Dee Poe"], [""], ["Ann", "Bo"], ["Solo"], []]


def test_zones_and_dst(spark):
    rows = [("2025-03-25 08:30:00",), ("2025-03-09 02:30:00",), ("2025-11-02 01:30:00",)]
    wall = F.col("w").cast("timestamp_ntz")
    out = values(
        spark, rows, "w string",
        dates.shift_zone("America/New_York", "Asia/Seoul", wall), dates.shift_zone("America/New_York", "UTC", wall),
    )
    at = lambda *a: dt.datetime(2025, *a)
    assert out == [
        (at(3, 25, 21, 30), at(3, 25, 12, 30)),
        (at(3, 9, 16, 30), at(3, 9, 7, 30)),
        (at(11, 2, 14, 30), at(11, 2, 5, 30)),
    ]


def test_utc_stamp(spark):
    rows = [("2025-03-25T12:30:00.000Z",), ("",), ("2025-03-25",), ("2025-13-25T12:30:00.000Z",), (None,)]
    out = values(spark, rows, "s string", dates.parse_utc_stamp(F.col("s"), "America/New_York"))
    assert [x for (x,) in out] == [dt.datetime(2025, 3, 25, 8, 30), None, None, None, None]


def test_clock_and_epoch(spark):
    rows = [("08:30",), ("9:05",), ("24:10",), ("All Day",), ("",), (None,)]
    wall = dates.clock_on(F.lit(dt.date(2025, 3, 25)), F.col("c"))
    out = values(spark, rows, "c string", wall, dates.to_epoch_ms(wall))
    ms = int(dt.datetime(2025, 3, 25, 8, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert out[0] == (dt.datetime(2025, 3, 25, 8, 30), ms)
    assert out[1][0] == dt.datetime(2025, 3, 25, 9, 5)
    assert [o[0] for o in out[2:]] == [None] * 4


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=5, max_size=30))
def test_group_is_sha_remainder(spark, ids):
    ids = [i.encode("utf-8", "ignore").decode() for i in ids]
    out = values(spark, [(i,) for i in ids], "i string", keys.message_group(F.col("i")), keys.hash_remainder(F.col("i"), 9973))
    number = lambda i: int(hashlib.sha256(i.encode()).hexdigest(), 16)
    assert out == [(f"group-{number(i) % 10}", number(i) % 9973) for i in ids]


def test_group_of_seven(spark):
    assert values(spark, [(7,)], "i int", keys.message_group(F.col("i"))) == [("group-9",)]


def test_surrogate_keys_differ(spark):
    rows = [("a", "b"), ("ab", ""), ("a", None), (None, "a"), ("a|1:b", ""), ("", ""), (None, None), ("-", None)]
    out = values(spark, rows, "x string, y string", keys.surrogate_key(F.col("x"), F.col("y")))
    assert len(set(out)) == len(rows)


def test_marks_per_row(spark):
    rows = [(1.0, 2.0), (0.0, -1.0), (2.0, 2.0), (1.0, 0.0)]
    out = values(spark, rows, "a double, b double", lines.mark(F.col("a"), F.col("b")))
    assert [x for (x,) in out] == ["▼", "▲", "=", "▲"]


def test_earning_block_shapes(spark):
    rows = [("1.50", "K", "1400", None), ("2", None, None, "M"), (None, None, "3", "M"), ("0", None, None, None)]
    d = lambda c: F.col(c).cast("decimal(20,2)")
    block = lines.earning_block(F.lit("Acme"), F.lit("AC"), d("a"), F.col("au"), d("f"), F.col("fu"))
    out = [x for (x,) in values(spark, rows, "a string, au string, f string, fu string", block)]
    assert out == [
        "Acme(AC)\n실제: 1.50K / 기대: 1400.00 → ▲\n\n",
        "Acme(AC)\n실제: 2.00\n\n",
        "Acme(AC)\n기대: 3.00M\n\n",
        None,
    ]


def test_event_lines(spark):
    rows = [
        ("CPI", 3, 1.5, 1.0, 2.0, "%"),
        ("Chair Speaks", 0, 1.5, 1.0, None, None),
        ("CPI", 1, 0.0, None, 2.0, None),
        ("CPI", 1, 2.0, None, None, "K"),
        ("CPI", 1, 2.0, 2.0, 0.0, "K"),
    ]
    c = F.col
    schema = "t string, v int, a double, f double, p double, u string"
    preview = lines.event_preview(F.lit("21:30"), c("t"), c("v"), c("f"), c("p"), c("u"))
    recap = lines.event_recap(F.lit("21:30"), c("t"), c("v"), c("a"), c("f"), c("p"), c("u"))
    out = values(spark, rows, schema, preview, recap)
    assert out[0] == (
        "21:30 - CPI ★★★\n(예상: 1.0%, 이전: 2.0%)\n\n",
        "21:30 - CPI ★★★\n실제: 1.5% → 예상(1.0%): ▲, 이전(2.0%): ▼\n\n",
    )
    assert out[1] == ("21:30 - Chair Speaks \n\n\n", "21:30 - Chair Speaks \n\n\n")
    assert out[2] == ("21:30 - CPI ★\n(이전: 2.0)\n\n", "21:30 - CPI ★\n실제: 0.0 → 이전(2.0): ▼\n\n")
    assert out[3] == ("21:30 - CPI ★\n\n\n", "21:30 - CPI ★\n실제: 2.0K\n\n")
    assert out[4] == ("21:30 - CPI ★\n(예상: 2.0K)\n\n", "21:30 - CPI ★\n실제: 2.0K → 예상(2.0K): =\n\n")
