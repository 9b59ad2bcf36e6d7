"""Text clean-up: slugs, theme keys, citation marks, author lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from finloom.functions.cells import strip

# The mark between publisher and age on a listing card, a citation mark, a
# line's leading white space. The flags keep '\n' as the only line end and count every
# Unicode space and digit.
AGE_SEPARATOR = "•"
CITATION = r"(?dU)【\d+:\d+†.*?】"
LEADING_SPACE = r"(?mdU)^\s+"


def slug(url: Column) -> Column:
    """'https://x/news/a-b.html' -> 'a_b'."""
    name = F.replace(F.substring_index(url, "/", -1), F.lit(".html"), F.lit(""))
    return F.replace(name, F.lit("-"), F.lit("_"))


def parent_folder(path: Column) -> Column:
    return F.regexp_replace(path, "[^/]*$", "")


def theme_key(theme: Column) -> Column:
    return F.upper(F.replace(theme, F.lit(" "), F.lit("_")))


def age_text(card: Column) -> Column:
    """The age shown on a listing card: what follows the last separator."""
    return strip(F.substring_index(card, AGE_SEPARATOR, -1))


def is_not_yesterday(age: Column) -> Column:
    return age != "yesterday"


def is_minutes_old(age: Column) -> Column:
    return age.rlike(r"([0-9]+)\s*(minutes?)")


def has_digit(age: Column) -> Column:
    return age.rlike("[0-9]")


def drop_citations(text: Column) -> Column:
    return F.regexp_replace(text, CITATION, "")


def drop_leading_space(text: Column) -> Column:
    return F.regexp_replace(text, LEADING_SPACE, "")


def clean_text(text: Column) -> Column:
    return drop_leading_space(drop_citations(text))


def text_after_tags(html: Column) -> Column:
    """Tag-free text of regular markup: each text run trimmed, empty runs dropped, one per line."""
    runs = F.transform(F.split(html, "<[^>]*>"), strip)
    return F.array_join(F.filter(runs, lambda run: run != ""), "\n")


def opening_tag(html: Column, tag: str, class_part: str) -> Column:
    """The first such opening tag of regular markup, '' when there is none."""
    return F.regexp_extract(html, rf'<{tag}\b[^>]*\sclass="[^"]*{class_part}[^"]*"[^>]*>', 0)


def tag_attribute(opening: Column, name: str) -> Column:
    return F.regexp_extract(opening, rf'\s{name}="([^"]*)"', 1)


def class_count(html: Column, tag: str, class_part: str) -> Column:
    return F.regexp_count(html, F.lit(rf'<{tag}\b[^>]*\sclass="[^"]*{class_part}[^"]*"'))


def split_trimmed(text: Column, separator: str) -> Column:
    return F.transform(F.split(text, separator), strip)


def byline_authors(links: Column, image_alt: Column, byline: Column) -> Column:
    """Author names of one byline, before clean-up.

    Link texts come first; one single empty link means an image link, whose alt text
    carries the name before the first ', '; with no link the byline text is split.
    """
    from_image = F.when(image_alt.isNull(), F.array(F.lit(""))).otherwise(
        F.array(F.element_at(F.split(image_alt, ", "), 1))
    )
    from_text = F.when(F.contains(byline, F.lit(",")), split_trimmed(byline, ", ")).otherwise(
        F.array(strip(byline))
    )
    none = F.array().cast("array<string>")
    return (
        F.when(byline.isNull(), none)
        .when(F.size(links) == 0, from_text)
        .when(links == F.array(F.lit("")), from_image)
        .otherwise(links)
    )


def clean_authors(authors: Column, publisher: Column) -> Column:
    """Drop later entries that only name the publisher, and split 'A and B'."""
    kept = F.filter(authors, lambda name, i: (i == 0) | ~F.contains(publisher, name))
    return F.flatten(
        F.transform(
            kept,
            lambda name: F.when(F.contains(name, F.lit(" and ")), split_trimmed(name, " and ")).otherwise(
                F.array(name)
            ),
        )
    )
