"""Readers for the stored layouts: themed pages, day folders, envelopes, texts, tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.schemas import DAY_PARTITIONS, LATEST_TEXT, MEMBER_BODY, RAW_PAGE, THEMES, empty_table, row

# The hours at which all themes are taken, and the theme taken at other hours.
FULL_HOURS = (7, 21)
HOURLY_THEME = "Latest"

#: Bytes of stored pages that one task parses.
PAGE_TASK_BYTES = 16 << 20


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return bool(found)


def themes_for_hour(hour: int) -> tuple[str, ...]:
    return THEMES if hour in FULL_HOURS else (HOURLY_THEME,)


def calendar_day() -> Column:
    """The date of the year/month/day folder a row came from; usable as a partition filter."""
    return F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])


def in_day_window(as_of: dt.date, back: int = 1, ahead: int = 1) -> Column:
    days = window_days(as_of, back, ahead)
    return calendar_day().between(F.lit(days[0]), F.lit(days[-1]))


def window_days(as_of: dt.date, back: int = 1, ahead: int = 1) -> list[dt.date]:
    return [as_of + dt.timedelta(days=n) for n in range(-back, ahead + 1)]


def day_folders(
    spark: SparkSession,
    base: str,
    schema: T.StructType,
    kind: str = "parquet",
    suffix: str | None = None,
    whole_file_objects: bool = False,
    days: Iterable[dt.date] | None = None,
    above: str = "",
) -> DataFrame:
    """Files under base/year=/month=/day=; the folder columns stay text ('03', not 3).

    A further folder column, such as theme, is simply a column of `schema`. With `days` only
    the folders of those days are listed at all, and days without a folder are skipped;
    `above` is the pattern of folder columns before the year, such as 'theme=*/'.
    """
    full = T.StructType([*schema.fields, *DAY_PARTITIONS.fields])
    paths = [base]
    if days is not None:
        paths = [f"{base}/{above}{d:year=%Y/month=%m/day=%d}" for d in days]
    paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        return empty_table(spark, full)
    reader = spark.read.schema(full).option("basePath", base)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*.{suffix}")
    if whole_file_objects:
        # Left alone, a text of over 20,000,000 characters would make its page one that cannot be read.
        reader = reader.options(multiLine=True, maxStringLen=(1 << 31) - 1)
    return reader.format(kind).load(paths)


def calendar_pages(spark: SparkSession, base: str, days: Iterable[dt.date] | None = None) -> DataFrame:
    """Raw calendar pages, one pretty-printed JSON object per day folder."""
    return day_folders(spark, base, RAW_PAGE, "json", "json", whole_file_objects=True, days=days)


def spread_pages(pages: DataFrame) -> DataFrame:
    """Stored pages over enough tasks to parse them, when their files are fewer.

    A day's pages may stand in one file that cannot be split. The number of tasks follows from
    the bytes read, at least one a core; it is given outright, so adaptive execution does not
    gather the small rows again before they are parsed. Pages in many files move nowhere.
    """
    spark, files = pages.sparkSession, len(pages.inputFiles())
    if not files:
        return pages
    size = int(str(pages._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // PAGE_TASK_BYTES))
    return pages if files >= tasks else pages.repartition(tasks)


def themed_pages(
    spark: SparkSession, base: str, themes: Iterable[str] = THEMES, days: Iterable[dt.date] | None = None
) -> DataFrame:
    """Raw article pages of the wanted themes under base/{THEME}/year=/month=/day=.

    Themes without a folder are skipped; the theme is a literal per branch, so a theme
    that is not wanted is not even listed.
    """
    parts = [calendar_pages(spark, f"{base}/{t.upper()}", days).withColumn("theme", F.lit(t)) for t in themes]
    return reduce(DataFrame.unionByName, [p for p in parts if p.inputFiles()] or parts[:1])


def envelope_rows(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Rows of {"data": [record, ...]} objects; an unreadable object gives no rows."""
    return spark.read.schema(row(data=T.ArrayType(record))).json(path).select(F.inline("data"))


def latest_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of the newest file in a folder; no row when it has none."""
    if not path_exists(spark, path):
        return empty_table(spark, LATEST_TEXT)
    # Listed without their content; only the newest file is opened.
    files = spark.read.format("binaryFile").load(path).select("path", "modificationTime")
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()["path"]
    if newest is None:
        return empty_table(spark, LATEST_TEXT)
    return spark.read.text(newest, wholetext=True).select(F.lit(newest).alias("path"), F.col("value").alias("text"))


def member_records(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Registrations out of JSON bodies {responseId, timestamp, email}."""
    parsed = F.from_json(F.col(body), MEMBER_BODY)
    return bodies.withColumn("_m", parsed).select(
        F.col("_m.responseId").alias("response_id"),
        F.try_to_timestamp(F.col("_m.timestamp")).alias("timestamp"),
        F.col("_m.email").alias("email_address"),
        *[c for c in bodies.columns if c != body],
    )


def jdbc_table(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, readers: int, **options: str
) -> DataFrame:
    """A database table read in `readers` key ranges; needs the database's driver jar."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=low, upperBound=high, numPartitions=readers, properties=options
    )
