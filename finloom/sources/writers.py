"""Writers: day partitions, page files, digests, and publishing a new table version."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.functions.text import slug, theme_key
from finloom.operators.merge import insert_new_keys
from finloom.operators.project import align
from finloom.sources.metrics import WHOLE, Observed, Sizes
from finloom.sources.reconcile import read_united

DAY_COLUMNS = ("year", "month", "day")
PARTS_PER_FILE = 64


def with_day_columns(df: DataFrame, when: Column) -> DataFrame:
    """Folder columns of a date or timestamp, zero-padded as text."""
    return df.withColumns(
        {"year": F.date_format(when, "yyyy"), "month": F.date_format(when, "MM"), "day": F.date_format(when, "dd")}
    )


def write_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str] = DAY_COLUMNS,
    kind: str = "parquet",
    mode: str = "overwrite",
    **options: str | int,
) -> None:
    """Replace only the partitions present in df; `options` are those of Spark's writer.

    The rebalance hint gathers each partition into few files and lets adaptive execution
    split one that is too large for a task, so a single huge day is not one writer's job.
    """
    writer = df.hint("rebalance", *by).write.mode(mode).partitionBy(*by)
    writer.options(partitionOverwriteMode="dynamic", **options).format(kind).save(path)


def write_day_rejects(df: DataFrame, path: str, days: Sequence[dt.date]) -> None:
    """Replace the rejects of these days, also with none: df has the day columns."""
    for day in days:
        own = {"year": f"{day:%Y}", "month": f"{day:%m}", "day": f"{day:%d}"}
        rows = df.where(" AND ".join(f"CAST({c} AS INT) = {int(v)}" for c, v in own.items())).drop(*own)
        rows.write.mode("overwrite").parquet(f"{path}/" + "/".join(f"{c}={v}" for c, v in own.items()))


def write_pages(pages: DataFrame, path: str, day: Column) -> None:
    """Raw pages by theme and day; Spark names the files, so the page slug is kept as a column."""
    named = with_day_columns(pages.withColumn("slug", slug(F.col("url"))), day)
    write_partitions(
        named.withColumn("theme", theme_key(F.col("theme"))), path, ("theme", *DAY_COLUMNS), "json"
    )


def write_envelopes(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """{"data": [record]} objects, one per line.

    Readers take any number of records per object; one each means no list is ever built
    from a whole day.
    """
    records.select(F.array(F.struct(*records.columns)).alias("data")).write.mode(mode).json(path)


def digest_folder(base: str, kind: str, moment: dt.datetime) -> str:
    return f"{base}/{kind.upper()}/{moment:year=%Y/month=%m/day=%d}/{kind.lower()}_{moment:%y%m%d%H}"


def write_digest(
    parts: DataFrame, base: str, kind: str, moment: dt.datetime, order: Sequence[str] = ("part",)
) -> str:
    """Digest parts as text files of one folder, stamped with the hour; returns the folder.

    Files are in part order by name, so reading them one after another gives the text, and
    hold a bounded number of parts. The writer ends every part with a line break, so a part's
    own last one is left out.
    """
    folder = digest_folder(base, kind, moment)
    ended = F.col("text").endswith("\n")
    text = F.when(ended, F.left("text", F.length("text") - 1)).otherwise(F.col("text"))
    in_order = parts.repartitionByRange(*order).sortWithinPartitions(*order).select(text.alias("text"))
    in_order.write.mode("overwrite").option("maxRecordsPerFile", PARTS_PER_FILE).text(folder)
    return folder


def read_digest(spark: SparkSession, folder: str) -> DataFrame:
    """(part, text) of a written digest: one row per file, whose parts grow in file order."""
    files = spark.read.text(folder, wholetext=True).where("value <> ''")
    # Files are named part-<task>-<job id>-c<file of the task>.txt; the job id can have a -c and digits in it, too.
    task, file = [F.regexp_extract(F.col("_metadata.file_name"), p, 1).cast("bigint") for p in (r"^part-(\d+)", r"-c(\d+)\.[^-]*$")]
    return files.select((F.shiftleft(task, 32) + file).alias("part"), F.col("value").alias("text"))


def load_staging(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet folder as rows of the target schema, matched by column name.

    Files may differ in their columns and number types. A value that is none of the target's type
    is NULL; `reconcile.read_united` reports the columns whose types cannot be united.
    """
    rows, _ = read_united(spark, path)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return rows.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str | None = None,
    by: Sequence[str] = (),
    buckets: int = 0,
    bucket_by: Sequence[str] = (),
) -> None:
    """Create a Parquet table unless it is there, partitioned `by` and dealt over `buckets` files by key.

    A join on the keys of a bucketed table leaves its rows where they are.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(by)})" if by else ""
    parts += f" CLUSTERED BY ({', '.join(bucket_by)}) INTO {buckets} BUCKETS" if buckets else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{place}")


def append_rows(df: DataFrame, table: str) -> None:
    df.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def append_new_keys(staged: DataFrame, table: str, keys: Sequence[str], buckets: int) -> Sizes:
    """Append the distinct staged rows whose key the table does not hold; the table is bucketed by key.

    Only keys of the batch are shuffled to the table's buckets, and each bucket's new rows are
    written by one task. Returns the rows and characters that were added.
    """
    fresh = Observed(insert_new_keys(staged.sparkSession.table(table), staged, keys))
    append_rows(fresh.frame.repartition(buckets, *keys), table)
    return fresh.sizes()


def publish(df: DataFrame, table: str, version_path: str) -> int:
    """Make df the content of `table`: write a new folder, then point the table at it.

    df may read the table itself, since the old folder stays until the switch and after it.
    Returns the row count seen while writing.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df = align(df, spark.table(table).schema)
    seen = Observed(df)
    seen.frame.write.mode("errorifexists").parquet(version_path)
    create_table(spark, table, df.schema, version_path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{version_path}'")
    spark.catalog.refreshTable(table)
    return seen.sizes()[WHOLE][0]


def _literal(value: object) -> str:
    """A partition value as SQL text."""
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish_partitions(df: DataFrame, table: str, by: Sequence[str], version_path: str) -> None:
    """Replace the partitions present in df: write them to a new folder, then point the table's
    partitions there one by one.

    df may read the table itself; the old folders stay, and other partitions are untouched.
    A batch touches few partitions, so their names are listed on the driver. Folders are named
    as Spark has written them, so any value can be a partition, NULL too.
    """
    spark = df.sparkSession
    df.hint("rebalance", *by).write.mode("errorifexists").partitionBy(*by).parquet(version_path)
    # Each row names its file: its folder is cut out by linear steps, and decoded once per folder.
    file = F.col("_metadata.file_path")
    above = F.left(file, F.length(file) - F.length(F.substring_index(file, "/", -1)) - 1)
    folders = spark.read.schema(df.schema).parquet(version_path).select(*by, F.substring_index(above, "/", -len(by)).alias("folder")).distinct()
    place = F.url_decode(F.replace(F.col("folder"), F.lit("+"), F.lit("%2B")))
    written = folders.select(*by, place.alias("folder")).collect()
    clauses = {
        r["folder"]: (
            f"PARTITION ({', '.join(f'`{c}` = {_literal(r[c])}' for c in by)})",
            f"LOCATION {_literal(version_path + '/' + r['folder'])}",
        )
        for r in written
    }
    listed = spark.sql(f"SHOW PARTITIONS {table}").where(F.col("partition").isin(list(clauses)))
    known = {r.partition for r in listed.collect()}
    new = [" ".join(clause) for folder, clause in clauses.items() if folder not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new)}")
    for folder in known:
        spec, place = clauses[folder]
        spark.sql(f"ALTER TABLE {table} {spec} SET {place}")
    spark.catalog.refreshTable(table)
