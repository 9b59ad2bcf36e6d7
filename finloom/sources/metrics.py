"""What a job writes, counted while it is written, and one table of it.

Counting a table after each load reads all of it again. Here the rows and characters of what is
written are observed by the write itself, and a table's size follows from the latest count of each
of its partitions, or from what was added.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.sources.readers import path_exists

WHOLE = ""
METRIC = "job string, table string, part string, as_of timestamp_ntz, seq bigint, added boolean, rows bigint, characters bigint"
Sizes = dict[str, tuple[int, int]]


def text_length(df: DataFrame) -> Column:
    """Characters in the text columns of a row."""
    sizes = [F.coalesce(F.length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return sum((s.cast("long") for s in sizes), F.lit(0).cast("long"))


class Observed:
    """A frame to write, and after that the rows and characters written of each part.

    Parts are conditions that exclude each other, few enough to be columns of one aggregate.
    """

    def __init__(self, df: DataFrame, parts: Mapping[str, Column] | None = None):
        self.names, self._seen = list(parts or {WHOLE: F.lit(True)}), Observation()
        conditions, length = list((parts or {WHOLE: F.lit(True)}).values()), text_length(df)
        counts = [F.count_if(c).alias(f"r{k}") for k, c in enumerate(conditions)]
        sums = [F.coalesce(F.sum(F.when(c, length)), F.lit(0)).alias(f"c{k}") for k, c in enumerate(conditions)]
        self.frame = df.observe(self._seen, *counts, *sums) if conditions else df

    def sizes(self) -> Sizes:
        if not self.names:
            return {}
        try:
            got = self._seen.get
        except Py4JJavaError as lost:
            if "assertion failed" not in str(lost):
                raise
            # adaptive execution leaves the count out of a plan that it finds to be empty
            return dict.fromkeys(self.names, (0, 0))
        return {n: (int(got[f"r{k}"]), int(got[f"c{k}"])) for k, n in enumerate(self.names)}


class Metrics:
    """The metrics table of a store; its rows are few, one per written part and run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/*.parquet"):
            return self.spark.createDataFrame([], METRIC)
        return self.spark.read.schema(METRIC).parquet(self.path)

    def latest(self) -> DataFrame:
        """(table, part, rows, characters, seq): the last count of each part with what was added since."""
        own = self.rows()
        base = own.groupBy("table", "part").agg(F.max(F.when(~F.col("added"), F.col("seq"))).alias("base"))
        since = own.join(base, ["table", "part"]).where(F.col("seq") >= F.coalesce("base", F.lit(0)))
        return since.groupBy("table", "part").agg(*[F.sum(c).alias(c) for c in ("rows", "characters")], F.max("seq").alias("seq"))

    def known(self, table: str) -> tuple[int, int] | None:
        """(rows of the table, last run's number), or None for a table without metrics."""
        got = self.latest().where(F.col("table") == table).agg(F.sum("rows").alias("n"), F.max("seq").alias("seq")).first()
        return None if got["seq"] is None else (got["n"], got["seq"])

    def record(self, job: str, table: str, as_of: dt.datetime, sizes: Sizes, added: bool = False) -> int:
        """Note what a run wrote; returns the rows that the table has now."""
        known = self.known(table)
        seq = known[1] + 1 if known else 1
        if sizes:
            lines = [(job, table, part, as_of, seq, added, n, c) for part, (n, c) in sizes.items()]
            self.spark.createDataFrame(lines, METRIC).coalesce(1).write.mode("append").parquet(self.path)
        now = self.known(table)
        return now[0] if now else 0

    def seed(self, table: str, stored: DataFrame, by: tuple[str, ...], as_of: dt.datetime) -> None:
        """Count a table that was loaded before there were metrics of it, once."""
        if self.known(table) is None:
            length = text_length(stored.drop(*by))
            counts = stored.groupBy(*by).agg(F.count("*").alias("rows"), F.coalesce(F.sum(length), F.lit(0)).alias("characters")).collect()
            sizes = {part_name({c: r[c] for c in by}): (r["rows"], r["characters"]) for r in counts if r["rows"]}
            if sizes:
                self.record("seed", table, as_of, sizes)


def part_name(values: Mapping[str, object]) -> str:
    return "/".join(f"{c}={v}" for c, v in values.items())
