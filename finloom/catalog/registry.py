"""Registration of queries and their SQL, and access to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a narrow table that one task makes into wide rows.
SPREAD_BYTES = 4 << 20

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables by name, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self._dir = spark, sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self._dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def spread(self, name: str, key: str) -> DataFrame:
        """A table out of which wider rows are made for costly work: dealt by key while narrow.

        The number of tasks follows from its bytes, at least one a core, and is given outright:
        adaptive execution would gather the narrow rows before they grow.
        """
        df = getattr(self, name)
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        return df.repartition(max(self.spark.sparkContext.defaultParallelism, -(-size // SPREAD_BYTES)), key)


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable]:
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
