"""Batch folders that are merged level by level, with key filters that keep folders closed.

A stream's batches land in folders `batch_id=N`. When a level holds `fanout` folders, these become
one folder of the next level, so a reader opens a few folders a level however long the stream has
run, and each row is rewritten once a level. A folder counts once Spark has marked it as
complete; one whose batches a larger folder covers no longer counts. So a merge that is cut short
changes nothing, and a batch that comes again replaces itself, or is left out when it has been merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a merged folder in one hash bucket, about so many.
BUCKET_ROWS = 100_000
#: Bits of a key filter for each key, and how many of them a key sets: about one key in 100,000 is mistaken.
FILTER_BITS, FILTER_HASHES = 24, 16

Combine = Callable[[DataFrame], DataFrame]


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [str(f.getPath().toString()) for f in found or []]


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@dataclass(frozen=True, order=True)
class Run:
    """The folder of some batches, in a row."""

    first: int
    last: int
    level: int

    @property
    def name(self) -> str:
        return f"{self.first}-{self.last}"


@dataclass(frozen=True)
class Levels:
    """The folders of one stream under `path`; `combine` makes one folder's rows out of several's.

    Rows have the columns of `schema` and batch_id. `keys` place rows in hash buckets; `by` are
    further partition columns of merged folders, such as a day that depends on the key. With
    `filtered` every merged folder has a filter of its keys beside it; the newest batches, fewer
    than `fanout` folders, are small and have none.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    combine: Combine = lambda rows: rows
    fanout: int = 8
    by: Sequence[str] = ()
    filtered: bool = False

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])

    def _folder(self, run: Run) -> str:
        return f"{self.path}/_merged/level={run.level}/run={run.name}" if run.level else f"{self.path}/batch_id={run.first}"

    def _filter_folder(self, run: Run, bits: int | str) -> str:
        return f"{self.path}/_filters/{run.name}.{bits}"

    def _filters(self) -> dict[str, tuple[int, str]]:
        """Of each folder with a complete filter, by name: its bucket bits and the filter's path."""
        marks = [m.rsplit("/", 1)[0] for m in _matching(self.spark, f"{self.path}/_filters/*/_SUCCESS")]
        return {m.rsplit("/", 1)[1].split(".")[0]: (int(m.rsplit(".", 1)[1]), m) for m in marks}

    def _complete(self) -> list[Run]:
        found = []
        for marked in _matching(self.spark, f"{self.path}/batch_id=*/_SUCCESS"):
            batch = int(marked.split("/")[-2].split("=")[1])
            found.append(Run(batch, batch, 0))
        for marked in _matching(self.spark, f"{self.path}/_merged/level=*/run=*/_SUCCESS"):
            level, run = marked.split("/")[-3:-1]
            found.append(Run(*map(int, run.split("=")[1].split("-")), int(level.split("=")[1])))
        if self.filtered:
            known = self._filters()
            found = [r for r in found if not r.level or r.name in known]
        return found

    def _counted(self) -> tuple[list[Run], list[Run]]:
        """(folders that count, in batch order; complete ones that larger folders cover)."""
        kept: list[Run] = []
        covered = []
        for run in sorted(self._complete(), key=lambda r: (-r.level, r.first)):
            inside = any(k.level > run.level and k.first <= run.first and run.last <= k.last for k in kept)
            (covered if inside else kept).append(run)
        return sorted(kept), covered

    def runs(self) -> list[Run]:
        return self._counted()[0]

    def rows(self, runs: Sequence[Run] | None = None, buckets: dict[Run, Sequence[int]] | None = None) -> DataFrame:
        """The rows of these folders with their batch_id; of some folders only some buckets."""
        runs = self.runs() if runs is None else runs
        parts = []
        for merged in (False, True):
            paths = []
            for r in runs:
                if bool(r.level) == merged:
                    folders = [f"/bucket={b}" for b in buckets[r]] if buckets and r in buckets else [""]
                    paths += [self._folder(r) + f for f in folders]
            if paths:
                base = f"{self.path}/_merged" if merged else self.path
                parts.append(self.spark.read.schema(self.stored).option("basePath", base).parquet(*paths).select(*self.stored.fieldNames()))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.stored)

    def _hash(self) -> Column:
        return F.xxhash64(*[F.col(k) for k in self.keys])

    def _write(self, rows: DataFrame, run: Run, most: int) -> None:
        """rows, at most so many, as a folder; a merged one with a filter counts once that is written too."""
        if not run.level:
            rows.write.mode("overwrite").parquet(self._folder(run))
            return
        bits = int(most // BUCKET_ROWS).bit_length()
        by = ["bucket", *self.by]
        bucket = F.shiftrightunsigned(self._hash(), 64 - bits).cast("int") if bits else F.lit(0)
        rows.withColumn("bucket", bucket).hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(self._folder(run))
        if self.filtered:
            schema = T.StructType([*self.stored.fields, T.StructField("bucket", T.IntegerType())])
            stored = self.spark.read.schema(schema).parquet(self._folder(run))
            hashes = stored.select("bucket", self._hash().alias("h")).distinct()
            filters = hashes.groupBy("bucket").applyInArrow(_make_filter, "bucket int, filter binary")
            filters.write.mode("overwrite").parquet(self._filter_folder(run, bits))

    def has_merged(self, batch_id: int) -> bool:
        return any(r.level and r.first <= batch_id <= r.last for r in self.runs())

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Store a batch, then merge the levels that are full."""
        if not self.has_merged(batch_id):
            self._write(rows, Run(batch_id, batch_id, 0), 0)
        self.merge_full()

    def merge_full(self) -> None:
        while True:
            runs, covered = self._counted()
            levels = [[r for r in runs if r.level == n] for n in range(max((r.level for r in runs), default=-1) + 1)]
            full = next((own for own in levels if len(own) >= self.fanout), None)
            if full is None:
                return
            some = full[: self.fanout]
            merged = Run(some[0].first, some[-1].last, some[0].level + 1)
            stored = self.rows(some)
            self._write(self.combine(stored), merged, stored.count())
            # Who listed the folders before an earlier merge has had a whole round to read them.
            for run in covered:
                _delete(self.spark, self._folder(run))
                for folder in _matching(self.spark, self._filter_folder(run, "*")):
                    _delete(self.spark, folder)

    def may_hold(self, batch: DataFrame, runs: Sequence[Run]) -> dict[Run, list[int]]:
        """The buckets of these merged folders whose filter lets some key of the batch through.

        Only hashes of the batch's keys and filters are read and shuffled, no stored rows; what
        comes back is one line per bucket that has to be opened."""
        if not runs:
            return {}
        names, made = {r.name: r for r in runs}, self._filters()
        kind = "bucket int, filter binary"
        parts = [self.spark.read.schema(kind).parquet(made[n][1]).withColumn("run", F.lit(n)) for n in names]
        filters = reduce(DataFrame.unionByName, parts)
        sizes = [F.struct(F.lit(n).alias("run"), F.lit(made[n][0]).alias("bits")) for n in names]
        asked = batch.select(self._hash().alias("h")).distinct().select("h", F.inline(F.array(*sizes)))  # a few folders
        bucket = F.when(F.col("bits") > 0, F.expr("CAST(shiftrightunsigned(h, 64 - bits) AS INT)")).otherwise(0)
        asked = asked.select("run", bucket.alias("bucket"), "h")
        grouped = asked.groupBy("run", "bucket").cogroup(filters.select("run", "bucket", "filter").groupBy("run", "bucket"))
        out: dict[Run, list[int]] = {r: [] for r in runs}
        for row in grouped.applyInArrow(_test_filter, "run string, bucket int").collect():
            out[names[row["run"]]].append(row["bucket"])
        return {r: b for r, b in out.items() if b}


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits that each hash sets in a filter of size bits."""
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(17)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    ways = h[:, None] + step[:, None] * np.arange(FILTER_HASHES, dtype=np.uint64)
    return (((ways ^ (ways >> np.uint64(31))) >> np.uint64(7)) % np.uint64(size)).astype(np.int64)


def _make_filter(table: pa.Table) -> pa.Table:
    hashes = table["h"].to_numpy()
    bits = np.zeros(max(64, -(-FILTER_BITS * len(hashes) // 8) * 8), bool)
    bits[_places(hashes, len(bits)).ravel()] = True
    return pa.table({"bucket": table["bucket"][:1], "filter": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def _test_filter(asked: pa.Table, filters: pa.Table) -> pa.Table:
    some = slice(0, 0)
    if asked.num_rows and filters.num_rows:
        bits = np.unpackbits(np.frombuffer(filters["filter"][0].as_py(), np.uint8)).astype(bool)
        if bits[_places(asked["h"].to_numpy(), len(bits))].all(axis=1).any():
            some = slice(0, 1)
    return asked.select(["run", "bucket"])[some]
