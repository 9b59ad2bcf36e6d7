"""Parquet files whose schemas differ, read as one table by column name.

Number types are widened to one that holds both; a column that only some files have is NULL in the
others; a column whose types cannot be united is text, and told in a report. Schemas are read
by Spark, many files at a time: files that Spark can merge are one group, and only a set of files that
conflicts is cut in half and looked at again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19)))

REPORT = "column string, types array<string>, files bigint"


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds the values of both, or None."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max((a, b), key=lambda t: _WHOLE.index(type(t)))
    if T.DecimalType in kinds and kinds <= {*_WHOLE, T.DecimalType}:
        sides = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
        before, after = (max(s[k] for s in sides) for k in (0, 1))
        return T.DecimalType(before + after, after) if before + after <= 38 else None
    if kinds <= {*_WHOLE, T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if kinds == {T.ArrayType}:
        inner = wider(a.elementType, b.elementType)
        return T.ArrayType(inner) if inner is not None else None
    if kinds == {T.StructType}:
        names = list(dict.fromkeys([*a.names, *b.names]))
        inner = [wider(a[n].dataType if n in a.names else T.NullType(), b[n].dataType if n in b.names else T.NullType()) for n in names]
        return T.StructType([T.StructField(n, t) for n, t in zip(names, inner)]) if None not in inner else None
    return None


@dataclass(frozen=True)
class _Group:
    """Files that Spark reads with one schema."""

    schema: T.StructType
    files: tuple[str, ...]


def _groups(spark: SparkSession, files: Sequence[str]) -> list[_Group]:
    reader = spark.read.option("mergeSchema", True)
    try:
        return [_Group(reader.parquet(*files).schema, tuple(files))]
    except (PySparkException, Py4JJavaError) as refused:
        if len(files) == 1 or "CANNOT_MERGE" not in str(refused):
            raise
    half = len(files) // 2
    found = _groups(spark, files[:half]) + _groups(spark, files[half:])
    alike: dict[str, _Group] = {}
    for g in found:
        key = g.schema.json()
        alike[key] = _Group(g.schema, (*alike[key].files, *g.files)) if key in alike else g
    return list(alike.values())


def united_schema(schemas: Sequence[T.StructType]) -> tuple[T.StructType, list[str]]:
    """Every column once, in order of appearance, in a type that holds all of its values; and the
    columns without such a type, which become text. Names differ in more than case."""
    kinds: dict[str, tuple[str, T.DataType]] = {}
    torn: list[str] = []
    for schema in schemas:
        for f in schema.fields:
            name, known = kinds.get(f.name.lower(), (f.name, T.NullType()))
            kind = wider(known, f.dataType)
            if kind is None and f.name.lower() not in torn:
                torn.append(f.name.lower())
            kinds[f.name.lower()] = (name, f.dataType if kind is None else kind)
    fields = [T.StructField(n, T.StringType() if k in torn else t) for k, (n, t) in kinds.items()]
    return T.StructType(fields), [kinds[k][0] for k in torn]


def _widened(column: Column, kind: T.DataType, goal: T.DataType) -> Column:
    """column, of type kind, as the wider goal; structs by field name."""
    if kind == goal:
        return column
    if isinstance(goal, T.StructType) and isinstance(kind, T.StructType):
        parts = [(_widened(column[f.name], kind[f.name].dataType, f.dataType) if f.name in kind.names else F.lit(None).cast(f.dataType)).alias(f.name) for f in goal.fields]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(goal, T.ArrayType) and isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _widened(x, kind.elementType, goal.elementType))
    if isinstance(goal, T.StringType) and isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column)
    return column.cast(goal)


def read_united(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame]:
    """(rows, report) of all Parquet files under the paths.

    The report has a line for each column whose types cannot be united: the column, its types, and
    the number of files that hold it. Partition columns of the folders are not read.
    """
    files = sorted(f for p in paths for f in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(p).inputFiles())
    groups = _groups(spark, files)
    schema, torn = united_schema([g.schema for g in groups])

    def shaped(group: _Group) -> DataFrame:
        own = {f.name.lower(): f for f in group.schema.fields}
        rows = spark.read.schema(group.schema).parquet(*group.files)
        columns = [(_widened(F.col(f"`{own[f.name.lower()].name}`"), own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
        return rows.select(*columns)

    told = []
    for name in torn:
        holding = [(f.dataType.simpleString(), len(g.files)) for g in groups for f in g.schema.fields if f.name.lower() == name.lower()]
        told.append((name, sorted({k for k, _ in holding}), sum(n for _, n in holding)))
    return reduce(DataFrame.unionByName, map(shaped, groups)), spark.createDataFrame(told, REPORT)
