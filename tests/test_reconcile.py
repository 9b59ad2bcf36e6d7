"""Files that differ in columns and types, read as one table."""

from collections import Counter

import pytest
from pyspark.sql import types as T

from finloom.sources import writers
from finloom.sources.reconcile import read_united, united_schema, wider


def write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_columns_of_some_files_only(spark, tmp_path):
    write(spark, tmp_path / "s", [(1, "x")], "a int, b string")
    write(spark, tmp_path / "s", [(2, "y")], "a int, c string")
    target = spark.createDataFrame([], "c string, a int, b string, d double").schema
    assert rows(writers.load_staging(spark, str(tmp_path / "s"), target)) == Counter([(None, 1, "x", None), ("y", 2, None, None)])


def test_numbers_are_widened_and_torn_columns_told(spark, tmp_path):
    base = tmp_path / "s"
    write(spark, base / "day=1", [(1, 1.5, "x", ([1],), 7)], "k int, v float, w string, n struct<l:array<int>>, m int")
    write(spark, base / "day=2", [(2**40, 2, 5, ([2**40],), None)], "k bigint, v int, w int, n struct<l:array<bigint>>, m int")
    write(spark, base / "day=3", [(3, 9.25, None, (None, "q"))], "K smallint, v double, w string, n struct<l:array<int>, o:string>")
    united, report = read_united(spark, str(base))
    assert [(f.name, f.dataType.simpleString()) for f in united.schema.fields] == [("k", "bigint"), ("v", "double"), ("w", "string"), ("n", "struct<l:array<bigint>,o:string>"), ("m", "int")]
    got = {(r.k, r.v, r.w, None if r.n.l is None else tuple(r.n.l), r.n.o, r.m) for r in united.collect()}
    assert got == {(1, 1.5, "x", (1,), None, 7), (2**40, 2.0, "5", (2**40,), None, None), (3, 9.25, None, None, "q", None)}
    assert [(r.column, r.types, r.files) for r in report.collect()] == [("w", ["int", "string"], 3)]
    target = spark.createDataFrame([], "w int, k int").schema
    assert rows(writers.load_staging(spark, str(base / "day=1"), target)) == Counter([(None, 1)])


def test_many_files_of_two_kinds(spark, tmp_path):
    for k in range(6):
        write(spark, tmp_path / "s", [(k,)], "a int" if k % 2 else "a bigint")
    united, report = read_united(spark, str(tmp_path / "s"))
    assert rows(united) == Counter([(k,) for k in range(6)]) and report.count() == 0
    assert united.schema["a"].dataType == T.LongType()


@pytest.mark.parametrize(
    "a, b, goal",
    [
        (T.ByteType(), T.ShortType(), T.ShortType()),
        (T.LongType(), T.FloatType(), T.DoubleType()),
        (T.DecimalType(10, 2), T.IntegerType(), T.DecimalType(12, 2)),
        (T.DecimalType(38, 0), T.DecimalType(38, 10), None),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.StringType(), T.LongType(), None),
        (T.NullType(), T.BinaryType(), T.BinaryType()),
        (T.BooleanType(), T.IntegerType(), None),
    ],
)
def test_wider_types(a, b, goal):
    assert wider(a, b) == wider(b, a) == goal


def test_a_torn_column_is_text_whatever_comes_after():
    one, two = (T.StructType([T.StructField("x", t)]) for t in (T.StringType(), T.IntegerType()))
    for order in ([one, two, two], [two, one, two], [two, two, one]):
        schema, torn = united_schema(order)
        assert schema["x"].dataType == T.StringType() and torn == ["x"]
