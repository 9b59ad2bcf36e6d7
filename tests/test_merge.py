"""Laws of the keyed merges, hot keys included."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from finloom.operators import lookup, merge
from finloom.plans.star import load_star
from finloom.schemas import COMPANIES, EARNING_PERIODS, EARNING_RECORD, EARNINGS, empty_table


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def frame(spark, data, schema="k string, v int, n int"):
    return spark.createDataFrame(data, schema)


def test_first_and_last_per_key(spark):
    df = frame(spark, [("a", 1, 1), ("a", None, 2), ("b", 3, 1), (None, 4, 1), (None, 5, 2)])
    assert rows(merge.first_per_key(df, ["k"], ["n"])) == Counter([("a", 1, 1), ("b", 3, 1), (None, 4, 1)])
    assert rows(merge.last_per_key(df, ["k"], ["n"])) == Counter([("a", None, 2), ("b", 3, 1), (None, 5, 2)])


def test_insert_if_absent(spark):
    target = frame(spark, [("a", 1, 1)])
    staged = frame(spark, [("a", 2, 2), ("b", 1, 1), ("b", 1, 1), ("b", 2, 1), (None, 1, 1)])
    fresh = merge.insert_if_absent(target, staged, ["k"])
    assert rows(fresh) == Counter([("b", 1, 1), ("b", 2, 1), (None, 1, 1)])
    after = target.unionByName(fresh)
    assert rows(merge.insert_if_absent(after, staged.where("k IS NOT NULL"), ["k"])) == Counter()


def test_replace_by_keys(spark):
    target = frame(spark, [("a", 1, 1), ("a", 2, 1), ("b", 1, 1), (None, 1, 1)])
    staged = frame(spark, [("a", 9, 1), (None, 9, 1)])
    once = merge.replace_by_keys(target, staged, ["k"])
    assert rows(once) == Counter([("a", 9, 1), ("b", 1, 1), (None, 1, 1), (None, 9, 1)])
    safe = merge.replace_by_keys(target, staged, ["k"], null_safe=True)
    assert rows(safe) == Counter([("a", 9, 1), ("b", 1, 1), (None, 9, 1)])
    assert rows(merge.replace_by_keys(safe, staged, ["k"], null_safe=True)) == rows(safe)


def test_upsert_latest(spark):
    target = frame(spark, [("a", 1, 0), ("a", 2, 0), ("b", 1, 0), (None, 1, 0)])
    staged = frame(spark, [("a", 5, 1), ("a", None, 2), ("c", 7, 1), ("c", 8, 2), (None, 3, 1)])
    once = merge.upsert_latest(target, staged, ["k"], ["n"])
    assert rows(once) == Counter(
        {("a", None, 2): 2, ("b", 1, 0): 1, ("c", 8, 2): 1, (None, 1, 0): 1, (None, 3, 1): 1}
    )
    known = staged.where("k IS NOT NULL")
    assert rows(merge.upsert_latest(once, known, ["k"], ["n"])) == rows(once)
    later = frame(spark, [("a", 6, 3)])
    assert rows(merge.upsert_latest(once, later, ["k"], ["n"]))[("a", 6, 3)] == 2


def test_dimension_is_insert_only(spark):
    dim = spark.createDataFrame([("id-a", "a", None, 1)], "id string, k string, s string, v int")
    records = spark.createDataFrame(
        [("a", None, 9, 1), ("b", None, 2, 2), ("b", None, 3, 1), ("b", "x", 4, 5)], "k string, s string, v int, n int"
    )
    out = merge.extend_dimension(dim, records, "id", ["k", "s"], ["n"])
    assert rows(out.drop("id")) == Counter([("a", None, 1), ("b", None, 3), ("b", "x", 4)])
    again = merge.extend_dimension(out, records, "id", ["k", "s"], ["n"])
    assert rows(again) == rows(out)
    keyed = merge.resolve_key(records, out, "id", ["k", "s"])
    assert keyed.count() == 4 and keyed.where("k = 'a'").first().id == "id-a"


def test_change_flags(spark):
    old = frame(spark, [("a", 1, 1), ("b", None, 1), ("c", 1, 1)])
    new = frame(spark, [("a", 1, 1), ("b", 2, 1), ("d", 1, 1)])
    flagged = merge.change_flags(old, new, ["k"], ["v", "n"])
    assert {r.k: r.change for r in flagged.collect()} == {"a": "same", "b": "update", "d": "insert"}
    after = merge.apply_changes(old, flagged, ["k"])
    assert rows(after) == Counter([("a", 1, 1), ("b", 2, 1), ("c", 1, 1), ("d", 1, 1)])


def hot(spark, n=30_000):
    """A third of the rows under one key, a third under NULL."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.col("id"),
    )


def test_heavy_keys_are_found(spark):
    found = lookup.heavy_keys(hot(spark), ["k"])
    expected = spark.range(1).select(F.xxhash64(F.lit("hot")), F.xxhash64(F.lit(None).cast("string"))).first()
    assert set(found) == set(expected)
    assert lookup.heavy_keys(spark.range(5000).select(F.col("id").alias("k")), ["k"]) == []


def test_lookup_join_equals_plain_join(spark):
    left = hot(spark)
    right = left.select("k").distinct().where("k IS NULL OR k = 'hot' OR k LIKE '%7'").withColumn("w", F.length("k"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(lookup.lookup_join(left, right, ["k"], how)) == rows(left.join(right, "k", how)), how
    twin = right.withColumnRenamed("k", "r")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = left.join(twin, F.col("k").eqNullSafe(F.col("r")), how).drop("r")
        assert rows(lookup.lookup_join(left, right, ["k"], how, null_safe=True)) == rows(plain), how


def test_lookup_join_wants_one_key_type(spark):
    left = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        lookup.lookup_join(left, left.select(F.col("k").cast("int").alias("k")), ["k"])


def test_hot_key_is_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = hot(spark)
        right = left.select("k").distinct().withColumn("w", F.lit(1))
        out = lookup.lookup_join(left, right, ["k"], null_safe=True).where("k = 'hot'")
        assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def record(name, symbol, quarter, actual, ms, cap=None):
    measure = lambda v: {"value": v, "unit": "M"}
    return {
        "company": {"name": name, "symbol": symbol},
        "country": "US",
        "eps": {"actual": measure(actual), "forecast": measure(None)},
        "revenue": {"actual": measure(actual), "forecast": measure(1.0)},
        "market_cap": measure(cap),
        "year": 2025,
        "quarter": quarter,
        "call_date": ms,
        "timezone": "America/New_York",
    }


def test_star_load(spark):
    def batch(records):
        df = spark.createDataFrame(records, EARNING_RECORD)
        return df.withColumn("seq", F.monotonically_increasing_id())

    empty = [empty_table(spark, s) for s in (COMPANIES, EARNING_PERIODS, EARNINGS)]
    first = batch([record("A", "a", 1, 1.0, 0, 5.0), record("A", "a", 1, 2.0, 1000, 6.0), record("B", None, 1, None, 0)])
    one = load_star(first, *empty, ("call_date", "seq"))
    assert {r.name: r.market_cap for r in one["companies"].collect()} == {"A": Decimal("5.00"), "B": None}
    got = {r.revenue_actual: r.call_date for r in one["earnings"].collect()}
    assert got == {Decimal("2.00"): dt.datetime(1970, 1, 1, 0, 0, 1), None: dt.datetime(1970, 1, 1)}

    args = (one["companies"], one["periods"], one["earnings"], ("call_date", "seq"))
    again = load_star(first, *args)
    assert {r.change for r in again["changes"].collect()} == {"same"}
    for name in ("companies", "periods", "earnings"):
        assert rows(again[name]) == rows(one[name])

    foreign = load_star(first, *args, foreign_ids=True)
    assert rows(foreign["earnings"]) == rows(one["earnings"])

    late = batch([record("B", None, 1, 4.0, 0, 9.0), record("C", "c", 2, 1.0, 0)])
    two = load_star(late, *args)
    assert {r.change for r in two["changes"].collect()} == {"update", "insert"}
    assert two["companies"].where("name = 'B'").first().market_cap is None
    assert two["earnings"].count() == 3 and two["periods"].count() == 2

    zero = load_star(batch([record("B", None, 1, None, 0)]), *empty, ("call_date", "seq"), missing_as_zero=True)
    assert zero["earnings"].first().revenue_actual == 0


def test_star_load_with_foreign_ids(spark):
    companies = spark.createDataFrame([("17", "A", "a", "US", None, None)], COMPANIES)
    empty = [empty_table(spark, s) for s in (EARNING_PERIODS, EARNINGS)]
    df = spark.createDataFrame([record("A", "a", 1, 1.0, 0)], EARNING_RECORD).withColumn("seq", F.lit(1))
    out = load_star(df, companies, *empty, ("call_date", "seq"), foreign_ids=True)
    assert out["companies"].count() == 1 and out["earnings"].first().company_id == "17"
