"""Joins of a large table to a table with one row per key, safe against hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 0.01
_TRACKED = 10_000
_MOST_HEAVY = 2_000


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def heavy_keys(df: DataFrame, keys: Sequence[str]) -> list[int]:
    """Hashes of the keys (NULL included) that fill more than an even shuffle partition.

    That is a share of one over the shuffle partitions, and HEAVY_SHARE at most. One scan of
    the key columns into a frequent-items sketch that is merged on the map side; the answer
    is at most _MOST_HEAVY numbers. It only decides how rows are spread, so a sketch error can never change a
    join's result.
    """
    share = min(HEAVY_SHARE, 1 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    most = min(_MOST_HEAVY, round(1 / share))
    found = df.select(key_hash(keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {most}, {_TRACKED})").alias("top"), F.count("*").alias("n")
    )
    row = found.first()
    return sorted(t["item"] for t in row["top"] or [] if t["count"] >= max(share * row["n"], 2))


def _broadcast_by_size(df: DataFrame) -> bool:
    """Whether Spark's size estimate lets it send df to every task."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
    heavy: Sequence[int] | None = None,
    sketch: DataFrame | None = None,
) -> DataFrame:
    """Join `left` to `right`, which has at most one row per key.

    how: inner, left, left_semi or left_anti. Rows of a heavy key are spread over as many
    salts as there are shuffle partitions, and only the matching right rows (at most
    _MOST_HEAVY) are repeated, once per salt. Every left row still meets its one right row,
    so the result is that of the plain join. The salt comes from the row's content, so a
    task that is run again spreads its rows as before; what equal copies of one row still
    put in one place, adaptive execution splits.

    `heavy` are the heavy keys when the caller knows them; `sketch` is a frame to find them in
    that is cheaper to scan than `left`. A right side that Spark broadcasts by its size needs
    no search, since then no row of `left` moves.
    """
    keys = list(keys)
    for k in keys:
        # Key hashes decide the salt, and equal values of two types hash differently.
        if left.schema[k].dataType != right.schema[k].dataType:
            raise ValueError(f"key {k} is {left.schema[k].dataType} on the left, {right.schema[k].dataType} on the right")
    if heavy is None:
        heavy = [] if _broadcast_by_size(right) else heavy_keys(left if sketch is None else sketch, keys)
    on = keys
    if heavy:
        salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = key_hash(keys).isin(heavy)
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salts)).cast("int")
        every = F.sequence(F.lit(0), F.lit(salts - 1))
        left = left.withColumn("_salt", F.when(hot, spread).otherwise(0))
        right = right.withColumn("_salt", F.explode(F.when(hot, every).otherwise(F.array(F.lit(0)))))
        on = [*keys, "_salt"]
    if null_safe:
        joined = _null_safe(left, right, on, how)
    else:
        joined = left.join(right, on, how)
    return joined.drop("_salt") if heavy else joined


def same_key(keys: Sequence[str]) -> Column:
    """NULL-safe equality of each key with its renamed twin `_r_<key>`."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])


def _null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    return left.join(renamed, same_key(on), how).drop(*[f"_r_{k}" for k in on])
