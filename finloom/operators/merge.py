"""Keyed merges as plain DataFrame -> DataFrame functions; none of them writes.

Parquet tables have no MERGE, so an upsert is 'left rows without a match' plus 'new rows'.
The batch side is reduced to one row per key first, with map-side combining, so a key that
holds a large part of the batch never reaches one task uncombined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.functions.keys import surrogate_key
from finloom.operators.lookup import heavy_keys, lookup_join, same_key
from finloom.session import materialize


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], choose) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row, rank = F.struct(*rest), F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(choose(row, rank).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by `order`, whose columns must be non-NULL and break ties."""
    return _pick(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the largest by `order`, whose columns must be non-NULL and break ties."""
    return _pick(df, keys, order, F.max_by)


def insert_if_absent(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], sql_not_in: bool = False
) -> DataFrame:
    """The distinct staged rows whose key is not in target; append these.

    sql_not_in gives the NULL rules of `NOT IN`: one NULL key in a target hides every row,
    and a staged NULL key is only new to an empty target. It takes a single key.
    """
    known = target.select(*keys).distinct()
    fresh = lookup_join(staged.distinct(), known, keys, "left_anti", sketch=staged)
    if not sql_not_in:
        return fresh
    (key,) = keys
    facts = known.agg(F.count("*").alias("n"), F.count_if(F.col(key).isNull()).alias("nulls"))
    size, nulls = facts.select("n").scalar(), facts.select("nulls").scalar()
    return fresh.where((size == 0) | ((nulls == 0) & F.col(key).isNotNull()))


def insert_new_keys(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """insert_if_absent for a target that lies by key already, such as one bucketed by it.

    The batch is reduced to one row per key before it meets the target, so no key is hot there and
    only the batch's keys are shuffled; its rows then follow the keys that are new. A row with a NULL
    in its key is always new. `staged` is read twice.
    """
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    asked = staged.where(whole).select(*keys).distinct()
    new = materialize(asked.join(target.select(*keys), list(keys), "left_anti"), "new-keys")
    rows = lookup_join(staged.distinct(), new, keys, "left_semi", sketch=staged)
    return rows.unionByName(staged.where(~whole).distinct())


def replace_by_keys(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Target rows whose key is not staged, plus all staged rows.

    With plain equality a NULL key never matches, so such rows stay and add up.
    """
    survivors = lookup_join(target, staged.select(*keys).distinct(), keys, "left_anti", null_safe)
    return survivors.unionByName(staged.select(*target.columns))


def update_matched(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], heavy: Sequence[int] | None = None
) -> DataFrame:
    """Target rows with every non-key column taken from the staged row of the same key, NULLs too.

    staged has one row per key; unmatched target rows stay as they are.
    """
    rest = [c for c in target.columns if c not in keys]
    news = staged.select(*keys, F.struct(*rest).alias("_new"))
    both = lookup_join(target, news, keys, "left", heavy=heavy)
    return both.select(
        *[
            c if c in keys else F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            for c in target.columns
        ]
    )


def upsert_latest(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Update matches with the latest staged row per key and insert the keys that are new.

    A row with a NULL in its key equals no other row: staged ones are all inserted. The keys
    already present are found by a semi join against the batch, so a batch small enough to
    broadcast needs no shuffle of the target. `staged` is read more than once; store it
    first when it is costly to compute.
    """
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    latest, heavy = last_per_key(staged.where(whole), keys, order), heavy_keys(target, keys)
    known = lookup_join(target.select(*keys), latest.select(*keys), keys, "left_semi", heavy=heavy).distinct()
    new = latest.join(known, list(keys), "left_anti").unionByName(staged.where(~whole).distinct())
    return update_matched(target, latest, keys, heavy).unionByName(new.select(*target.columns))


def upsert_unique(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """upsert_latest for a target with one row per key, NULL keys included: it is read once.

    Target rows whose key is not staged stay, and the latest staged row of every key is added.
    The latest rows are stored, since they are read twice. Keys match NULL to NULL.
    """
    latest = materialize(last_per_key(staged, keys, order).select(*target.columns), "latest")
    return lookup_join(target, latest.select(*keys), keys, "left_anti", null_safe=True).unionByName(latest)


def extend_dimension(
    dimension: DataFrame,
    records: DataFrame,
    id_column: str,
    keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Lookup-or-insert: existing rows are never changed, the first record of a new key is added.

    Keys match NULL to NULL. The id is a hash of the key, so it needs no numbering pass.
    """
    first = first_per_key(records, keys, order)
    known = dimension.select(*keys)
    new = first.join(known.withColumnsRenamed({k: f"_r_{k}" for k in keys}), same_key(keys), "left_anti")
    ids = surrogate_key(*[F.col(k) for k in keys]).alias(id_column)
    return dimension.unionByName(
        new.select(ids, *[c for c in dimension.columns if c != id_column]).select(*dimension.columns)
    )


def resolve_key(
    records: DataFrame,
    dimension: DataFrame,
    id_column: str,
    keys: Sequence[str],
    sketch: DataFrame | None = None,
) -> DataFrame:
    """Records with the id of their dimension row, matching NULL to NULL."""
    return lookup_join(records, dimension.select(id_column, *keys), keys, "inner", True, sketch=sketch)


def change_flags(
    target: DataFrame, latest: DataFrame, keys: Sequence[str], compared: Sequence[str]
) -> DataFrame:
    """`latest` with a `change` column: insert, update or same, by the compared columns.

    Both sides have one row per key.
    """
    old = target.select(*keys, F.struct(*compared).alias("_old"))
    both = latest.join(old, list(keys), "left")
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.struct(*compared).eqNullSafe(F.col("_old")), "same")
        .otherwise("update")
    )
    return both.withColumn("change", change).drop("_old")


def merge_changes(
    target: DataFrame, latest: DataFrame, keys: Sequence[str], compared: Sequence[str]
) -> DataFrame:
    """The target with the rows of latest that are new or differ in a compared column.

    Both sides have one row per key and are read once, in one full join.
    """
    rest = [c for c in target.columns if c not in keys]
    sides = [df.select(*keys, F.struct(*rest).alias(n)) for df, n in ((target, "_old"), (latest, "_new"))]
    both = sides[0].join(sides[1], list(keys), "full")
    fields = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in compared])
    same = F.col("_old").isNotNull() & fields("_old").eqNullSafe(fields("_new"))
    picked = F.when(F.col("_new").isNull() | same, F.col("_old")).otherwise(F.col("_new"))
    return both.select(*keys, picked.alias("_row")).select(*[c if c in keys else f"_row.{c}" for c in target.columns])


def apply_changes(target: DataFrame, flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after the inserts and updates that change_flags found."""
    changed = flagged.where("change <> 'same'").select(*target.columns)
    return target.join(changed.select(*keys), list(keys), "left_anti").unionByName(changed)
