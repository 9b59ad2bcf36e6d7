"""Ordered text out of rows, in parts of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from finloom.session import materialize

LINES_PER_PART = 500


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_no") -> DataFrame:
    """df with its 0-based position by `order` (a total order), without a one-task sort.

    Rows are range-partitioned by the order and written once, with the partition and the
    place inside it; a row's position is that place plus the rows of the partitions before.
    Only the per-partition counts, one row per partition, are summed in one task.
    """
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_partition", F.shiftright("_id", 33))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_id"),
        "ordered",
    )
    earlier = W.orderBy("_partition").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_partition")
        .agg(F.count("*").alias("n"))
        .select("_partition", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_partition")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_partition", "_place", "_start")
    )


def ordered_parts(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    text: str,
    lines_per_part: int = LINES_PER_PART,
) -> DataFrame:
    """(groups, part, text): a group's parts, put together by part number, are its whole text.

    The text itself may end the order; a hash of it stands for it, so no text is a sort key.
    Part numbers grow with the order over all groups. A part holds at most lines_per_part
    lines, so no task collects a whole group, however large that is.
    """
    tied = [c for c in order if c != text]
    lines = df.select(*groups, *[c for c in tied if c not in groups], F.xxhash64(text).alias("_tie"), F.col(text))
    # Stored first: the range sample would make the lines a second time.
    numbered = number_rows(materialize(lines, "lines"), [*groups, *tied, *(["_tie"] if text in order else [])])
    return numbered.groupBy(*groups, F.floor(F.col("row_no") / lines_per_part).alias("part")).agg(
        F.expr(f"listagg(`{text}`, '') WITHIN GROUP (ORDER BY row_no)").alias("text")
    )
