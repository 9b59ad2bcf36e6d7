"""Digest text x members -> one message row per member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finloom.functions.keys import message_group


# Characters of one message's text: with four bytes each it stays below 256 KB.
MESSAGE_CHARACTERS = 60_000


def sized_parts(texts: DataFrame, size: int = MESSAGE_CHARACTERS) -> DataFrame:
    """(part, text): the rows of texts, put together by `part`, cut anew every `size` characters.

    The cuts depend on the text alone, not on how its rows or files were laid out. Only the
    lengths, one number per row, are summed in one task.
    """
    sizes = texts.select("part", F.length("text").cast("bigint").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = texts.where("text <> ''").join(starts, "part")
    last = F.col("start") + F.length("text") - 1
    pieces = placed.withColumn("_cut", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor(last / size))))
    begin = F.greatest(F.lit(0), F.col("_cut") * size - F.col("start"))
    end = (F.col("_cut") + 1) * size - F.col("start")
    piece = F.substring("text", (begin + 1).cast("int"), (end - begin).cast("int"))
    return (
        pieces.select("_cut", "start", piece.alias("piece"))
        .groupBy(F.col("_cut").alias("part"))
        .agg(F.expr("listagg(piece, '') WITHIN GROUP (ORDER BY start)").alias("text"))
    )


def member_messages(members: DataFrame, texts: DataFrame, groups: int = 10, copies: int | None = None) -> DataFrame:
    """(key, value) per distinct member and text row: the message group, and {text, address} as JSON.

    `texts` has one row for a text that fits a message; a larger one comes as the rows of
    sized_parts, whose `part` each message then carries. The rows are repeated once per
    spread bucket and joined to the members on that bucket: a small text is broadcast by its
    measured size, a large one meets the members in a shuffle over all buckets.
    """
    copies = copies or int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    receivers = members.select("response_id", "email_address").distinct()
    spread = F.pmod(F.xxhash64("response_id", "email_address"), F.lit(copies)).cast("int")
    bucketed = texts.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    body = ["text", F.col("email_address").alias("address"), *[c for c in texts.columns if c == "part"]]
    return (
        receivers.withColumn("_bucket", spread)
        .join(bucketed, "_bucket")
        .select(message_group(F.col("response_id"), groups).alias("key"), F.to_json(F.struct(*body)).alias("value"))
    )
