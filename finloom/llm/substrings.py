"""Removal of word sequences that occur more than once: super-k-mer partitioning.

A window is `window` consecutive words of one document. Its minimiser is the run of `gram` words
inside it with the smallest hash (the first of equal ones). Consecutive windows with the same
minimiser form a super-k-mer. Two windows with the same words have the same minimiser, so a
minimiser that is found once rules its windows out, and equal windows always meet in a bucket.
Inside one super-k-mer no two windows are equal: the minimiser lies elsewhere in each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from finloom.llm.words import Words, mix, row_chunks, row_key, small_batches, words_of
from finloom.session import materialize

#: Words of a minimiser, where the window has that many.
GRAM = 8
#: A minimiser found more often is dealt over buckets of about so many super-k-mers.
BUCKET_ROWS = 1000
#: A minimiser found so often in one chunk of rows is dealt by chunk from the start.
HEAVY_IN_CHUNK = 12
#: Windows of a super-k-mer fit one bit each in a long.
MOST_WINDOWS = 60

_U = np.uint64


def _gram(window: int) -> int:
    return min(window, max(GRAM, window - MOST_WINDOWS + 1))


def super_kmers(w: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of the super-k-mers, their numbers of windows, and their minimisers' hashes."""
    gram = _gram(window)
    span, n = window - gram + 1, len(w.start) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    g, _ = w.grams(gram)
    low = (g & _U(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=_U)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    at = (np.minimum(low[:n], low[span - width : span - width + n]) & _U(0xFFFFFFFF)).astype(np.int64)
    inside = np.flatnonzero(w.doc[:n] == w.doc[window - 1 : window - 1 + n])
    new = np.ones(len(inside), bool)
    new[1:] = (np.diff(inside) != 1) | (at[inside[1:]] != at[inside[:-1]])
    begin = np.flatnonzero(new)
    return inside[begin], np.diff(np.append(begin, len(inside))), g[at[inside[begin]]]


def _minimisers(window: int):
    """(row, key, salt, mark) of every super-k-mer. A key found many times in one chunk of rows is
    known to repeat: its rows get a salt of the chunk's own, and one mark without salt tells so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in row_chunks(batches, "text"):
            w = words_of(texts)
            first, _, key = super_kmers(w, window)
            row = rows.column(0).to_numpy(zero_copy_only=False)
            _, where, many = np.unique(key, return_inverse=True, return_counts=True)
            heavy = many[where] >= HEAVY_IN_CHUNK
            salt = np.where(heavy, row[0] if len(row) and row[0] else 1, 0)
            told = np.unique(key[heavy])
            yield pa.record_batch(
                [
                    pa.array(np.concatenate([row[w.doc[first]], np.zeros(len(told), np.int64)]), pa.int64()),
                    pa.array(np.concatenate([key, told]).view(np.int64)),
                    pa.array(np.concatenate([salt, np.zeros(len(told), np.int64)]), pa.int64()),
                    pa.array(np.concatenate([np.zeros(len(key), bool), np.ones(len(told), bool)])),
                ],
                names=["row", "key", "salt", "mark"],
            )

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (row, key, salt, mark) sorted by key, salt, and marks first: those whose key is
    there more than once, with the part of the key's super-k-mers they go to, and whether the key has
    several parts. Holds one part between batches."""
    here, told, held, part = None, None, [], 0
    counted, count = None, 0  # rows so far of the last wide key

    def given(row, key, part, wide: bool) -> pa.RecordBatch:
        n = len(row)
        return pa.record_batch([pa.array(row, pa.int64()), pa.array(np.broadcast_to(key, n), pa.int64()), pa.array(np.broadcast_to(part, n), pa.int64()), pa.array(np.full(n, wide))], names=["row", "key", "part", "wide"])

    for batch in batches:
        row, key, salt = (batch.column(k).to_numpy() for k in range(3))
        mark = batch.column(3).to_numpy(zero_copy_only=False)
        if not len(row):
            continue
        known = key[mark] if told is None else np.append(key[mark], told)
        wide = np.isin(key, known) | (salt != 0)
        if wide.any():
            pick = wide & ~mark
            own = key[pick]
            if len(own):
                # any split into parts will do: rows of a part are about BUCKET_ROWS neighbours, also over batches
                first = np.ones(len(own), bool)
                first[1:] = own[1:] != own[:-1]
                nth = np.arange(len(own)) - np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
                nth += np.where(own == counted, count, 0) if counted is not None else 0
                counted, count = own[-1], nth[-1] + 1
                split = mix((salt[pick] + 1).view(_U)) + mix((nth // BUCKET_ROWS).astype(_U))
                yield given(row[pick], own, split.view(np.int64), True)
        told = key[-1] if wide[-1] and (salt[-1] == 0) else None
        row, key = row[~wide], key[~wide]
        if not len(row):
            continue
        # short runs inside the batch go on at once; the first and last may be parts of longer ones
        edge = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        size = np.repeat(np.diff(edge), np.diff(edge))
        inner = np.ones(len(key), bool)
        inner[: edge[1]] = inner[edge[-2] :] = False
        short = inner & (size > 1) & (size <= BUCKET_ROWS)
        if short.any():
            yield given(row[short], key[short], 0, False)
        rest = np.flatnonzero(~inner | (size > BUCKET_ROWS))
        for k, r in zip(key[rest].tolist(), row[rest].tolist(), strict=True):
            if k != here:
                if len(held) > 1 or part:
                    yield given(held, here, part, part > 0)
                here, held, part = k, [], 0
            if len(held) == BUCKET_ROWS:
                yield given(held, here, part, True)
                held, part = [], part + 1
            held.append(r)
    if len(held) > 1 or part:
        yield given(held, here, part, part > 0)


def _packed(window: int):
    """Super-k-mers whose minimiser is among the row's `seen`, as strings of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in row_chunks(batches, "text"):
            w = words_of(texts)
            first, count, key = super_kmers(w, window)
            seen = rows.column(3)
            flat = seen.flatten()
            owner = np.repeat(np.arange(len(texts)), seen.value_lengths().to_numpy(zero_copy_only=False))
            tag = mix(flat.field(0).to_numpy().view(_U) ^ mix(owner.astype(_U)))
            order = np.argsort(tag)
            own = mix(key ^ mix(w.doc[first].astype(_U)))
            slot = np.minimum(np.searchsorted(tag[order], own), len(tag) - 1)
            pick = np.flatnonzero(tag[order][slot] == own)
            row = w.doc[first[pick]]
            a, b = w.start[first[pick]], w.end[first[pick] + count[pick] + window - 2]
            spot = pa.array(order[slot[pick]])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(row)),
                    rows.column(1).take(pa.array(row)),
                    pa.array(first[pick] - w.first()[row], pa.int64()),
                    *[flat.field(k).take(spot) for k in range(3)],
                    pa.array([w.buf[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)], pa.binary()),
                ],
                names=["row", "id", "first", "key", "part", "wide", "packed"],
            )

    return run


def _mark(window: int):
    """Rows sorted by bucket: the windows of each that occur twice in the bucket, one bit each.

    Of an open bucket (a part of a hot minimiser's super-k-mers) each window not met twice goes on
    alone, and each window met twice goes on once without an owner. Of equal strings only the first
    is held, so memory follows the different strings of one bucket.
    """
    names = ["row", "id", "first", "bits", "packed"]
    types = [pa.int64(), None, pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: dict[bytes, list] = {}
        bucket, wide = None, False

        def settle() -> None:
            seen: dict[bytes, tuple | None] = {}
            for packed, own in held.items():
                gaps = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32)
                starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(packed)]
                for j in range(len(ends) - window + 1):
                    s = packed[starts[j] : ends[j + window - 1]]
                    if s not in seen:
                        seen[s] = None if own[4] else (own, j)
                    else:
                        if seen[s]:
                            other, k = seen[s]
                            other[3] |= 1 << k
                            seen[s] = None
                        own[3] |= 1 << j
            out.extend((own[0], own[1], own[2], own[3], None) for own in held.values() if own[3] and own[0] is not None)
            if wide:
                out.extend((own[0][0], own[0][1], own[0][2] + own[1], None, s) if own else (None, None, None, None, s) for s, own in seen.items())
            held.clear()

        def batch() -> pa.RecordBatch:
            got = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
            out.clear()
            return got

        for rows in batches:
            types[1] = rows.schema.field("id").type
            for row, rid, first, here, opened, packed in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if here != bucket:
                    settle()
                    bucket, wide = here, False
                wide |= opened
                own = held.get(packed)
                if own is None:
                    # a row without an owner stands for two windows or more
                    held[packed] = [row, rid, first, 0, row is None]
                    continue
                every = (1 << (packed.count(b" ") + 2 - window)) - 1
                if not own[4]:
                    own[3], own[4] = every, True
                if row is not None:
                    if own[0] is None:
                        own[0], own[1], own[2], own[3] = row, rid, first, every
                    else:
                        out.append((row, rid, first, every, None))
                if len(out) >= 5000:
                    yield batch()
            if out:
                yield batch()
        settle()
        if out:
            yield batch()

    return run


def _cut(window: int, drop_spans_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in row_chunks(batches, "text"):
            w = words_of(texts)
            edge, n = w.first(), len(w.start)
            spans = rows.column(drop_spans_at)
            flat = spans.flatten()
            owner = np.repeat(np.arange(len(texts)), np.nan_to_num(spans.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
            at, bit = np.nonzero((flat.field(1).to_numpy()[:, None] >> np.arange(MOST_WINDOWS)[None, :]) & 1)
            begin = edge[owner[at]] + flat.field(0).to_numpy()[at] + bit
            step = np.bincount(begin, minlength=n + 1)[: n + 1] > 0
            total = np.cumsum(step)
            covered = (total[:n] - np.concatenate([np.zeros(min(window, n), np.int64), total[: max(0, n - window)]])) > 0
            size = w.end - w.start + 1
            kept = np.frombuffer(w.buf, np.uint8)[np.repeat(~covered, size)].tobytes()
            upto = np.concatenate([[0], np.cumsum(np.where(covered, 0, size))])[edge].tolist()
            gone = np.concatenate([[0], np.cumsum(covered)])[edge]
            left = pa.array([kept[a : max(a, b - 1)] for a, b in zip(upto, upto[1:], strict=False)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([rows.column(0), left, pa.array(np.diff(edge)), pa.array(np.diff(gone))], names=["doc", "text", "n_words", "n_removed"])

    return run


def remove_repeats(docs: DataFrame, window: int = 35, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of docs: struct doc (its other columns), text (the kept words joined by one
    space), n_words and n_removed.

    Words are runs of anything but ASCII white space, unchanged. A word goes when a window over it
    has a word sequence that also starts anywhere else, in the same document too; windows are
    judged on the input. Null and empty texts, and texts shorter than a window, lose nothing (a
    null text gives an empty one with no words). Rows repeated with the same id and text are
    documents of their own, so their windows repeat. Columns of any name may come along in doc.

    1. Minimisers of all super-k-mers are sorted (16 bytes for each); those found once are done.
       One that is frequent where it is read is dealt by where it was read, not by itself alone.
    2. The other super-k-mers travel as one string to their minimiser's bucket, where equal windows
       are found by comparing their words. A minimiser found very often is dealt over more
       buckets; the different windows of these buckets meet again, each by its own hash.
    3. Marked windows go back to their documents, whose words are cut. Steps 2 and 3 deal the
       texts by row in the same way, so that they are shuffled once.
    """
    spark = docs.sparkSession
    small_batches(spark)
    row = row_key(id_column, text_column)
    others = [c for c in docs.columns if c.lower() != text_column.lower()]
    source = docs.select(row.alias("row"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("doc"), F.col(text_column).alias("text"))
    id_type = docs.schema[id_column].dataType
    minimisers = source.select("row", "text").mapInArrow(_minimisers(window), "row long, key long, salt long, mark boolean")
    repeated = minimisers.repartition("key", "salt").sortWithinPartitions("key", "salt", F.desc("mark"), "row").mapInArrow(_repeated, "row long, key long, part long, wide boolean")
    keys = materialize(repeated, "minimisers").groupBy("row").agg(F.collect_set(F.struct("key", "part", "wide")).alias("keys"))
    places = [StructField("row", LongType()), StructField("id", id_type), StructField("first", LongType())]
    whole = source.join(keys, "row").select("row", F.col(f"doc.`{id_column}`").alias("id"), "text", "keys")
    packed = whole.mapInArrow(_packed(window), StructType([*places, StructField("key", LongType()), StructField("part", LongType()), StructField("wide", BooleanType()), StructField("packed", BinaryType())]))

    def marked(rows: DataFrame) -> DataFrame:
        dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
        return dealt.select("row", "id", "first", "bucket", "wide", "packed").mapInArrow(_mark(window), StructType([*places, StructField("bits", LongType()), StructField("packed", BinaryType())]))

    bucket = F.when(F.col("wide"), F.xxhash64("key", "part")).otherwise(F.col("key"))
    inner = marked(packed.withColumn("bucket", bucket))
    single = inner.where("packed IS NOT NULL").select("row", "id", "first", F.xxhash64("packed").alias("bucket"), F.lit(False).alias("wide"), "packed")
    spans = inner.where("packed IS NULL").unionByName(marked(single)).groupBy("row").agg(F.collect_set(F.struct("first", "bits", "id")).alias("spans"))
    both = source.join(spans, "row", "left")
    # the row's hash is one of 64 bits: the id tells apart what should share it
    own = F.filter("spans", lambda x: x["id"].eqNullSafe(F.col(f"doc.`{id_column}`")))
    return both.select("doc", "text", own.alias("spans")).mapInArrow(_cut(window, 2), StructType([both.schema["doc"], StructField("text", StringType()), StructField("n_words", LongType()), StructField("n_removed", LongType())]))
