"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions. The decision at a prefix of bits has a context tree of its
own, whose contexts are the last 0 to `depth` bytes. A node with counts a and b has the
Krichevsky-Trofimov probability Pe of all its decisions; Pw = (Pe + product of Pw of its children) / 2,
and Pw = Pe at full depth. The share of Pe in Pw is the weight of the node's own estimate
(bit + 1/2) / (a + b + 1) against the mixture of the next longer context. A context that was never
seen in training has no subtree to weigh: the mixture ends at the longest context seen.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from finloom.llm.words import row_chunks, small_batches
from finloom.session import materialize

DEPTH = 5
#: Grams whose scores are sent to every task, at most so many of the most frequent ones; the others
#: are joined.
FREQUENT_GRAMS = 1 << 21
#: Words whose counts are sent to every task, the most frequent ones; the others are joined.
FREQUENT_WORDS = 200_000
#: Different grams, or four times the words, held by a task before it hands on what it has.
HELD = 1_000_000
#: Grams of a group whose eight decisions are worked out together.
AT_ONCE = 4096
#: Rows of an Arrow batch of grams or words.
HANDED = 100_000
#: Bytes of text handled by one numpy step, unless a single text is longer.
CHUNK = 2 << 20

END = b"\n"

#: A gram of depth + 1 bytes leaves so many bits of a number for a mark of its text.
MARK_BITS = 64 - 8 * (DEPTH + 1)

_U = np.uint64


def split(texts: list[bytes | None]) -> list[list[bytes]]:
    """The words of each text, A-Z lower-cased; a null text has none."""
    return [t.lower().split() if t else [] for t in texts]


def stream(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte to code, the byte with its `depth` predecessors as one number; and for each
    text how many bytes it has to code. A text is its words joined by one space, and an end; what
    comes before it counts as ends."""
    lead = END * DEPTH
    parts = [lead + b" ".join(w) + END for w in words]
    a = np.frombuffer(b"".join(parts), np.uint8)
    n = np.array([len(p) for p in parts], np.int64)
    key = np.zeros(max(0, len(a) - DEPTH), _U)
    for k in range(DEPTH + 1):
        key <<= _U(8)
        key |= a[k : k + len(key)]
    coded = np.ones(len(a), bool)
    coded[((np.cumsum(n) - n)[:, None] + np.arange(DEPTH)[None, :]).ravel()] = False
    return key[coded[DEPTH:]], n - DEPTH


def ordered(words: list[list[bytes]], mark: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different grams of texts in order, where each begins among all of them, the mark of the
    text that each of these is from, and the number of bytes to code of each text. One plain sort of numbers
    that hold gram and mark: no second array of places is kept or sorted."""
    key, n = stream(words)
    key <<= _U(MARK_BITS)
    key |= np.repeat(mark.astype(_U), n)
    key.sort()
    of = key.astype(np.uint16)  # the lowest bits
    key >>= _U(MARK_BITS)
    first = np.concatenate([[True], key[1:] != key[:-1]]).nonzero()[0]
    return key[first], first, of, n


def log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 7
    shift = np.ones_like(x)
    for k in range(7):
        shift *= x + k
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log probability of a sequence with a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - math.log(math.pi)


def _weight(depth: int, kt: np.ndarray, pw: np.ndarray) -> np.ndarray:
    """Share of a node's own estimate against the mixture of the next longer context."""
    return np.exp(math.log(0.5) * (depth < DEPTH) + kt - pw)


def _summed(node: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(node, kind="stable")
    unique, begin = np.unique(node[order], return_index=True)
    return unique, *[np.add.reduceat(c[order], begin) if len(begin) else c[:0] for c in columns]


def _bits(key: np.ndarray, which: Sequence[int] = range(8)) -> tuple[np.ndarray, np.ndarray]:
    """For each of these of the eight decisions of each gram its node of full depth, and the bit taken."""
    symbol, context = key & _U(255), key >> _U(8)
    node = np.array([(context << _U(8)) | (_U(1 << j) | (symbol >> _U(8 - j))) for j in which])
    return node, np.array([(symbol >> _U(7 - j)) & _U(1) for j in which]).astype(bool)


def _mixed(depth: int, asked: np.ndarray, bit: np.ndarray, mixed: np.ndarray, known: tuple[np.ndarray, ...]) -> np.ndarray:
    """Probabilities of the bits taken with the nodes of one more depth; nan: no longer context seen."""
    node, a, b, w = known
    if not len(node):
        return mixed
    asked = asked & _U((1 << (8 * depth + 8)) - 1)
    at = np.minimum(np.searchsorted(node, asked), len(node) - 1)
    own = (np.where(bit, b[at], a[at]) + 0.5) / (a[at] + b[at] + 1)
    with np.errstate(invalid="ignore"):
        both = np.where(np.isnan(mixed), own, w[at] * own + (1 - w[at]) * mixed)
    return np.where(node[at] == asked, both, mixed)


def subtree(key: np.ndarray, n: np.ndarray, least_depth: int) -> tuple[np.ndarray, tuple]:
    """Probabilities of the eight bits of each gram under the contexts from full depth to
    least_depth, and nodes, counts and log Pw of the nodes of least_depth. Grams with n = 0 are
    scored but not learned. No two decisions share a node, so those of many grams are taken one by one."""
    each = [range(8)] if len(key) <= AT_ONCE else [[j] for j in range(8)]
    mixed, top = zip(*(_subtree(key, n, which, least_depth) for which in each), strict=True)
    return np.concatenate(mixed), tuple(np.concatenate(c) for c in zip(*top, strict=True))


def _subtree(key: np.ndarray, n: np.ndarray, which: Sequence[int], least_depth: int) -> tuple[np.ndarray, tuple]:
    asked, bit = _bits(key, which)
    learned = n > 0
    node, one = asked[:, learned].ravel(), bit[:, learned].ravel().astype(float)
    many = np.tile(n[learned].astype(float), len(which))
    node, a, b = _summed(node, many * (1 - one), many * one)
    pw = kt = log_kt(a, b)
    mixed = _mixed(DEPTH, asked, bit, np.full(asked.shape, np.nan), (node, a, b, _weight(DEPTH, kt, pw)))
    for depth in range(DEPTH - 1, least_depth - 1, -1):
        node, a, b, below = _summed(node & _U((1 << (8 * depth + 8)) - 1), a, b, pw)
        kt = log_kt(a, b)
        pw = math.log(0.5) + np.logaddexp(kt, below)
        mixed = _mixed(depth, asked, bit, mixed, (node, a, b, _weight(depth, kt, pw)))
    return mixed, (node, a, b, pw)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of batches with the words of their texts, of no more rows than there are marks."""
    for rows, texts in row_chunks((b.slice(k, 1 << MARK_BITS) for b in batches for k in range(0, b.num_rows, 1 << MARK_BITS)), "text", CHUNK):
        yield rows, split(texts)


def _handed(names: list[str], *columns: pa.Array) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(columns[0]), HANDED):
        yield pa.record_batch([c.slice(k, HANDED) for c in columns], names=names)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams with how often they are in all rows, and in the rows to learn from."""

    def given() -> Iterator[pa.RecordBatch]:
        return _handed(["gram", "n", "learned"], pa.array(key.view(np.int64)), pa.array(n), pa.array(learned))

    key, n, learned = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for rows, words in _chunks(batches):
        got, first, own, _ = ordered(words, rows.column("learn").to_numpy(zero_copy_only=False))
        many, of_learn = np.diff(first, append=len(own)), np.add.reduceat(own, first, dtype=np.int64)
        at = np.searchsorted(key, got)
        new = at == len(key)
        new[~new] = key[at[~new]] != got[~new]
        n[at[~new]] += many[~new]
        learned[at[~new]] += of_learn[~new]
        key, n, learned = (np.insert(held, at[new], more[new]) for held, more in ((key, got), (n, many), (learned, of_learn)))
        if len(key) > HELD:
            yield from given()
            key, n, learned = key[:0], n[:0], learned[:0]
    yield from given()


def _nodes(table: pa.Table) -> pa.Table:
    key = table["gram"].to_numpy().view(_U)
    mixed, (node, a, b, pw) = subtree(key, table["learned"].to_numpy(), 2)
    up, a, b, pw = _summed(node & _U(0xFFFF), a, b, pw)
    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, mixed.size + 1, 8), pa.int32()), pa.array(mixed.T.ravel()))
    rows = pa.table([table["gram"], table["n"], flat, pa.nulls(len(key), pa.int64()), *[pa.nulls(len(key), pa.float64())] * 3], names=_NODE_NAMES)
    none = [pa.nulls(len(up), pa.int64()), pa.nulls(len(up), pa.int64()), pa.nulls(len(up), pa.list_(pa.float64()))]
    top = pa.table([*none, pa.array(up.astype(np.int64)), pa.array(a), pa.array(b), pa.array(pw)], names=_NODE_NAMES)
    return pa.concat_tables([rows, top])


_NODE_NAMES = ["gram", "n", "mixed", "node", "a", "b", "pw"]


def gram_scores(texts: DataFrame) -> DataFrame:
    """For each gram of texts (text, and learn: true or false) how often it is in them, n, and
    log10 of the probability of its last byte after the others, log10p, from the context trees of
    the rows to learn from. Null counts as an empty text.

    Grams of depth + 1 bytes are counted in the tasks, added up by a shuffle, and dealt by their two
    latest context bytes: each group holds whole subtrees and all grams that ask for them. What is
    above two bytes is at most 65,280 nodes and is finished on the driver. Every node is kept."""
    counts = texts.mapInArrow(_grams, "gram long, n long, learned long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("learned").alias("learned"))
    dealt = counts.groupBy(F.shiftright("gram", 8).bitwiseAND(0xFFFF)).applyInArrow(_nodes, "gram long, n long, mixed array<double>, node long, a double, b double, pw double")
    nodes = materialize(dealt, "nodes")
    top = nodes.where("node IS NOT NULL").groupBy("node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("pw").alias("pw")).collect()
    node = np.array([r["node"] for r in top], _U)
    a, b, below = (np.array([r[c] for r in top], float) for c in ("a", "b", "pw"))
    known = []
    for depth in (1, 0):
        node, a, b, below = _summed(node & _U((1 << (8 * depth + 8)) - 1), a, b, below)
        kt = log_kt(a, b)
        pw = math.log(0.5) + np.logaddexp(kt, below)
        known.append((depth, (node, a, b, _weight(depth, kt, pw))))
        below = pw
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked, bit = _bits(batch.column(0).to_numpy().view(_U))
            mixed = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, 8).T
            for depth, table in shared.value:
                mixed = _mixed(depth, asked, bit, mixed, table)
            log = np.log10(np.where(np.isnan(mixed), 0.5, mixed)).sum(axis=0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(log)], names=["gram", "n", "log10p"])

    scores = nodes.where("node IS NULL").select("gram", "n", "mixed").mapInArrow(finish, "gram long, n long, log10p double")
    return materialize(scores, "gram-scores")


def _frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """The rows whose n is over a bound that `most` rows or fewer exceed. Rows as frequent are all
    in it or all out, so no order of rows matters."""
    rank = F.floor(F.log2(n) * 16)
    least, total = None, 0
    for r in counts.groupBy(rank.alias("rank")).count().orderBy(F.desc("rank")).collect():
        total += r["count"]
        if total > most:
            break
        least = r["rank"]
    return counts.where(F.lit(False) if least is None else rank >= least)


def _head(scores: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent grams and their scores, in order."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([batch.column(k).to_numpy().tobytes()], pa.binary()) for k in (0, 1)], names=["grams", "logs"])

    rows = list(_frequent(scores, "n", FREQUENT_GRAMS).select("gram", "log10p").mapInArrow(packed, "grams binary, logs binary").toLocalIterator())
    grams = np.concatenate([np.zeros(0, _U), *[np.frombuffer(r["grams"], _U) for r in rows]])
    order = np.argsort(grams)
    return grams[order], np.concatenate([np.zeros(0), *[np.frombuffer(r["logs"], float) for r in rows]])[order]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def given() -> Iterator[pa.RecordBatch]:
        words, n = pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())
        held.clear()
        return _handed(["word", "n"], words.cast(pa.string()), n)

    for _, words in _chunks(batches):
        for w in words:
            held.update(w)
        held[b""] += len(words)  # the end of each text
        if len(held) > HELD // 4:
            yield from given()
    yield from given()


def score(docs: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of docs: the id, n_tokens, n_known, train_tokens, base_score, score (log10
    probability of the text under the context trees) and bits_per_byte.

    The trees and the word counts are learned from all rows where learn is true (null: not). A
    text is its words (runs of anything but ASCII white space, A-Z lower-cased) joined by one space,
    and an end; a null text is an empty one. base_score is the sum over words and end of
    log10((c + 1) / (N + V + 1)) from the training counts. Repeated rows and null ids are scored like
    any other; other columns are ignored; without training rows every bit costs one bit. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark, 4 << 20)
    texts = docs.where(learn).select(F.col(text_column).alias("text"))
    words = materialize(texts.mapInArrow(_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = _frequent(words, "c", FREQUENT_WORDS).select(F.col("word").cast("binary"), "c").toArrow()
    known = spark.sparkContext.broadcast({w: math.log10(c + 1) for w, c in zip(top["word"].to_pylist(), top["c"].to_pylist(), strict=True)})
    # a word that is not among the frequent ones and cannot be below them was never seen
    complete = total["v"] <= FREQUENT_WORDS
    scores = gram_scores(docs.select(F.col(text_column).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn")))
    head = spark.sparkContext.broadcast(_head(scores))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, (grams, gram_logs) = known.value, head.value
        for rows, words in _chunks(batches):
            unique, first, of, n_bytes = ordered(words, np.arange(len(words)))
            at = np.minimum(np.searchsorted(grams, unique), max(0, len(grams) - 1))
            hit = grams[at] == unique if len(grams) else np.zeros(len(unique), bool)
            one = np.zeros(len(unique))
            one[hit] = gram_logs[at[hit]]
            many = np.diff(first, append=len(of))
            sums = np.bincount(of, np.repeat(one, many), len(words))
            missing, often = unique[~hit], many[~hit]
            missed = of[np.repeat(first[~hit] - np.cumsum(often) + often, often) + np.arange(often.sum())]
            order = np.argsort(missed, kind="stable")
            offsets = np.concatenate([[0], np.cumsum(np.bincount(missed, minlength=len(words)))])
            others = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.repeat(missing, often)[order].view(np.int64)))
            out = []
            for of_text in words:
                of_text.append(b"")
                got = list(map(logs.get, of_text))
                unknown = got.count(None)
                rest = Counter(compress(of_text, map(not_, got))) if unknown and not complete else {}
                out.append((len(of_text), len(got) - unknown, math.fsum(filter(None, got)), [w.decode() for w in rest], list(rest.values())))
            n, seen, base, rare, times = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n, pa.int64()), pa.array(seen, pa.int64()), pa.array(base, pa.float64()), pa.array(rare, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32())), others, pa.array(sums), pa.array(n_bytes)],
                names=[rows.schema.names[0], "n_tokens", "seen", "base", "rare", "times", "grams", "score", "n_bytes"],
            )

    source = docs.select(id_column, F.col(text_column).alias("text"))
    kinds = {"n_tokens": LongType(), "seen": LongType(), "base": DoubleType(), "rare": ArrayType(StringType()), "times": ArrayType(IntegerType()), "grams": ArrayType(LongType()), "score": DoubleType(), "n_bytes": LongType()}
    scored = source.mapInArrow(run, StructType([source.schema[0], *[StructField(k, v) for k, v in kinds.items()]]))
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    more = rare.join(words, "word").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more"), F.sum("times").alias("also"))
    # grams that are not in the head are all rare, so no key of this join is a hot one
    rest = scored.select("row", F.explode("grams").alias("gram")).join(scores.select("gram", "log10p"), "gram").groupBy("row").agg(F.sum("log10p").alias("rest"))
    fixed = math.log10(total["n"] + total["v"] + 1)
    return scored.drop("rare", "times", "grams").join(more, "row", "left").join(rest, "row", "left").withColumn("score", F.col("score") + F.coalesce("rest", F.lit(0.0))).select(
        id_column,
        "n_tokens",
        (F.col("seen") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(total["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(fixed)).alias("base_score"),
        "score",
        (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"),
    )
