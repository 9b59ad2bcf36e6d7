"""Ranked lexical search: an Aho-Corasick automaton of all item terms scans the documents."""

from __future__ import annotations

import heapq
import math
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from finloom.llm.words import row_chunks, small_batches
from finloom.session import materialize

#: A-Z are lower-cased, 0-9, a-z and bytes of other letters stay, the rest separates.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Bytes of item texts in one automaton; more items are searched in further rounds.
BLOCK_BYTES = 4 << 20

#: Parts in which the best rows of one item are merged before they meet.
MERGE_PARTS = 64


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TERM_BYTES).split()


@dataclass
class Block:
    """Some items' terms: each distinct term once, with the items that hold it and how often."""

    terms: list[bytes]
    item: np.ndarray
    repeats: np.ndarray
    first: np.ndarray
    items: int

    @classmethod
    def of(cls, texts: Sequence[bytes | None]) -> Block:
        held: dict[bytes, list[tuple[int, int]]] = {}
        for k, text in enumerate(texts):
            for term, n in Counter(terms_of(text)).items():
                held.setdefault(term, []).append((k, n))
        flat = [x for pairs in held.values() for x in pairs]
        item, repeats = (np.array([x[k] for x in flat], np.int64) for k in (0, 1))
        return cls(list(held), item, repeats, np.cumsum([0, *map(len, held.values())]), len(texts))

    def automaton(self):
        """Finds each term between two separators; bytes stand as the first 256 characters."""
        import ahocorasick

        found = ahocorasick.Automaton()
        for k, term in enumerate(self.terms):
            found.add_word(f" {term.decode('latin-1')} ", k)
        found.make_automaton()
        return found


_automata: dict[object, object] = {}


def _counts(block_id, block: Block, texts: list[bytes | None]) -> Iterator[tuple[int, dict[int, int]]]:
    """For each text its number of terms, and how often each term of the block occurs."""
    if block_id not in _automata:
        _automata.clear()
        _automata[block_id] = block.automaton() if block.terms else None
    automaton = _automata[block_id]
    for text in texts:
        plain = (text or b"").translate(TERM_BYTES)
        bare = np.frombuffer(plain, np.uint8) == 32
        n = int((~bare[1:] & bare[:-1]).sum() + (not bare[0])) if len(bare) else 0
        hits = Counter(map(itemgetter(1), automaton.iter(f" {plain.decode('latin-1')} "))) if n and automaton else {}
        yield n, hits


def item_blocks(items: DataFrame, id_column: str, text_column: str, limit: int) -> Iterator[tuple[list, list[bytes | None]]]:
    """Ids and texts of the items in blocks of about limit bytes, one block at a time on the driver."""
    ids, texts, held = [], [], 0
    for row in items.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text")).toLocalIterator():
        if ids and held + len(row["text"] or b"") > limit:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(row["id"])
        texts.append(bytes(row["text"]) if row["text"] is not None else None)
        held += 200 + len(row["text"] or b"")
    if ids:
        yield ids, texts


def _statistics(docs: DataFrame, shared) -> dict[int, int]:
    """Documents that hold each term of the block; under -1 and -2 the documents with a term and all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs_with, terms = Counter(), 0, 0
        for _, texts in row_chunks(batches, "text"):
            for n, hits in _counts(shared.value[0], shared.value[1], texts):
                held.update(hits.keys())
                docs_with, terms = docs_with + (n > 0), terms + n
        held.update({-1: docs_with, -2: terms})
        yield pa.record_batch([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())], names=["term", "n"])

    return {r["term"]: r["n"] for r in docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Best:
    """The k highest-scoring ids of each item, equal scores by the smaller id, none last."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)

    def add(self, doc: int | None, scores: np.ndarray) -> None:
        for i in np.flatnonzero(scores >= self.least).tolist():
            heap, entry = self.heaps[i], (int(scores[i]), doc is not None, -doc if doc is not None else 0)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[i] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for i, heap in enumerate(self.heaps):
            for score, known, doc in heap:
                yield i, -doc if known else None, score


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item, rank, doc, score): for each item the k highest-scoring documents with a score above 0.

    Terms are the runs of letters, digits and non-ASCII characters, A-Z lower-cased. With N
    documents that have a term, L terms in all, n in a document, df documents with a term and tf of
    it in the document: w = floor(1000 ln((2N+2)/(2df+1))), m = 25 + 75nN div L, and the score sums
    w * (10^9 tf div (1000 tf + 8m)) over the item's terms, repeats included.

    No index of the documents is made. The automaton of a block of items is sent to every task, which
    scans whole texts twice: once for df, N and L, once for the scores, of which a task keeps the k
    best for each item. Items beyond block_bytes of text take further rounds, so what is sent stays
    bounded. Equal scores are ranked by id, rows without id last. Each row of docs is a document
    and each row of items an item, repeated rows too. A null or empty text has no term: such documents
    are never found, such items find nothing. Empty tables give no row. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))
    kind = items.schema[item_column].dataType
    out = None
    for ids, texts in item_blocks(items, item_column, item_text, block_bytes):
        block = Block.of(texts)
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, block))
        held = _statistics(own, shared)
        documents, all_terms = held.get(-1, 0), held.get(-2, 0)
        weights = np.array([term_weight(documents, held.get(t, 0)) for t in range(len(block.terms))], np.int64)
        if not documents:
            break
        best = _best(own, shared, weights, documents, all_terms, k)
        names = spark.createDataFrame(list(enumerate(ids)), StructType([StructField("at", IntegerType()), StructField("item", kind)]))
        named = materialize(_merged(best, k).join(F.broadcast(names), "at").select("item", "rank", "doc", "score"), "ranked")
        shared.unpersist()
        out = named if out is None else out.unionByName(named)
    if out is None:
        return spark.createDataFrame([], StructType([StructField("item", kind), StructField("rank", IntegerType()), StructField("doc", LongType()), StructField("score", LongType())]))
    return out


def _best(docs: DataFrame, shared, weights: np.ndarray, documents: int, all_terms: int, k: int) -> DataFrame:
    """(at, doc, score): each task's k best documents for every item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block_id, block = shared.value
        best = Best(block.items, k)
        for rows, texts in row_chunks(batches, "text"):
            for doc, (n, hits) in zip(rows.column(0).to_pylist(), _counts(block_id, block, texts), strict=True):
                if not hits:
                    continue
                m = 25 + 75 * n * documents // all_terms
                term = np.fromiter(hits.keys(), np.int64, len(hits))
                tf = np.fromiter(hits.values(), np.int64, len(hits))
                value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                lo, size = block.first[term], block.first[term + 1] - block.first[term]
                place = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
                scores = np.zeros(block.items, np.int64)
                np.add.at(scores, block.item[place], np.repeat(value, size) * block.repeats[place])
                best.add(doc, scores)
        found = list(best.rows())
        columns = [pa.array([r[c] for r in found], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "doc", "score"])

    return docs.mapInArrow(run, "at int, doc long, score long")


def _merged(best: DataFrame, k: int) -> DataFrame:
    """The k best of each item, first in parts, so that the rows of an item never meet as a whole."""
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    some = best.withColumn("part", F.pmod(F.xxhash64("doc", "score"), F.lit(MERGE_PARTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("at", "part").orderBy(*order))).where(F.col("rank") <= k).drop("part", "rank")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("at").orderBy(*order))).where(F.col("rank") <= k)


SEARCH_SQL = """
WITH t AS (
    SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(
        translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents
), n AS (SELECT row, any_value(doc_id) AS doc_id, count(*) AS n FROM t GROUP BY row),
a AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
f AS (SELECT row, term, count(*) AS tf FROM t GROUP BY row, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, a GROUP BY term, docs),
i AS (
    SELECT item, item_id, term, count(*) AS repeats FROM (
        SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
            translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark)
    GROUP BY ALL
), s AS (
    SELECT item, item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS score
    FROM i JOIN w USING (term) JOIN f USING (term) JOIN n USING (row), a GROUP BY item, item_id, row, doc_id
), r AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 10
"""
