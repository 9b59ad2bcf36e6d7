"""Benchmark decontamination: SimHash over item-sized windows, Hamming blocks, exact check."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.llm.words import NOT_ALNUM, Words, kept, mix, row_chunks, row_key, small_batches, words_of
from finloom.session import materialize

_U = np.uint64
BLOCKS, BLOCK_BITS = 4, 16
#: Windows that are looked up together.
WINDOWS_AT_ONCE = 1024
_AGAIN = _U(0x9E3779B97F4A7C15)


def _bits(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each hash."""
    raw = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return raw.astype(np.int8) * 2 - 1


def _pack(positive: np.ndarray) -> np.ndarray:
    return np.packbits(positive, axis=1).view("<u8").ravel()


def _neighbours(radius: int) -> np.ndarray:
    """Every 16-bit pattern of at most radius bits."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(BLOCK_BITS), r)], np.uint32)


def radius_for(least: float) -> int:
    """Bits that a pair at the threshold, of two bags as heavy, exceeds in less than one case in a thousand."""
    p = math.acos(2 * least / (1 + least)) / math.pi
    share = [math.comb(64, k) * p**k * (1 - p) ** (64 - k) for k in range(65)]
    return next(r for r in range(65) if sum(share[r + 1 :]) < 0.001)


def weights(w: Words, size: int) -> np.ndarray:
    """A shingle weighs the bytes of its words: long words tell more than short ones."""
    n = max(0, len(w.start) - size + 1)
    length = np.concatenate([[0], np.cumsum(w.end - w.start)])
    return length[size : size + n] - length[:n]


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard of two bags of shingles: sum of the smaller weights over the larger."""
    left, right = Counter(), Counter()
    for bag, h, x in ((left, a, wa), (right, b, wb)):
        for k, v in zip(h.tolist(), x.tolist(), strict=True):
            bag[k] += v
    both = sum(min(v, right[k]) for k, v in left.items() if k in right)
    return both / max(1, sum(left.values()) + sum(right.values()) - both)


def _occurrences(grams: np.ndarray) -> np.ndarray:
    """How often each gram stands before its place in the same bag."""
    order = np.argsort(grams, kind="stable")
    first = np.ones(len(grams), bool)
    first[1:] = grams[order][1:] != grams[order][:-1]
    place = np.arange(len(grams))
    out = np.empty(len(grams), np.int64)
    out[order] = place - np.maximum.accumulate(np.where(first, place, 0))
    return out


def _signed(grams: np.ndarray, x: np.ndarray, again: np.ndarray | int = 0) -> np.ndarray:
    """What each gram adds to the 64 sums of a fingerprint: the root of its weight, by its hash's bits.

    With roots the cosine of two bags is their common weight over the root of both weights, so a
    weighted Jaccard of t bounds it by 2t / (1 + t) from below, however uneven the words are. The
    second and later occurrences of a gram are grams of their own, as they are to the Jaccard."""
    return _bits(mix(grams + _AGAIN * np.asarray(again).astype(_U))) * np.rint(np.sqrt(x) * 1024).astype(np.int64)[:, None]


class Items:
    """Benchmark items by word count and shingle size, with an index of their fingerprints.

    A fingerprint has 64 bits in four blocks. Two fingerprints that differ in at most radius bits
    differ in at most radius // 4 bits of some block. Half of these bits are flipped on either side:
    each block's table lists an item under every value that near to its own, and a window looks
    up every value that near to its own.
    """

    def __init__(self, rows: list[tuple], shingle: int, radius: int):
        self.groups: dict[tuple[int, int], dict] = {}
        self.radius, apart = radius, radius // BLOCKS
        self.near, listed = _neighbours(apart - apart // 2), _neighbours(apart // 2)
        self.items: list[tuple] = []
        w = words_of([t.encode() if t is not None else None for _, t in rows], NOT_ALNUM, lower=True)
        hashes, first = w.hashes(), w.first()
        known: dict[int, list] = {}
        marks, group_of = [], []
        for k, (item, _) in enumerate(rows):
            n = int(first[k + 1] - first[k])
            if not n:
                continue
            size = min(shingle, n)
            own = Words(w.buf, w.start[first[k] : first[k + 1]], w.end[first[k] : first[k + 1]], np.zeros(n, int), 1)
            grams, _ = own.grams(size, hashes[first[k] : first[k + 1]])
            x = weights(own, size)
            known.setdefault(size, []).append(grams)
            group = self.groups.setdefault((n, size), {"number": len(self.groups), "lightest": int(x.sum()), "heaviest": 0})
            group["lightest"], group["heaviest"] = min(group["lightest"], int(x.sum())), max(group["heaviest"], int(x.sum()))
            self.items.append((item, grams, x))
            marks.append(_pack(_signed(grams, x, _occurrences(grams)).sum(axis=0, keepdims=True) > 0)[0])
            group_of.append(group["number"])
        self.known = {size: np.unique(np.concatenate(g)) for size, g in known.items()}
        self.marks, self.group_of = np.array(marks, _U), np.array(group_of, np.int64)
        self.tables = []
        for b in range(BLOCKS):
            value = (self._block(self.marks, b)[:, None] ^ listed[None, :].astype(np.int64)).ravel()
            order = np.argsort(value, kind="stable")
            self.tables.append((np.searchsorted(value[order], np.arange(65537)).astype(np.int32), (order // len(listed)).astype(np.int32)))

    @staticmethod
    def _block(marks: np.ndarray, b: int) -> np.ndarray:
        return ((marks >> _U(b * BLOCK_BITS)) & _U(0xFFFF)).astype(np.int64)

    def candidates(self, group: np.ndarray, marks: np.ndarray) -> Iterator[tuple[int, int]]:
        """Pairs (window, item) of one group whose fingerprints differ in at most radius bits."""
        for lo in range(0, len(marks), WINDOWS_AT_ONCE):
            some, pairs = marks[lo : lo + WINDOWS_AT_ONCE], []
            for b, (begin, item) in enumerate(self.tables):
                cells = (self._block(some, b)[:, None] ^ self.near[None, :].astype(np.int64)).ravel()
                n = begin[cells + 1] - begin[cells]
                met = np.flatnonzero(n)
                n, start = n[met], begin[cells[met]]
                at = np.repeat(met // len(self.near), n)
                found = item[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)]
                own = self.group_of[found] == group[lo + at]
                pairs.append(at[own] * len(self.marks) + found[own])
            both = np.unique(np.concatenate(pairs))
            at, item = both // max(1, len(self.marks)), both % max(1, len(self.marks))
            close = np.bitwise_count(some[at] ^ self.marks[item]) <= self.radius
            yield from zip((lo + at[close]).tolist(), item[close].tolist(), strict=True)


def _items(key: str, rows: list[tuple], shingle: int, radius: int) -> Items:
    """The worker's index of a block of items, built once."""
    return kept((Items, key), lambda: Items(rows, shingle, radius))


def _marks(g: np.ndarray, x: np.ndarray, begin: np.ndarray, span: int) -> np.ndarray:
    """Fingerprints of the windows of span grams that begin at `begin`, in order."""
    lo, hi = begin[0], begin[-1] + span
    sums = np.zeros((hi - lo + 1, 64), np.int64)
    np.cumsum(_signed(g[lo:hi], x[lo:hi]), axis=0, out=sums[1:])
    out = _pack(sums[begin - lo + span] - sums[begin - lo] > 0)
    # where each gram stood last; a window that holds it twice is summed on its own
    order = np.argsort(g[lo:hi], kind="stable")
    last = np.full(hi - lo, -1)
    same = g[lo:hi][order][1:] == g[lo:hi][order][:-1]
    last[order[1:][same]] = order[:-1][same]
    if same.any():
        twice = np.concatenate([[0], np.cumsum(last >= 0)])
        for k in np.flatnonzero(twice[begin - lo + span] > twice[begin - lo]).tolist():
            p = begin[k]
            if (last[p - lo : p - lo + span] >= p - lo).any():
                own = g[p : p + span]
                out[k] = _pack(_signed(own, x[p : p + span], _occurrences(own)).sum(axis=0, keepdims=True) > 0)[0]
    return out


def _matches(w: Words, hashes: np.ndarray, items: Items, least: float) -> Iterator[tuple]:
    """(row, item, similarity, first word, words) of the best window of each row and item."""
    best: dict[tuple, tuple] = {}
    windows, marks, numbers = [], [], []
    for size, known in items.known.items():
        grams, whole = w.grams(size, hashes)
        slot = np.searchsorted(known, grams)
        hit = whole & (known[np.minimum(slot, len(known) - 1)] == grams)
        for row in np.unique(w.doc[: len(grams)][hit]):
            lo, hi = np.searchsorted(w.doc, [row, row + 1])
            own = Words(w.buf, w.start[lo:hi], w.end[lo:hi], np.zeros(hi - lo, int), 1)
            g, x, h = grams[lo : hi - size + 1], weights(own, size), hit[lo : hi - size + 1]
            covered = np.concatenate([[0], np.cumsum(np.where(h, x, 0))])
            total = np.concatenate([[0], np.cumsum(x)])
            spots = np.flatnonzero(h)
            for (n, s), group in items.groups.items():
                if s != size:
                    continue
                n = min(n, hi - lo)  # a document shorter than the item is one window
                span = n - size + 1
                begin = np.unique(np.clip(spots[:, None] - np.arange(span)[None, :], 0, hi - lo - n))
                # a window as similar as asked weighs about what the item does, and has that share of
                # both weights in benchmark shingles
                inside, own_weight = covered[begin + span] - covered[begin], total[begin + span] - total[begin]
                fits = inside * (1 + least) >= least * (own_weight + group["lightest"]) - 1e-9
                fits &= (inside >= least * own_weight - 1e-9) & (inside >= least * group["lightest"] - 1e-9) & (least * own_weight <= group["heaviest"] + 1e-9)
                begin = begin[fits]
                if not len(begin):
                    continue
                windows.append((int(row), g, x, begin, span, n))
                marks.append(_marks(g, x, begin, span))
                numbers.append(np.full(len(begin), group["number"]))
    if not windows:
        return
    edge = np.cumsum([0, *map(len, marks)])
    for k, i in items.candidates(np.concatenate(numbers), np.concatenate(marks)):
        at = int(np.searchsorted(edge, k, "right")) - 1
        row, g, x, begin, span, n = windows[at]
        p = begin[k - edge[at]]
        item, ig, ix = items.items[i]
        sim = similarity(g[p : p + span], x[p : p + span], ig, ix)
        if sim >= least - 1e-12:
            best[row, item] = max(best.get((row, item), (0.0, 0, 0)), (sim, -int(p), n))
    for (row, item), (sim, p, n) in best.items():
        yield row, item, sim, -p, n


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, shingle: int = 5, least: float = 0.8, radius: int | None = None,
    items_at_once: int = 5000, bytes_at_once: int = 16 << 20, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document and benchmark item that it holds: the id, item_id, similarity,
    first_word and n_words of the best window (the first of equal ones), and row_key.

    Words are runs of letters, digits and non-ASCII bytes, A-Z lower-cased. For an item of n words
    every window of n words of every document is looked at, or the whole document if it has fewer
    words: its 64-bit SimHash over shingles with the roots of their weights
    must be within radius bits of the item's, and then the exact weighted Jaccard of the
    two bags of shingles at least `least`. Windows without enough weight in any benchmark shingle
    cannot reach it and get no fingerprint. Items with fewer words than a shingle match as a
    whole; items without words, null ids' items included, match nothing without words. The radius,
    unless given, follows from `least` (19 bits for 0.8); by the same model it misses under 0.1 % of the
    pairs right at the threshold and fewer of the more similar ones.

    Benchmark items are sent to the tasks in blocks of about items_at_once items and bytes_at_once,
    one pass over the documents for each block, so what is broadcast is bounded. No shuffle of documents. Null and empty texts
    match nothing; repeated rows match alike; empty tables give no rows; other columns are ignored.
    """
    radius = radius_for(least) if radius is None else radius
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), row_key(id_column, text_column).alias("row_key"))
    ranked = benchmark.select("item_id", "text").where("text IS NOT NULL")
    count, size = ranked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-count // items_at_once), -(-size // bytes_at_once))
    ranked = ranked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))))
    schema = f"`{id_column}` {source.schema[0].dataType.simpleString()}, row_key long, item_id {ranked.schema[0].dataType.simpleString()}, similarity double, first_word long, n_words long"
    found = []
    for block in range(max(1, blocks)):
        rows = [(r["item_id"], r["text"]) for r in ranked.where(F.col("block") == block).collect()]
        shared, key = spark.sparkContext.broadcast(rows), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            items = _items(key, shared.value, shingle, radius)
            for part, texts in row_chunks(batches, "text"):
                w = words_of(texts, NOT_ALNUM, lower=True)
                got = list(_matches(w, w.hashes(), items, least)) if items.known else []
                if got:
                    at = pa.array([r[0] for r in got])
                    item, sim, first, n = list(zip(*got, strict=True))[1:]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(at), part.column(2).take(at), pa.array(item), pa.array(sim), pa.array(first, pa.int64()), pa.array(n, pa.int64())],
                        names=[id_column, "row_key", "item_id", "similarity", "first_word", "n_words"],
                    )

        found.append(source.mapInArrow(run, schema))
    return reduce(DataFrame.unionAll, found)


def remove_leaking(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """docs without the rows that hold a benchmark item; all columns and other rows stay."""
    leaks = find_leaks(docs, benchmark, id_column=id_column, text_column=text_column, **settings)
    keys = materialize(leaks.select(F.col("row_key").alias("_leak_key"), F.col(id_column).alias("_leak_id")).distinct(), "leaks")
    own = row_key(id_column, text_column)
    return docs.join(keys, (own == F.col("_leak_key")) & F.col(id_column).eqNullSafe(F.col("_leak_id")), "left_anti").select(*[f"`{c}`" for c in docs.columns])



