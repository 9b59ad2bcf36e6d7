"""Toxicity scores behind disguises: noisy-channel decoding of words, then a lexicon model."""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from finloom.llm.words import LOWER, drop_kept, kept, mix, row_chunks, small_batches, without, words_of
from finloom.session import materialize

_U = np.uint64

#: Rows of labels that the model is fitted on, at most about so many, chosen by hash of the id.
TRAIN_ROWS = 200_000
#: Bytes of an Arrow batch: the JVM holds a batch twice while it grows, and a worker makes its texts bytes of their own.
BATCH_BYTES = 4 << 20
#: Rows of a label, copies counted once, that a word must be in to weigh anything.
LEAST_ROWS = 5

#: Symbols of the character model: a-z, any other letter, and the gap between words.
GAP, OTHER, SYMBOLS = 0, 27, 28

#: Letters that a digit or sign may stand for.
STANDS_FOR = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "|": "il", "(": "c"}

#: Costs of the channel, in nats.
SWAP_COST, DROP_COST, MERGE_COST, KEEP_COST = 1.0, 0.7, 0.4, 6.0

_SYMBOL = np.full(256, GAP, np.uint8)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = OTHER

_EDGES = re.compile(r"^[\"'`(\[{<*_~#.,;:]+|[\"'`)\]}>*_~#.,;:!?%&^=/\\-]+$|(?:([^\w\s])\1+)$")
_LEADING, _TRAILING = "\"'`([{<*_~#.,;:", "\"'`)]}>*_~#.,;:!?%&^=/\\-"
_RUN = re.compile(r"(.)\1\1|([a-z])\2")
_OTHERS = re.compile(r"([^\W\d_a-z])\1*")
_SPACED = re.compile(r"(?<![^\W_])(?:[a-z0-9@$!+|][ ._*-]++){2,}[a-z0-9@$!+|](?![^\W_])")


def symbols(text: bytes) -> np.ndarray:
    return _SYMBOL[LOWER[np.frombuffer(text, np.uint8)]]


def train_characters(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Log probabilities of a symbol after three others, of shape (28, 28, 28, 28), from all rows.

    Counts of four symbols are added up in each task in a table of fixed size; shorter histories
    back off by interpolation with the number of different successors."""
    small_batches(docs.sparkSession, BATCH_BYTES)
    size = SYMBOLS**4
    slices = -(-size // (1 << 12))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        total = np.zeros(slices << 12, np.int64)
        for _, texts in row_chunks(batches, "text"):
            s = symbols(b"   " + b"   ".join(t or b"" for t in texts)).astype(np.int32)
            if len(s) > 3:
                code = ((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:]
                total[:size] += np.bincount(code, minlength=size)
        yield _sliced(total, 1 << 12)

    total = _gathered(docs.select(F.col(text_column).alias("text")).mapInArrow(count, "part int, counts binary"), slices << 12)[:size]
    counts = total.reshape((SYMBOLS,) * 4).astype(float)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(4):
        c = counts.sum(axis=tuple(range(3 - order)))
        n, kinds = c.sum(axis=-1, keepdims=True), (c > 0).sum(axis=-1, keepdims=True)
        p = (c + np.maximum(kinds, 1) * np.broadcast_to(p, c.shape)) / (n + np.maximum(kinds, 1))
    return np.log(p).astype(np.float32)


def _sliced(total: np.ndarray, width: int) -> pa.RecordBatch:
    parts = total.reshape(-1, width)
    used = np.flatnonzero(parts.any(axis=1))
    return pa.record_batch([pa.array(used, pa.int32()), pa.array([parts[k].astype("<i8").tobytes() for k in used], pa.binary())], names=["part", "counts"])


def _gathered(parts: DataFrame, size: int) -> np.ndarray:
    """Sums of the tables of all tasks, added up slice by slice; the result has a fixed size."""

    def add(table: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(b, "<i8") for b in table["counts"].to_pylist())
        return pa.table({"part": table["part"][:1], "counts": pa.array([sums.tobytes()], pa.binary())})

    out = None
    for r in parts.groupBy("part").applyInArrow(add, "part int, counts binary").collect():
        piece = np.frombuffer(bytes(r["counts"]), "<i8")
        out = np.zeros(size, np.int64) if out is None else out
        out[r["part"] * len(piece) : (r["part"] + 1) * len(piece)] = piece
    return np.zeros(size, np.int64) if out is None else out


class Decoder:
    """Most likely plain reading of a disguised text, by Viterbi search over its lattice.

    At each place a letter reads as itself; a digit or sign as a letter it stands for, as a gap, or
    as nothing; a separator as a gap or nothing; and a run of equal letters as one, two, or all of
    them. Each arc costs what the channel takes for it, each symbol what the character model takes.
    Paths that end in the same three symbols are one state, so the search is linear in the length.
    """

    def __init__(self, model: np.ndarray):
        self.cost = (-model).tolist()

    def arcs(self, text: str) -> list[tuple[int, int, list[tuple[float, tuple[int, ...]]]]]:
        out, k = [], 0
        while k < len(text):
            c, end = text[k], k + 1
            while end < len(text) and text[end] == c:
                end += 1
            n = end - k
            if "a" <= c <= "z":
                s = ord(c) - 96
                ways = [(0.0 if n <= 2 else KEEP_COST, (s,) * min(n, 3))]
                ways += [(MERGE_COST if n > 2 else 3.0, (s,))] * (n > 1) + [(MERGE_COST, (s, s))] * (n > 2)
            elif c.isalpha():
                ways = [(0.0, (OTHER,))]
            else:
                ways = [(0.0 if c not in STANDS_FOR else KEEP_COST, (GAP,)), (DROP_COST, ())]
                ways += [(SWAP_COST, (ord(x) - 96,)) for x in STANDS_FOR.get(c, "")]
                ways += [(SWAP_COST, (ord(x) - 96,) * 2) for x in STANDS_FOR.get(c, "") if n == 2]
            out.append((k, end, ways))
            k = end
        return out

    def one_double(self, word: str, at: int) -> str:
        """What read gives for letters a-z with one doubled letter, at `at`: it alone is undecided."""
        symbols = [GAP] * 3 + [ord(c) - 96 for c in word] + [GAP]
        short = symbols[: at + 4] + symbols[at + 5 :]

        def price(s: list[int], end: int) -> float:
            return sum(self.cost[s[k - 3]][s[k - 2]][s[k - 1]][s[k]] for k in range(at + 4, min(end, len(s))))

        return word if price(symbols, at + 8) <= price(short, at + 7) + 3.0 else word[:at] + word[at + 1 :]

    def read(self, text: str) -> str:
        """Words of a-z and ?, for other letters, separated by single gaps."""
        states: dict[tuple[int, int, int], tuple[float, tuple]] = {(GAP, GAP, GAP): (0.0, ())}
        for _, _, ways in self.arcs(text):
            following: dict[tuple[int, int, int], tuple[float, tuple]] = {}
            for (a, b, c), (total, path) in states.items():
                for price, read in ways:
                    x, y, z, t, p = a, b, c, total + price, path
                    for s in read:
                        if s == GAP and z == GAP:
                            continue
                        t += self.cost[x][y][z][s]
                        x, y, z, p = y, z, s, (p, s)
                    if (x, y, z) not in following or t < following[x, y, z][0]:
                        following[x, y, z] = (t, p)
            states = following
        best = min((t + self.cost[a][b][c][GAP], p) for (a, b, c), (t, p) in states.items()) if states else (0.0, ())
        letters, p = [], best[1]
        while p:
            p, s = p
            letters.append(" " if s == GAP else "?" if s == OTHER else chr(s + 96))
        return "".join(reversed(letters)).strip()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, label) with the smallest of four hashes over runs of three words of the text."""
    drop_kept()
    for rows, texts in row_chunks(batches, "text"):
        w = words_of(texts, lower=True)
        g, whole = w.grams(3)
        out = []
        for salt in (0, 0x51ED, 0x2F3B, 0x70C9):
            h = np.where(whole, mix(g ^ _U(salt)), _U(2**64 - 1))
            smallest = mix(np.array([zlib.crc32(t or b"") for t in texts], _U))  # of texts with fewer words
            if len(h):
                np.minimum.at(low := np.full(len(texts), _U(2**64 - 1)), w.doc[: len(h)], h)
                smallest = np.where(low < _U(2**64 - 1), low, smallest)
            out.append(pa.array(smallest.view(np.int64)))
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *out], names=["id", "label", "s", "t", "u", "v"])


def feature(word: str) -> int:
    """63 bits that stand for a word, so that no clean word shares the weight of another."""
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest()) >> 1


class Reader:
    """Features of texts; words seen before are kept in a table of bounded size.

    With weights given, only features that weigh something are kept and returned."""

    def __init__(self, model: np.ndarray, weights: dict[int, float] | None = None, most: int = 600_000):
        self.decoder, self.weights, self.most = Decoder(model), weights, most
        self.known: dict[str, tuple[int, ...]] = {}

    def words(self, token: str) -> list[str]:
        """The plain words behind a token: itself when it is made of letters only, none of them doubled."""
        core = token.lstrip(_LEADING).rstrip(_TRAILING)
        if core.isalpha():
            runs = [m.span() for m in _RUN.finditer(core)]
            if not runs:
                return [core]
            if len(runs) == 1 and runs[0][1] - runs[0][0] == 2 and core.isascii():
                return [self.decoder.one_double(core, runs[0][0])]
        core = _EDGES.sub("", token)
        if core.isalpha() and not _RUN.search(core):
            return [core]
        core = _EDGES.sub("", core)
        if not any(map(str.isalpha, core)):
            return []
        if core.isalpha() and not _RUN.search(core):
            return [core]
        return self.read(core).split()

    def read(self, text: str) -> str:
        """The decoder's reading, with the letters other than a-z that it leaves open filled in."""
        others = (m[1] for m in _OTHERS.finditer(text) if m[1].isalpha())
        return "".join(next(others, c) if c == "?" else c for c in self.decoder.read(text))

    def _numbers(self, words: list[str]) -> tuple[int, ...]:
        found = map(feature, words)
        return tuple(found) if self.weights is None else tuple(f for f in found if f in self.weights)

    def features(self, text: str) -> set[int]:
        text = text.lower()
        found: set[int] = set()
        known = self.known
        for token in set(text.split()):
            got = known.get(token)
            if got is None:
                if len(known) >= self.most:
                    known.clear()
                got = self._numbers(self.words(token))
                if len(token) <= 200:
                    known[token] = got
            if got:
                found.update(got)
        for m in _SPACED.finditer(text):
            found.update(self._numbers(self.decoder.read(m[0]).split()))
        return found


def reader(key: str, model: np.ndarray, weights: dict[int, float] | None = None) -> Reader:
    """The worker's reader for a model; tasks that follow in the same worker find its words."""
    return kept((Reader, key), lambda: Reader(model, weights))


@dataclass
class Model:
    """Character model, weights of the features, and the line from their sum to log odds."""

    characters: np.ndarray
    weights: dict[int, float]
    slope: float
    base: float


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """The model from docs (all texts, for the character model) and labels of some of their ids.

    Labels are 0 or 1; null labels and ids are left out; an id labelled twice counts as its largest
    label. At most about `rows` labelled ids are used, chosen by hash; of texts with the same label
    that share the smallest of four hashes over runs of three words all alike, one: copies say nothing new. A word's weight is its
    log ratio of document shares, kept where the ratio is at least e, the likelihood ratio
    statistic at least 20, and the word in LEAST_ROWS rows of one label, so that the words of a few
    copied texts do not count; other words weigh nothing. Without labels of both kinds all
    weights are 0 and the score is the share of label 1."""
    spark = docs.sparkSession
    small_batches(spark, BATCH_BYTES)
    characters = train_characters(docs, text_column)
    known = labels.where(f"`{id_column}` IS NOT NULL AND `{label_column}` IS NOT NULL").groupBy(F.col(id_column).alias("id")).agg(F.max(F.col(label_column).cast("int")).alias("label"))
    share = min(1.0, rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows_of = docs.where(f"`{text_column}` IS NOT NULL").select(F.col(id_column).alias("doc"), F.col(text_column).alias("text"))
    minima = [StructField(c, LongType()) for c in "stuv"]
    signed = rows_of.join(F.broadcast(chosen), F.col("doc") == F.col("id")).select("id", "label", "text").mapInArrow(_signed, StructType([chosen.schema["id"], StructField("label", IntegerType()), *minima]))
    single = materialize(signed.groupBy("label", *"stuv").agg(F.min("id").alias("id")).select("id", "label"), "single")
    texts = rows_of.join(F.broadcast(single), F.col("doc") == F.col("id")).select("text", "label")
    shared, key = spark.sparkContext.broadcast(characters), uuid.uuid4().hex

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = reader(key, shared.value)
        for part, found in row_chunks(batches, "text"):
            words = [sorted(own.features(t.decode("utf-8", "replace"))) for t in found]
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(words, pa.list_(pa.int64()))], names=["label", "words"])

    rows_read = materialize(texts.mapInArrow(read, "label int, words array<long>"), "label-words")
    n1, n0 = (float(x or 0) for x in rows_read.agg(F.sum(F.when(F.col("label") == 1, 1).otherwise(0)), F.sum(F.when(F.col("label") == 1, 0).otherwise(1))).first())
    one = F.col("label") == 1
    words = rows_read.select(F.explode("words").alias("word"), "label").groupBy("word").agg(F.sum(F.when(one, 0.0).otherwise(1.0)).alias("b"), F.sum(F.when(one, 1.0).otherwise(0.0)).alias("a"))
    weights: dict[int, float] = {}
    if n0 and n1:
        a, b = F.col("a"), F.col("b")
        expected = (a + b) * (n1 / (n0 + n1))
        ratio = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))
        surprise = 2 * (F.when(a > 0, a * F.log(a / expected)).otherwise(0) + F.when(b > 0, b * F.log(b / (a + b - expected))).otherwise(0))
        kept = words.where((F.greatest(a, b) >= LEAST_ROWS) & (F.abs(ratio) >= 1) & (surprise >= 20))
        weights = {r["word"]: r["ratio"] for r in kept.select("word", ratio.alias("ratio")).collect()}
    model = Model(characters, weights, 0.0, math.log((n1 + 0.5) / (n0 + 0.5)))
    if weights:
        small = spark.sparkContext.broadcast(weights)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                sums = [round(sum(small.value.get(w, 0.0) for w in ws), 1) for ws in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sums, pa.float64())], names=["label", "s"])

        sums = rows_read.mapInArrow(add, "label int, s double").groupBy("s").agg(F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("ones"), F.count("*").alias("n")).collect()
        model.slope, model.base = _line([(r["s"], r["ones"], r["n"]) for r in sums])
    return model


def _line(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and base of a logistic curve through binned shares, with a weak pull to slope 1."""
    s, ones, n = (np.array(x, float) for x in zip(*bins, strict=True))
    slope, base = 1.0, math.log((ones.sum() + 0.5) / (n.sum() - ones.sum() + 0.5))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * s + base, -30, 30)))
        w = n * p * (1 - p)
        grad = np.array([((ones - n * p) * s).sum() - (slope - 1.0), (ones - n * p).sum() - 0.01 * base])
        hess = np.array([[(w * s * s).sum() + 1.0, (w * s).sum()], [(w * s).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(hess, grad)
        slope, base = slope + step[0] * min(1, 2 / max(1e-9, np.abs(step).max())), base + step[1] * min(1, 2 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(base)


def score(docs: DataFrame, model: Model, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with toxic_sum and toxic_score (0 to 1), from the whole text alone.

    keep names the columns of docs that come with them, all if it is not given: a text that is not
    wanted after it need not go back from the tasks' Python.

    Words are read through the decoder where they hold digits, signs, doubled letters or long runs,
    and rows of three or more single letters are read as one text. A null or empty text has the sum 0. Rows are
    scored alone; input columns of these two names are replaced."""
    spark = docs.sparkSession
    small_batches(spark, BATCH_BYTES)
    docs = without(docs, "toxic_sum", "toxic_score")
    at = [k for k, c in enumerate(docs.columns) if keep is None or c in keep]
    names = [docs.columns[k] for k in at]
    shared, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        weight = own.weights
        words = reader(key, own.characters, weight)
        for part, texts in row_chunks(batches, text_column):
            sums = np.zeros(len(texts))
            for k, t in enumerate(texts):
                if t:
                    sums[k] = sum(weight[h] for h in sorted(words.features(t.decode("utf-8", "replace"))))
            odds = np.clip(own.slope * sums + own.base, -500, 500)
            yield pa.RecordBatch.from_arrays([*[part.column(k) for k in at], pa.array(sums), pa.array(1 / (1 + np.exp(-odds)))], names=[*names, "toxic_sum", "toxic_score"])

    return docs.mapInArrow(run, StructType([*[docs.schema[k] for k in at], StructField("toxic_sum", DoubleType()), StructField("toxic_score", DoubleType())]))
