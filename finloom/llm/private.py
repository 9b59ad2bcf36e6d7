"""Personal data in texts: fixed patterns, and a conditional random field for what they miss."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.llm.words import row_chunks, small_batches, without

#: The kinds, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

#: Documents from which training chains are taken, about so many, chosen by hash; and chains in all.
LABELLED_DOCS, LABELLED_CHAINS = 20_000, 3_000
#: Characters of a training chain at most; longer chains are decoded, but not learned from.
LABELLED_LENGTH = 400

#: Characters on each side of a digit, @ or written-out at-sign that belong to its chain.
AROUND = 24

#: Tokens that are decoded at once. A longer chain is decoded in windows of so many, each with OVERLAP
#: tokens more on both sides, and gives the spans that begin inside: far more than a feature or a span reaches.
CHAIN_TOKENS, OVERLAP = 50_000, 200

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

_ANCHOR = re.compile(r"[0-9@]+|[(\[{] ?at ?[)\]}]", re.IGNORECASE)
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run of local characters before each @ that a domain follows."""
    done = 0
    for found in _DOMAIN.finditer(text):
        start = at = found.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            done = found.end()
            yield start, done


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the fixed patterns, by kind and start; linear in the text's length."""
    out: list[Span] = []
    if "@" in text:
        out += [(0, a, b) for a, b in _emails(text)]
    if "." in text:
        parts = ((m, m[0].split(".")) for m in _IP.finditer(text))
        out += [(1, m.start(), m.end()) for m, ps in parts if all(len(p := q.lstrip("0")) <= 3 and int(p or 0) <= 255 for q in ps)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def chains(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of the text around digits and at-signs; what is outside holds nothing private."""
    lo = hi = None
    for m in _ANCHOR.finditer(text):
        if hi is not None and m.start() - AROUND <= hi:
            hi = m.end() + AROUND
            continue
        if hi is not None:
            yield lo, min(hi, len(text))
        lo, hi = max(0, m.start() - AROUND), m.end() + AROUND
    if hi is not None:
        yield lo, min(hi, len(text))


# Word shapes and their features.

BITS = 14
#: Labels: 0 is outside, 1 + 2k begins a span of kind k, 2 + 2k goes on with it.
LABELS = 1 + 2 * len(KINDS)
_SINGLES, _PAIRS, _TRIPLES, _WORDS = (-3, -2, -1, 0, 1, 2, 3), (-2, -1, 0, 1), (-2, -1, 0), (-1, 0, 1)
_MARGIN = 4


def shape(token: str, spaced: bool) -> str:
    """Letters by case and length, digits by length, range and check digit, other characters themselves."""
    size = len(token)
    if "0" <= token[0] <= "9":
        kind = f"9{min(size, 20)}" + ("c" if 13 <= size <= 19 and luhn(token) else "") + ("b" if size <= 3 and int(token) <= 255 else "")
    elif token[0].isalpha():
        case = "a" if token.islower() else "A" if token.isupper() else "Aa" if token[0].isupper() else "aA"
        kind = case + (str(size) if size <= 3 else "4" if size <= 6 else "7")
    else:
        kind = token
    return " " + kind if spaced else kind


class Shapes:
    """Numbers of shapes and short words, kept in a table of bounded size."""

    def __init__(self, most: int = 200_000):
        self.most, self.known = most, {}

    def numbers(self, token: str, spaced: bool) -> tuple[int, int]:
        got = self.known.get((token, spaced))
        if got is None:
            if len(self.known) >= self.most:
                self.known.clear()
            word = token.lower() if token[0].isalpha() and len(token) <= 6 else ""
            got = zlib.crc32(shape(token, spaced).encode("utf-8", "replace")), zlib.crc32(word.encode("utf-8", "replace"))
            if len(token) <= 40:
                self.known[token, spaced] = got
        return got


@dataclass
class Batch:
    """Chains of tokens one after another, longest first, with the features of every token."""

    begin: np.ndarray
    size: np.ndarray
    features: np.ndarray

    @classmethod
    def of(cls, tokens: list[list[tuple[int, int]]]) -> Batch:
        """tokens of each chain as (shape, word) numbers; the chains are longest first."""
        size = np.array([len(c) for c in tokens], np.int64)
        total = int(size.sum())
        begin = np.cumsum(size) - size
        place = np.arange(total) + _MARGIN * (1 + np.repeat(np.arange(len(tokens)), size))
        s, w = np.zeros((2, total + _MARGIN * (len(tokens) + 2)), np.uint64)
        flat = np.array([x for c in tokens for x in c], np.uint64).reshape(-1, 2)
        s[place], w[place] = flat[:, 0] + np.uint64(1), flat[:, 1]
        columns = [s[place + d] for d in _SINGLES]
        columns += [s[place + d] * np.uint64(0x9E3779B1) + s[place + d + 1] * np.uint64(0x85EBCA77) for d in _PAIRS]
        columns += [s[place + d] * np.uint64(0xC2B2AE3D) + s[place + d + 1] * np.uint64(0x27D4EB2F) + s[place + d + 2] * np.uint64(0x165667B1) for d in _TRIPLES]
        columns += [w[place + d] for d in _WORDS]
        salts = np.arange(1, len(columns) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h = (np.stack(columns, axis=1) + salts) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return cls(begin, size, (h >> np.uint64(64 - BITS)).astype(np.int64))

    def steps(self) -> Iterator[np.ndarray]:
        """Places of the first, second, ... token of every chain that has one."""
        active = len(self.size)
        for t in range(int(self.size[0]) if active else 0):
            while self.size[active - 1] <= t:
                active -= 1
            yield self.begin[:active] + t


_ALLOWED = np.array([[b == 0 or b % 2 == 1 or a in (b, b - 1) for b in range(LABELS)] for a in range(LABELS)])
_BARRED = np.where(_ALLOWED, 0.0, -1e9)
_START = np.where(np.arange(LABELS) % 2 == 0, -1e9, 0.0) * (np.arange(LABELS) > 0)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


@dataclass
class Field:
    """Weights of the features by label, and of label pairs."""

    weights: np.ndarray
    pairs: np.ndarray

    def scores(self, batch: Batch) -> np.ndarray:
        out = np.zeros((len(batch.features), LABELS))
        for column in batch.features.T:
            out += self.weights[column]
        return out

    def decode(self, batch: Batch) -> np.ndarray:
        """The best labels of all chains, by Viterbi search over all of them at once."""
        score = self.scores(batch)
        back = np.zeros(score.shape, np.int8)
        pairs, steps = self.pairs + _BARRED, list(batch.steps())
        for t, at in enumerate(steps):
            if t == 0:
                score[at] += _START
                continue
            ways = score[at - 1][:, :, None] + pairs
            back[at] = ways.argmax(axis=1)
            score[at] += ways.max(axis=1)
        labels = np.zeros(len(score), np.int8)
        last = batch.begin + batch.size - 1
        labels[last] = score[last].argmax(axis=1)
        for at in reversed(steps[1:]):
            labels[at - 1] = back[at, labels[at]]
        return labels

    def gradient(self, batch: Batch, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the negative log likelihood of the labels, by forward and backward sums."""
        emit = self.scores(batch)
        pairs, steps = self.pairs + _BARRED, list(batch.steps())
        ahead, behind = emit.copy(), np.zeros_like(emit)
        for t, at in enumerate(steps):
            ahead[at] += _START if t == 0 else _logsum(ahead[at - 1][:, :, None] + pairs, 1)
        whole = np.repeat(_logsum(ahead[batch.begin + batch.size - 1], 1), batch.size)
        moved = np.zeros_like(self.pairs)
        for at in reversed(steps[1:]):
            after = emit[at] + behind[at]
            behind[at - 1] = _logsum(pairs + after[:, None, :], 2)
            moved += np.exp(ahead[at - 1][:, :, None] + pairs + after[:, None, :] - whole[at][:, None, None]).sum(axis=0)
            np.add.at(moved, (labels[at - 1], labels[at]), -1.0)
        wrong = np.exp(ahead + behind - whole[:, None])
        wrong[np.arange(len(labels)), labels] -= 1
        width = batch.features.shape[1]
        by_label = [np.bincount(batch.features.ravel(), np.repeat(wrong[:, k], width), 1 << BITS) for k in range(LABELS)]
        return np.stack(by_label, axis=1), moved


# Training.

LABELLED = "text string, kinds array<int>, starts array<int>, ends array<int>"


def labelled_chains(docs: DataFrame, text_column: str = "text", rows: int = LABELLED_DOCS, most: int = LABELLED_CHAINS) -> DataFrame:
    """A small labelled table out of docs: chains of the text (LABELLED) with the spans of the fixed patterns.

    About `rows` texts, chosen by hash, give their chains of up to LABELLED_LENGTH characters; of these
    the `most` smallest by hash are taken. Chains in which a pattern matched and its digits were
    refused are left out, but for lone numbers: nobody knows what such a match holds.
    """
    small_batches(docs.sparkSession)
    share = min(1.0, rows / max(1, docs.count()))
    texts = docs.where(F.col(text_column).isNotNull()).select(F.col(text_column).cast("string").alias("text"))
    chosen = texts.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else texts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in row_chunks(batches, "text"):
            out = []
            for text in (t.decode("utf-8", "replace") for t in found if t):
                spans = base_spans(text)
                for lo, hi in chains(text):
                    piece = text[lo:hi]
                    if hi - lo <= LABELLED_LENGTH and not _doubtful(piece):
                        own = sorted((a - lo, b - lo, k) for k, a, b in spans if lo <= a and b <= hi)
                        own = [x for n, x in enumerate(own) if not n or x[0] >= own[n - 1][1]]
                        out.append((piece, [x[2] for x in own], [x[0] for x in own], [x[1] for x in own]))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), *[pa.list_(pa.int32())] * 3))], names=["text", "kinds", "starts", "ends"])

    return chosen.mapInArrow(cut, LABELLED).distinct().orderBy(F.xxhash64("text"), "text").limit(most)


def _doubtful(piece: str) -> bool:
    cards = (len(_NOT_DIGIT.sub("", m[0])) for m in _CARD.finditer(piece))
    phones = (len(_NOT_DIGIT.sub("", m[0])) for m in _PHONE.finditer(piece))
    return any(n > 19 for n in cards) or any(not 8 <= n <= 15 for n in phones)


def _variant(row: tuple[str, list[int], list[int], list[int]], turn: int) -> tuple[str, list[Span]]:
    """The chain with its spans in another form, which the fixed patterns do not know."""
    text, kinds, starts, ends = row
    out, spans, done = "", [], 0
    for kind, a, b in zip(kinds, starts, ends, strict=True):
        inner = text[a:b]
        if kind == 0:
            if turn % 3 == 0:  # a name of letters alone
                inner = re.sub(r"[0-9]+(?=@)", "smith"[: 2 + turn % 4], inner)
            sign, dot = ((" (at) ", "."), ("[at]", "[dot]"), (" @ ", "."), (" (at) ", " (dot) "))[turn % 4]
            inner = inner.replace("@", sign)
            inner = inner if dot == "." else inner.replace(".", dot)
        elif kind == 1:
            inner = inner.replace(".", ("[.]", ".", " . ")[turn % 3])
        elif kind == 3:
            digits = _NOT_DIGIT.sub("", inner)
            form = ("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "+{} {} {}", "00 {} {} {}")[turn % 5]
            inner = form.format(digits[-10:-7], digits[-7:-4], digits[-4:])
        out += text[done:a] + inner
        spans.append((kind, len(out) - len(inner), len(out)))
        if turn % 4 == 3 and kind >= 2:  # another number follows closely
            tail = ("9.12.200.7", inner)[turn % 2]
            out += " " + tail
            spans.append(((1, kind)[turn % 2], len(out) - len(tail), len(out)))
        done = b
    return out + text[done:], spans


def _tokens(text: str, shapes: Shapes) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(shape, word) numbers and (start, end) of each token."""
    numbers, places, end = [], [], 0
    for m in _TOKEN.finditer(text):
        numbers.append(shapes.numbers(m[0], m.start() > end or not m.start()))
        end = m.end()
        places.append((m.start(), end))
    return numbers, places


def train(labelled: DataFrame, rounds: int = 12, per_step: int = 150, rate: float = 0.25, pull: float = 1e-4) -> Field:
    """The field fitted to a labelled table (LABELLED, a bounded one: it is read by the driver).

    Each chain is learned as it is and once in another form. Without rows all weights are 0 but
    one that prefers no span, so nothing is added to the fixed patterns."""
    rows = sorted((r["text"], list(r["kinds"]), list(r["starts"]), list(r["ends"])) for r in labelled.select("text", "kinds", "starts", "ends").collect())
    field = Field(np.zeros((1 << BITS, LABELS)), np.zeros((LABELS, LABELS)))
    shapes, examples = Shapes(), []
    for n, row in enumerate(rows):
        forms = [(row[0], list(zip(*row[1:], strict=True)))] + ([_variant(row, n)] if row[1] else [])
        for text, spans in forms:
            numbers, places = _tokens(text, shapes)
            if numbers:
                labels = np.zeros(len(numbers), np.int64)
                for kind, a, b in spans:
                    inside = [k for k, (x, y) in enumerate(places) if x < b and y > a]
                    labels[inside] = 2 + 2 * kind
                    labels[inside[:1]] = 1 + 2 * kind
                examples.append((numbers, labels))
    if not examples:
        field.pairs[0, 1:] = field.pairs[1:, 1:] = -1.0
        return field
    order = np.random.default_rng(7)
    sums = [np.full_like(field.weights, 1e-6), np.full_like(field.pairs, 1e-6)]
    for _ in range(rounds):
        dealt = order.permutation(len(examples))
        for k in range(0, len(dealt), per_step):
            some = sorted((examples[i] for i in dealt[k : k + per_step]), key=lambda e: -len(e[0]))
            batch = Batch.of([e[0] for e in some])
            found = field.gradient(batch, np.concatenate([e[1] for e in some]))
            for own, grad, total in zip((field.weights, field.pairs), found, sums, strict=True):
                grad += pull * len(some) * own
                total += grad * grad
                own -= rate * grad / np.sqrt(total)
    return Field(field.weights.astype(np.float32).astype(float), field.pairs)


def plausible(kind: int, text: str) -> bool:
    """Whether a decoded span has what its kind needs."""
    digits = _NOT_DIGIT.sub("", text)
    if kind == 0:
        return bool(re.fullmatch(r"[\w.%+-]+ ?(?:@|[(\[{] ?at ?[)\]}]) ?[\w-]+(?: ?(?:\.|[(\[{] ?dot ?[)\]}]) ?[\w-]+)+", text, re.IGNORECASE))
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and not re.search(r"[^0-9.\[\]() ]", text)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9 .-]", text)
    return 7 <= len(digits) <= 15 and not re.search(r"[^0-9 ()+./-]", text)


PRIVATE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def _windows(size: int) -> Iterator[tuple[int, int, int, int]]:
    """(from, to, own from, own to) of the windows in which a chain of tokens is decoded: one, but for very long chains."""
    for lo in range(0, max(size, 1), CHAIN_TOKENS):
        hi = min(size, lo + CHAIN_TOKENS)
        yield max(0, lo - OVERLAP), min(size, hi + OVERLAP), lo, hi


def _decoded(texts: Sequence[str], field: Field, shapes: Shapes) -> list[list[Span]]:
    """What the field finds in each text, before it is held against the fixed patterns."""
    out: list[list[Span]] = [[] for _ in texts]
    held: list[tuple] = []

    def decode() -> None:
        held.sort(key=lambda p: -len(p[0]))
        batch = Batch.of([p[0] for p in held])
        labels = field.decode(batch)
        for (_, places, lo, k, first, own_lo, own_hi), begin, size in zip(held, batch.begin.tolist(), batch.size.tolist(), strict=True):
            own = labels[begin : begin + size]
            for s in np.flatnonzero(own % 2 == 1).tolist():
                if own_lo <= first + s < own_hi:
                    e = s + 1
                    while e < size and own[e] == own[s] + 1:
                        e += 1
                    out[k].append(((int(own[s]) - 1) // 2, lo + places[s][0], lo + places[e - 1][1]))
        held.clear()

    waiting = 0
    for k, text in enumerate(texts):
        for lo, hi in chains(text):
            numbers, places = _tokens(text[lo:hi], shapes)
            for a, b, own_lo, own_hi in _windows(len(numbers)) if numbers else ():
                held.append((numbers[a:b], places[a:b], lo, k, a, own_lo, own_hi))
                waiting += b - a
                if waiting >= CHAIN_TOKENS:
                    decode()
                    waiting = 0
    if held:
        decode()
    return out


def find_private(docs: DataFrame, field: Field, text_column: str = "text") -> DataFrame:
    """docs with `private`: (kind, start, end, base) of every span, by kind as in KINDS, then start.

    Places are code points, the end exclusive. Spans of the fixed patterns (base) always stay. The
    field adds those it decodes in the chains of the whole text that look like their kind and overlap
    no other span. Chains of more than CHAIN_TOKENS tokens are decoded in overlapping windows, so memory stays
    bounded. A null or empty text has none. Rows are judged alone: repeated rows alike;
    an input column named private is replaced, others are kept. An empty table gives no row.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = without(docs, "private")
    shared = spark.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shapes = shared.value, Shapes()
        for rows, found in row_chunks(batches, text_column, 1 << 20):
            texts = [t.decode("utf-8", "replace") if t else "" for t in found]
            out = []
            for text, more in zip(texts, _decoded(texts, own, shapes), strict=True):
                base = base_spans(text)
                taken = Taken(base)
                added = [s for s in more if not taken.meets(*s[1:]) and plausible(s[0], text[s[1] : s[2]])]
                spans = sorted([(*s, True) for s in base] + [(*s, False) for s in added])
                out.append([{"kind": KINDS[k], "start": a, "end": b, "base": x} for k, a, b, x in spans])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, _ARROW)], names=[*rows.schema.names, "private"])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField("private", PRIVATE)]))


class Taken:
    """Answers whether a stretch meets one of the spans."""

    def __init__(self, spans: list[Span]):
        listed = sorted((a, b) for _, a, b in spans)
        self.starts = [a for a, _ in listed]
        self.reach = list(accumulate((b for _, b in listed), max))

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.reach[before - 1] > start
