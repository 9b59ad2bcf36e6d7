"""Words of many documents at once, as numpy arrays over one byte buffer.

Words are maximal runs of bytes other than the separators. Hashes are polynomial fingerprints
modulo 2^64 of each word's bytes, finished with a bit mixer; they steer buckets and sets.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled by one numpy step, unless a single document is longer.
CHUNK_BYTES = 1 << 20

#: The whitespace class of the word pattern [^\x20\x09-\x0D]+.
WHITESPACE = np.zeros(256, bool)
WHITESPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Also ASCII punctuation and controls: what is left are letters, digits and non-ASCII bytes.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, np.ndarray] = {}
#: What this Python worker keeps for its next task.
_kept: dict[Hashable, Any] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; grown as needed and kept up to a few chunks' length."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, min(n * 5 // 4, 4 * CHUNK_BYTES))
        got = np.full(size, base & (2**64 - 1), _U)
        got[0] = 1
        got = np.cumprod(got, dtype=_U)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = got
    return got[:n]


@dataclass
class Words:
    """Words of a run of rows: joined by single spaces in buf, from start to end, of row doc."""

    buf: bytes
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    rows: int

    def first(self) -> np.ndarray:
        """For each row, the index of its first word; one more entry than rows."""
        return np.searchsorted(self.doc, np.arange(self.rows + 1))

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, _U)
        a = np.frombuffer(self.buf, np.uint8).astype(_U) + _U(1)
        n = len(a) + 1
        sums = np.zeros(n, _U)
        np.cumsum(a * _power(_BASE, n)[:-1], out=sums[1:])
        inverse = _power(pow(_BASE, -1, 2**64), n)
        h = (sums[self.end] - sums[self.start]) * inverse[self.start]
        return mix(h ^ (self.end - self.start).astype(_U))

    def grams(self, n: int, h: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n consecutive words from each word on, and whether they lie in one row."""
        h = self.hashes() if h is None else h
        size = max(0, len(h) - n + 1)
        g = np.zeros(size, _U)
        for k in range(n):
            g = mix(g * _U(31) + h[k : k + size])
        return g, self.doc[:size] == self.doc[n - 1 : n - 1 + size]


def words_of(texts: list[bytes | None], separators: np.ndarray = WHITESPACE, lower: bool = False) -> Words:
    """The words of each text; a null text has none."""
    size = np.array([len(t) if t else 0 for t in texts], np.int64)
    joined = np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)
    if lower:
        joined = LOWER[joined]
    gap = separators[joined]
    before = np.empty_like(gap)
    before[0] = True
    before[1:] = gap[:-1]
    keep = ~gap
    begin = np.flatnonzero(keep & before)
    closing = gap & ~before
    finish = np.flatnonzero(closing)
    out = np.where(closing, np.uint8(32), joined)[keep | closing]
    length = finish - begin
    end = np.cumsum(length + 1) - 1
    row_end = np.cumsum(size + 1)
    return Words(out.tobytes(), end - length, end, np.searchsorted(row_end, begin, "right"), len(texts))


def row_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of batches whose column holds up to limit bytes, with that column as bytes."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary()).to_pylist()
        lo = total = 0
        for k, t in enumerate(texts):
            n = len(t) if t else 0
            if k > lo and total + n > limit:
                yield batch.slice(lo, k - lo), texts[lo:k]
                lo, total = k, 0
            total += n
        if lo < len(texts):
            yield batch.slice(lo), texts[lo:]


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """make(), kept by this Python worker for its next task, until it asks for another key."""
    if key not in _kept:
        drop_kept()
        _kept[key] = make()
    return _kept[key]


def drop_kept() -> None:
    """Give back what an earlier step's tasks have kept in this Python worker: Spark runs later steps in it too."""
    if _kept:
        _kept.clear()
        gc.collect()


def small_batches(spark: SparkSession, size: int = 16 << 20) -> None:
    """Keep Arrow batches of long texts small, of about size bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def row_key(id_column: str, text_column: str) -> Column:
    """Stands for a row: equal only for repeated rows, up to a 64-bit hash."""
    return F.xxhash64(F.col(id_column), F.col(text_column))


def id_remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def without(df, *names: str):
    """df without columns of these names, in any case, so that an operator can add its own."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
