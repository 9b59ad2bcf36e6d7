"""Sum-of-squares online packing of tokenised documents into fixed windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from finloom.llm.tokens import WordTokenizer
from finloom.llm.words import row_chunks, small_batches, without

PIECE = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Windows of a fixed capacity, filled by the sum-of-squares rule.

    counts[h] is the number of open windows filled to level h. A document's remainder of s tokens
    goes to the level h with h + s <= capacity whose step to h + s makes the sum of the squared
    counts smallest (ties: the fullest such level); level 0 opens a window. Full windows are
    emitted at once, so only open windows are held. The rule keeps the counts of every level low.
    """

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(capacity + 1)]

    def _emit(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for row, start, ids, total in pieces:
            yield row, start, len(ids) // 4, ids, total, self.next_id, offset
            offset += len(ids) // 4
        self.next_id += 1

    def add(self, row, ids: bytes) -> Iterator[tuple]:
        """ids: little-endian unsigned 32-bit token ids of one document."""
        total, cap = len(ids) // 4, self.capacity
        whole = total // cap * cap
        for at in range(0, whole, cap):
            yield from self._emit([(row, at, ids[4 * at : 4 * (at + cap)], total)])
        size = total - whole
        if not size:
            return
        last = cap - size
        cost = 2 * self.counts[size:] + 1  # of the level that gains a window; a full window leaves
        cost[last] = 0
        cost[1:] += np.where(self.counts[1 : last + 1] > 0, 1 - 2 * self.counts[1 : last + 1], np.iinfo(np.int64).max // 4)
        level = int(last - np.argmin(cost[::-1]))
        pieces = self.open[level].pop() if level else []
        self.counts[level] -= level > 0
        pieces.append((row, whole, ids[4 * whole :], total))
        if level + size == cap:
            yield from self._emit(pieces)
        else:
            self.open[level + size].append(pieces)
            self.counts[level + size] += 1

    def close(self) -> Iterator[tuple]:
        """Fill the fullest open windows by cutting up the emptiest; the one window left over is
        cut into windows of a power of two, which need no padding."""
        rest = [p for level in reversed(self.open) for p in level]
        size = [sum(len(x[2]) for x in p) // 4 for p in rest]
        donor = len(rest) - 1
        for k in range(len(rest)):
            while donor > k and size[k] < self.capacity:
                row, start, ids, total = rest[donor].pop()
                take = min(len(ids) // 4, self.capacity - size[k])
                if 4 * take < len(ids):
                    rest[donor].append((row, start + take, ids[4 * take :], total))
                rest[k].append((row, start, ids[: 4 * take], total))
                size[k] += take
                size[donor] -= take
                donor -= not rest[donor]
            if size[k] == self.capacity:
                yield from self._emit(rest[k])
            elif size[k]:
                yield from self._tail(rest[k], size[k])
                break

    def _tail(self, pieces: list[tuple], size: int) -> Iterator[tuple]:
        queue = pieces[::-1]
        for bit in reversed(range(size.bit_length())):
            want, part = size & (1 << bit), []
            while want:
                row, start, ids, total = queue.pop()
                take = min(want, len(ids) // 4)
                if 4 * take < len(ids):
                    queue.append((row, start + take, ids[4 * take :], total))
                part.append((row, start, ids[: 4 * take], total))
                want -= take
            if part:
                yield from self._emit(part)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_column: str = "doc_id", text_column: str = "text", end_id: int = 1) -> DataFrame:
    """One row per piece: the id, start, length, ids (little-endian uint32), doc_tokens,
    sequence_id and offset.

    Each task packs the documents it reads: no shuffle, one pass, and memory for the open windows
    only. Ids come from the tokenizer file without special tokens, then end_id. A document of more
    than capacity tokens fills whole windows first. Per task at most one window is not full; it is
    cut into windows of powers of two. A null or empty text is the end id alone; repeated rows and
    null ids are packed like any other; other columns are ignored; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(id_column, text_column)
    id_field = docs.schema[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordTokenizer.load(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        packer = Packer(capacity, TaskContext.get().partitionId() << 40)
        kept: list[tuple] = []
        kind = None

        def batch() -> pa.RecordBatch:
            cols = list(zip(*kept, strict=True))
            types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = [id_field.name, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            out = pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)
            kept.clear()
            return out

        for rows, texts in row_chunks(batches, text_column):
            kind = rows.schema.field(id_field.name).type
            for row, ids in zip(rows.column(0).to_pylist(), encode.encode_all(texts), strict=True):
                kept.extend(packer.add(row, ids + end))
            if kept:
                yield batch()
        for piece in packer.close():
            kept.append(piece)
            if len(kept) == 1000:
                yield batch()
        if kept:
            yield batch()

    schema = f"`{id_field.name}` {id_field.dataType.simpleString()}, {PIECE}"
    return without(docs.mapInArrow(run, schema))
