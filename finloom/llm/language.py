"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from finloom.llm.words import drop_kept, mix, row_chunks, small_batches, without

BUCKET_BITS = 16
ORDERS = (1, 2, 3)
UNKNOWN = "und"

#: Bytes of text handled at once: the arrays made of them take 60 times as much.
CHUNK_BYTES = 1 << 19

#: Standard deviations of a text's mean log probability that are put down to its length.
CHANCE = 3.0

_U = np.uint64

#: Code points that stand for the edge of a text and for what is not a letter; no letter has them.
_MARK, _GAP = 1, 32
_PLAIN = np.array([b if chr(b).isalpha() else _GAP for b in range(128)], np.uint32)


def gram_buckets(texts: list[bytes], bits: int = BUCKET_BITS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of all n-grams of code points of the lower-cased texts, one array per order and by
    position, and where the positions of each text begin and end. Runs of ASCII characters other
    than letters are one gap. A text stands between marks of its own, so its grams tell where it
    begins and ends and never reach into another text."""
    lowered = [t.decode("utf-8", "replace").lower() for t in texts]
    chars = np.frombuffer(("".join(f" {t}  " for t in lowered) + " ").encode("utf-32-le", "replace"), np.uint32)
    size = np.array([len(t) + 3 for t in lowered], np.int64)
    begins = np.cumsum(size) - size
    chars = np.where(chars < 128, _PLAIN[np.minimum(chars, 127)], chars)
    for mark in (begins, begins + size - 2, begins + size - 1):
        chars[mark] = _MARK
    kept = np.ones(len(chars), bool)
    kept[1:] = (chars[1:] != _GAP) | (chars[:-1] != _GAP)
    place = np.cumsum(kept) - 1
    chars = chars[kept].astype(_U)
    n = max(0, len(chars) - 2)
    gram, out = np.zeros(n, _U), []
    for k in range(max(ORDERS)):
        gram |= chars[k : k + n] << _U(21 * k)
        out.append((mix(gram) >> _U(64 - bits)).astype(np.uint32))
    return out, place[begins], place[begins + size - 2]


def _own_positions(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The positions of all texts, without the line feeds after them."""
    size = ends - begins
    return np.arange(size.sum()) + np.repeat(begins - (np.cumsum(size) - size), size)


def train(docs: DataFrame, bits: int = BUCKET_BITS, text_column: str = "text", lang_column: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and the matrix of log probabilities (languages x 2^bits), with the log prior in
    the last column. Counts every n-gram of every row whose text and language are not null.

    Each task adds up its rows in a table of fixed size; the sums are shuffled by slice of 256
    buckets. The matrix has 2^bits columns and a row per language, whatever the rows."""
    small_batches(docs.sparkSession)
    slices = 1 << (bits - 8)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        sums: dict[str, np.ndarray] = {}
        for rows, texts in row_chunks(batches, "text", CHUNK_BYTES):
            langs = rows.column(1).to_pylist()
            for lang in set(langs):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                total = sums.setdefault(lang, np.zeros((1 << bits) + 1, np.int64))
                grams, begins, ends = gram_buckets(own, bits)
                at = _own_positions(begins, ends)
                for g in grams:
                    total[:-1] += np.bincount(g[at], minlength=1 << bits)
                total[-1] += len(own)
        for lang, total in sums.items():
            cells = list(total[:-1].reshape(slices, 256)) + [total[-1:]]
            yield pa.record_batch([pa.array([lang] * len(cells)), pa.array(range(len(cells)), pa.int32()), pa.array([c.tolist() for c in cells], pa.list_(pa.int64()))], names=["lang", "part", "counts"])

    rows = docs.where(f"`{text_column}` IS NOT NULL AND `{lang_column}` IS NOT NULL").select(F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    parts = rows.mapInArrow(count, "lang string, part int, counts array<bigint>")
    cells = parts.select("lang", "part", F.posexplode("counts").alias("k", "n")).groupBy("lang", "part", "k").agg(F.sum("n").alias("n"))
    sums = cells.groupBy("lang", "part").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "n"))), lambda x: x["n"]).alias("counts")).collect()
    langs = sorted({r["lang"] for r in sums})
    counts = np.zeros((len(langs), (1 << bits) + 1))
    for r in sums:
        at = r["part"] * 256
        counts[langs.index(r["lang"]), at : at + len(r["counts"])] = r["counts"]
    grams, docs_of = counts[:, :-1] + 0.5, counts[:, -1:]
    matrix = np.log(grams) - np.log(grams.sum(axis=1, keepdims=True))
    return langs, np.hstack([matrix, np.log(np.maximum(docs_of, 1)) - np.log(max(docs_of.sum(), 1))]).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_column: str = "text") -> DataFrame:
    """docs with lang_pred; score, the posterior probability of lang_pred; and lang_fit, by how many
    nats a gram the text is less likely than texts of lang_pred are on average, for their share
    of the grams by chance left off (0 or less: as likely as they are).

    All n-grams of the whole text count. A null text, or one without any letter, gets `und` with
    score 0 and no lang_fit, as does every text when nothing was learned. Ties go to the first language by name.
    Rows are scored alone: repeated rows score alike, and input columns named lang_pred, score or
    lang_fit are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    langs, matrix = model
    shared = spark.sparkContext.broadcast(matrix)
    docs = without(docs, "lang_pred", "score", "lang_fit")
    own = np.exp(matrix[:, :-1].astype(float))
    mean = (own * matrix[:, :-1]).sum(axis=1)
    spread = np.sqrt(np.maximum((own * matrix[:, :-1].astype(float) ** 2).sum(axis=1) - mean**2, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        weights = np.ascontiguousarray(shared.value[:, :-1])
        prior = shared.value[:, -1].astype(float)
        for rows, texts in row_chunks(batches, text_column, CHUNK_BYTES):
            known = np.array([bool(langs) and t is not None and any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in texts])
            pred, score, fit = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.full(len(texts), np.nan)
            judged = [t for t, k in zip(texts, known, strict=True) if k]
            if judged:
                grams, begins, ends = gram_buckets(judged)
                sums = np.empty((len(judged), len(langs)))
                cuts = np.stack([begins, ends], axis=1).ravel()
                for k in range(len(langs)):
                    each = weights[k][grams[0]].astype(float)
                    for g in grams[1:]:
                        each += weights[k][g]
                    sums[:, k] = np.add.reduceat(each, cuts)[::2]
                total = sums + prior
                best = total.argmax(axis=1)
                places = (ends - begins).astype(float)
                behind = mean[best] - sums[np.arange(len(judged)), best] / (len(ORDERS) * places)
                pred[known] = np.array(langs, object)[best]
                score[known] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                fit[known] = behind - CHANCE * spread[best] / np.sqrt(places)
            columns = [pa.array(pred, pa.string()), pa.array(score), pa.array(fit, from_pandas=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *columns], names=[*rows.schema.names, "lang_pred", "score", "lang_fit"])

    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("lang_fit", DoubleType())]
    return docs.mapInArrow(run, StructType([*docs.schema, *added]))
