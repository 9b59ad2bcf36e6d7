"""Nearest vectors by cosine: int8 products of blocks with error bounds, exact check, heaps."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from finloom.session import materialize

#: Numbers in one block of candidates; a block of queries has an eighth of it.
BLOCK_NUMBERS = 1 << 21
#: Rows of a product tile worked on at a time.
STRIPE = 64


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit vectors, their scales, and the length of what rounding took away."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = np.sqrt(np.square(unit - codes * scale[:, None]).sum(axis=1))
    return codes, scale, lost


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of paired rows, added up from the first component to the last."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)


CODED = "vector_id long, vector_key long, d int, codes binary, scale double, lost double"


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vector_id, vector_key, vector) as int8 codes of the unit vectors, CODED."""
    for batch in batches:
        size = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
        for d in np.unique(size).tolist():
            some = batch.take(pa.array(np.flatnonzero(size == d)))
            v = _matrix(pa.chunked_array([some.column(2)]))
            codes, scale, lost = quantised(v / np.sqrt(dot(v, v))[:, None])
            columns = [some.column(0), some.column(1), pa.array(np.full(len(v), d), pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale), pa.array(lost)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in CODED.split(", ")])


def _codes(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(b"".join(table["codes"].to_pylist()), np.int8).reshape(table.num_rows, -1)
    return table["vector_id"].to_numpy(), codes, table["scale"].to_numpy(), table["lost"].to_numpy()


def _tile(keep: int):
    """Of a tile, the candidates that may be among the keep best of a query, with bounds of their cosine."""

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)]]
        if queries.num_rows and candidates.num_rows:
            names, code_q, scale_q, lost_q = _codes(queries)
            ids, code_c, scale_c, lost_c = _codes(candidates)
            # products of codes are whole numbers; float32 holds them exactly up to 2^24
            kind = np.float32 if code_q.shape[1] * 127 * 127 < 1 << 24 else np.float64
            across = np.ascontiguousarray(code_c.T.astype(kind))
            for at in range(0, len(names), STRIPE):
                rows = slice(at, at + STRIPE)
                near = (code_q[rows].astype(kind) @ across) * scale_q[rows, None] * scale_c[None, :]
                bound = lost_q[rows, None] + (1 + lost_q[rows, None]) * lost_c[None, :] + 1e-9
                least = near - bound
                if len(ids) > keep:
                    floor = np.partition(least, len(ids) - keep, axis=1)[:, len(ids) - keep]
                    i, j = np.nonzero(near + bound >= floor[:, None])
                else:
                    i, j = np.nonzero(np.ones_like(near, bool))
                for column, values in zip(found, (names[i + at], ids[j], least[i, j], (near + bound)[i, j]), strict=True):
                    column.append(values)
        columns = [np.concatenate(c) for c in found]
        return pa.table(dict(zip(("query", "candidate", "low", "high"), map(pa.array, columns), strict=True)))

    return run


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (query, candidate, x, y) with the exact cosine of the vectors x and y."""
    for batch in batches:
        size = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
        for d in np.unique(size).tolist():
            some = batch.take(pa.array(np.flatnonzero(size == d)))
            x, y = (_matrix(pa.chunked_array([some.column(k)])) for k in (2, 3))
            score = dot(x, y) / (np.sqrt(dot(x, x)) * np.sqrt(dot(y, y)))
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(score)], names=["query", "candidate", "score"])


def best_of(keep: int):
    """Of the rows (query, candidate, score) of a group of one query: the keep best, from a heap."""

    def run(table: pa.Table) -> pa.Table:
        rows = zip((-table["score"].to_numpy()).tolist(), table["candidate"].to_pylist(), strict=True)
        best = heapq.nsmallest(keep, rows)
        return pa.table({"query": table["query"][: len(best)], "candidate": pa.array([c for _, c in best], pa.int64()), "score": pa.array([-s for s, _ in best], pa.float64())})

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest rows of every query row.

    Nearness is the cosine in double precision: products added up in order, over the product of
    the two lengths. Every row but the query's own id is a candidate; ties go to the smaller id;
    fewer candidates give fewer rows. Vectors that are null, empty, all zero, or hold null or
    non-finite components take no part, nor do rows without id; vectors of different length never
    meet. An id repeated with the same vector counts once; one with several vectors stands with
    each. Other columns are ignored; an empty table or no query gives no rows.

    Equal vectors are one entry with its k + 1 smallest ids: no more can be among the k nearest.
    Vectors are quantised once, and what is dealt into blocks and tiles (one block of queries and one of
    entries) are int8 codes with a scale. For unit vectors u = u' + a and v = v' + b the product of
    codes is off by at most |a| + |u'||b|, so a candidate whose upper bound is below the
    (k + 1)-th lower bound, of its tile or of all tiles, is out. The vectors of the others are
    fetched by id for the exact cosine, and heaps give the k + 1 best entries per query.
    """
    keep = k + 1
    vector = F.col(vector_column).cast("array<double>")
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = vectors.where(F.col(id_column).isNotNull()).where(usable).select(F.col(id_column).cast("long").alias("id"), vector.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))  # one zero
    stored = materialize(rows.withColumn("vector_key", F.xxhash64("vector")).distinct(), "vectors")
    entry = ["vector_key", "vector"]
    order = F.row_number().over(_window(entry, F.col("id")))
    few = stored.select("id", *entry).distinct().withColumn("n", order).where(F.col("n") <= keep)
    entries = materialize(few.groupBy(*entry).agg(F.min("id").alias("vector_id"), F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    asked = stored.where("asks").groupBy(*entry).agg(F.min("id").alias("vector_id"))
    sizes = {r["d"]: (r["n"], r["q"]) for r in entries.select(F.size("vector").alias("d"), F.lit(0).alias("q")).unionAll(asked.select(F.size("vector"), F.lit(1))).groupBy("d").agg(F.sum(1 - F.col("q")).alias("n"), F.sum("q").alias("q")).collect()}

    def blocks(of: int, numbers: int) -> Column:
        """Number of blocks for a vector's length."""
        counts = [(d, max(1, -(-n[of] * d // numbers))) for d, n in sizes.items()]
        return reduce(lambda c, x: F.when(F.col("d") == x[0], F.lit(x[1])).otherwise(c), counts, F.lit(1))

    parts_c, parts_q = blocks(0, BLOCK_NUMBERS), blocks(1, BLOCK_NUMBERS // 8)

    def dealt(df: DataFrame, own: Column, other: Column, own_name: str, other_name: str) -> DataFrame:
        coded = df.select("vector_id", "vector_key", "vector").mapInArrow(_code, CODED)
        numbered = coded.select("*", F.pmod(F.col("vector_key"), own).cast("int").alias(own_name), F.explode(F.sequence(F.lit(0), other - 1)).alias(other_name))
        return numbered.drop("vector_key")

    left = dealt(asked, parts_q, parts_c, "q", "c").groupBy("d", "q", "c")
    right = dealt(entries, parts_c, parts_q, "c", "q").groupBy("d", "q", "c")
    tiles = materialize(left.cogroup(right).applyInArrow(_tile(keep), "query long, candidate long, low double, high double"), "tiles")
    order = F.row_number().over(_window(["query"], F.col("low").desc(), F.col("candidate")))
    floors = tiles.withColumn("n", order).where(F.col("n") == keep).select("query", F.col("low").alias("floor"))
    pairs = tiles.join(floors, "query", "left").where("floor IS NULL OR high >= floor").select("query", "candidate")
    one, two = (df.select(F.col("vector_id").alias(n), F.col("vector").alias(v)) for df, n, v in ((asked, "query", "x"), (entries, "candidate", "y")))
    scored = pairs.join(one, "query").join(two, "candidate").select("query", "candidate", "x", "y").mapInArrow(_exact, "query long, candidate long, score double")
    ranked = scored.groupBy("query").applyInArrow(best_of(keep), "query long, candidate long, score double")
    ids = ranked.join(entries.select(F.col("vector_id").alias("candidate"), "ids"), "candidate").select("query", "score", F.explode("ids").alias("id"))
    best = ids.withColumn("n", F.row_number().over(_window(["query"], F.col("score").desc(), F.col("id")))).where(F.col("n") <= keep)
    lists = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("found"))
    lists = asked.join(lists, asked["vector_id"] == lists["query"]).select(*entry, "found")
    each = stored.where("asks").join(lists, entry).select(F.col("id").alias("query_id"), F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, k).alias("found"))
    return each.select("query_id", F.posexplode("found")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.id").alias("vec_id"), F.col("col.score").alias("score"))


def _window(by: list[str], *order: Column) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order)
