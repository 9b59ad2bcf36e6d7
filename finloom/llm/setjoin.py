"""Jaccard self-join of word n-gram sets by universe partitions, and its groups.

Sets are compared inside size bands. For a band whose sets have at most s elements, a pair with
the wanted similarity differs in at most H elements. A hash deals the universe of n-grams into m
segments; the part of a set in a segment is its subset.

* Whole subsets: with m = H + 1 + 2e segments at least 2e + 1 subsets of a pair are equal. Each set
  may leave out the keys of e subsets, its smallest, since these cost most candidates: one equal
  key is left.
* One-deletion neighbourhoods: with m = H // 2 + 1 segments some subset differs in one element at
  most. A subset's key and its keys with any one element deleted then meet the other's.

An empty part would be a key that all sets without it share. Such a key is replaced by the
keys of a second partition, tagged with the first one's segment: two sets that
both leave the segment empty both send them, and these meet by the second partition's own count.

Each band takes the cheaper way by an estimate of keys and of useless meetings. Pairs that meet
are checked on their whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.components import components
from finloom.llm.words import drop_kept, mix, row_chunks, row_key, small_batches, words_of
from finloom.operators.lookup import lookup_join
from finloom.session import free_shuffles, materialize

#: Cost of an expected key of an empty part of the second partition, in keys.
EMPTY_COST = 200.0
#: Widths of the size bands to choose from.
BAND_WIDTHS = (3.0, 2.5, 2.0, 1.5, 1.25, 1.0)
#: Numbers of subsets left out to choose from.
SKIPS = (0, 1, 2, 3, 4, 5, 7, 9, 12, 15, 20, 26, 34, 44, 57, 74, 96, 125, 160, 210, 270, 350)
#: Nodes in a block of a tile.
TILE_NODES = 1500
#: Bytes of text whose sets are made at once: the arrays made of them take 50 times as much.
CHUNK_BYTES = 1 << 18
#: Row keys that are sent to every task to pick texts; more are joined by shuffle.
MOST_SENT = 2_000_000

_U = np.uint64


class Bands:
    """Size bands for a least similarity of num/den, and the way each band takes."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        sizes = [round(100 * 1.2**k) for k in range(20)]
        self._widen(min(BAND_WIDTHS, key=lambda width: (self._widen(width), sum(self.cost(n) / n for n in sizes))[1]))

    def _widen(self, width: float) -> None:
        """Bands whose sizes span a factor of (den / num) ** width: wide ones are fewer, narrow ones
        let fewer elements differ."""
        self.width, self.low = width, [1, 2]
        self._ways: dict[int, tuple[bool, int, int]] = {}

    def cost(self, n: int) -> float:
        """Keys, and what empty parts cost, of a set of n elements."""
        total = 0.0
        for band in self.of(n):
            deletions, m, skip = self.way(band)
            total += self._cost(n, deletions, m, skip, self._apart(band))
        return total

    def _apart(self, band: int) -> int:
        """Elements in which two sets of a band differ at most."""
        return (self.den - self.num) * 2 * (self.low[band + 1] - 1) // (self.den + self.num)

    def _cost(self, n: int, deletions: bool, m: int, skip: int, apart: int) -> float:
        empty = 0.0
        if m > 1:
            empty = m * math.exp(-n / m) * (1 + n / m) if deletions else _beyond(m * math.exp(-n / m), skip)
        return (m + n if deletions else m - skip) + empty * _second(n, apart)[0]

    def of(self, n: int) -> range:
        """Bands in which a set of n elements can meet another: its own, and those of larger sets."""
        most = n * self.den // self.num
        while self.low[-2] <= most:
            self.low.append(max(self.low[-1] + 1, math.ceil(self.low[-1] * (self.den / self.num) ** self.width)))
        if not n:
            return range(0)
        return range(max(0, int(np.searchsorted(self.low, n, "right")) - 1), int(np.searchsorted(self.low, most, "right")))

    def way(self, band: int) -> tuple[bool, int, int]:
        """(deletions, segments, subsets left out) of a band."""
        if band not in self._ways:
            least, apart = max(1, math.ceil(self.low[band] * self.num / self.den)), self._apart(band)
            m = apart // 2 + 1
            ways = [(self._cost(least, True, m, 0, apart), True, m, 0)]
            for skip in SKIPS:
                m = apart + 1 + 2 * skip
                if m <= max(1, least):
                    ways.append((self._cost(least, False, m, skip, apart), False, m, skip))
            self._ways[band] = min(ways)[1:]
        return self._ways[band]

    def keys(self, elements: np.ndarray) -> np.ndarray:
        """All keys of a set, given as hashes of its elements."""
        out = []
        for band in self.of(len(elements)):
            deletions, m, skip = self.way(band)
            whole, count, segment, own = _parts(elements, m, band)
            salt = mix(np.arange(m, dtype=_U) + _U(band << 32))
            if deletions:
                out += [mix(whole + salt), mix(whole[segment] - own + salt[segment])]
                empty, held = np.flatnonzero(count <= 1), count > 0
                if m > 1 and len(empty):  # without any element, or without the only one
                    out[-2], out[-1] = out[-2][held], out[-1][count[segment] > 1]
            else:
                pick = np.argsort(count, kind="stable")[skip:]
                empty = pick[count[pick] == 0] if m > 1 else pick[:0]
                if len(empty):
                    pick = pick[count[pick] > 0]
                out.append(mix(whole[pick] + salt[pick]))
            if m > 1 and len(empty):
                least = max(1, math.ceil(self.low[band] * self.num / self.den))
                _, deletions, m, skip = _second(least, self._apart(band))
                whole, count, segment, own = _parts(elements, m, band + (1 << 20))
                salt = mix(np.arange(m, dtype=_U) + _U(band << 32) + _U(1 << 60))
                if deletions:
                    second = np.concatenate([mix(whole + salt), mix(whole[segment] - own + salt[segment])])
                else:
                    pick = np.argsort(count, kind="stable")[skip:]
                    second = mix(whole[pick] + salt[pick])
                out += [mix(second ^ tag) for tag in mix(empty.astype(_U) + _U(0xE3779))]
        # 48 bits are shuffled in less room; keys that are equal by chance cost a comparison, never a link
        return np.unique(np.concatenate(out) >> _U(16)) if out else np.zeros(0, _U)


def _parts(elements: np.ndarray, m: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sum and number of the elements of each of m segments; each element's segment and number in the sums."""
    own = mix(elements ^ _U(0xA5A5A5A5 + salt))
    segment = (((own >> _U(32)) * _U(m)) >> _U(32)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(own[order], dtype=_U)])
    edge = np.searchsorted(segment[order], np.arange(m + 1))
    return sums[edge[1:]] - sums[edge[:-1]], np.diff(edge), segment, own


@lru_cache(1 << 16)
def _second(n: int, apart: int) -> tuple[float, bool, int, int]:
    """(cost, deletions, segments, subsets left out) of the second partition for sets of n elements or more."""
    m = apart // 2 + 1
    ways = [(m + n + EMPTY_COST * (m > 1) * m * math.exp(-n / m) * (1 + n / m), True, m, 0)]
    for skip in SKIPS:
        m = apart + 1 + 2 * skip
        if m <= max(1, n):
            ways.append((m - skip + EMPTY_COST * (m > 1) * _beyond(m * math.exp(-n / m), skip), False, m, skip))
    return min(ways)


@lru_cache
def _beyond(mean: float, skip: int) -> float:
    """Expected number beyond skip of a Poisson number."""
    p, total = math.exp(-min(mean, 700)), 0.0
    for k in range(skip):
        total += (skip - k) * p
        p *= mean / (k + 1)
    return mean - skip + total


def _sets(texts: list[bytes | None], n: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct n-grams."""
    w = words_of(texts, lower=True)
    h = w.hashes()
    g, _ = w.grams(n, h)
    edge = w.first().tolist()
    sets = []
    for a, b in zip(edge, edge[1:], strict=False):
        if b - a >= n:
            sets.append(np.unique(g[a : b - n + 1]))
        elif b > a:
            short = np.zeros(1, _U)
            for x in h[a:b]:
                short = mix(short * _U(31) + x)
            sets.append(short + _U(b - a))
        else:
            sets.append(np.zeros(0, _U))
    return sets


def _node(elements: np.ndarray) -> int:
    """A number for the set; equal sets have equal numbers."""
    total = np.array([mix(elements).sum(dtype=_U)], _U)
    return int(mix(total + _U(len(elements))).view(np.int64)[0])


def _sketch(elements: np.ndarray) -> np.ndarray:
    """Parities of the numbers of elements in at least twice as many cells as elements.

    Two sets that differ in d elements have sketches that differ in d bits at most. A sketch of
    half the cells is the exclusive or of both halves."""
    cells = max(64, 1 << int(2 * len(elements) - 1).bit_length())
    odd = np.bincount((mix(elements + _U(0x5E7)) & _U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _facts(n: int):
    """row, node, size and sketch of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for rows, texts in row_chunks(batches, "text", CHUNK_BYTES):
            sets = _sets(texts, n)
            sketches = [_sketch(s) if len(s) else np.zeros(0, np.int64) for s in sets]
            cut = np.cumsum([0, *map(len, sketches)])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([_node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(np.concatenate(sketches)))],
                names=["row", "node", "size", "sketch"],
            )

    return run


def _keys(n: int, bands: Bands):
    """(key, node) for each key of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for _, texts in row_chunks(batches, "text", CHUNK_BYTES):
            sets = [s for s in _sets(texts, n) if len(s)]
            keys = [bands.keys(s) for s in sets]
            if keys:
                node = np.repeat(np.array([_node(s) for s in sets], np.int64), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(node)], names=["key", "node"])

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (key, node) sorted by key and node: each other node of a key with the key's
    first one. Holds one row between batches."""
    drop_kept()
    held = None
    for batch in batches:
        key, node = (c.to_numpy() for c in batch.columns)
        if held:
            key, node = np.concatenate([[held[0]], key]), np.concatenate([[held[1]], node])
        if not len(key):
            continue
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        other = node != node[first]
        held = (key[-1], node[first[-1]])
        if other.any():
            yield pa.RecordBatch.from_arrays([pa.array(node[first[other]]), pa.array(node[other])], names=["a", "b"])


def _apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bits in which each left sketch differs from each right one of the same length."""
    # numpy counts the bits of a signed number's absolute value
    return np.bitwise_count((left[:, None, :] ^ right[None, :, :]).view(_U)).sum(axis=2, dtype=np.int32)


def _near(num: int, den: int, best_only: bool):
    """Of one tile: pairs of nodes of different groups whose sketches allow the similarity; with
    best_only for each node only the closest other."""

    def run(tile: pa.Table) -> pa.Table:
        drop_kept()
        node, root, size = (tile[c].to_numpy() for c in ("node", "root", "size"))
        side = tile["side"].to_numpy()
        sketch = tile["sketch"].combine_chunks()
        length = sketch.value_lengths().to_numpy()
        flat, begin = sketch.flatten().to_numpy(), np.concatenate([[0], np.cumsum(length)])
        stacked = {int(x): np.flatnonzero(length == x) for x in np.unique(length)}
        table = {x: flat[(begin[at][:, None] + np.arange(x)[None, :])] for x, at in stacked.items()}
        found = []
        for x in stacked:
            for y in (x, 2 * x):
                if y not in stacked:
                    continue
                right = table[y] if y == x else table[y][:, :x] ^ table[y][:, x:]
                step = max(1, (1 << 20) // (len(right) * x))
                for k in range(0, len(table[x]), step):
                    i, j = stacked[x][k : k + step], stacked[y]
                    both = size[i][:, None] + size[j][None, :]
                    far = _apart(table[x][k : k + step], right)
                    ok = (root[i][:, None] != root[j][None, :]) & (far <= (den - num) * both // (den + num))
                    ok &= den * np.minimum(size[i][:, None], size[j][None, :]) >= num * np.maximum(size[i][:, None], size[j][None, :])
                    # two blocks meet here: a pair inside one block is that block's own tile's
                    ok &= (side[i][:, None] != side[j][None, :]) | (side[i][:, None] < 0)
                    p, q = np.nonzero(ok)
                    found.append((i[p], j[q], far[p, q]))
        i, j, far = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3
        if best_only and len(i):
            ends, twice, many = np.concatenate([i, j]), np.concatenate([np.arange(len(i))] * 2), np.concatenate([far, far])
            order = np.lexsort((twice, many, ends))
            pick = np.unique(twice[order][np.unique(ends[order], return_index=True)[1]])
            i, j = i[pick], j[pick]
        return pa.table({"a": pa.array(np.minimum(node[i], node[j]), pa.int64()), "b": pa.array(np.maximum(node[i], node[j]), pa.int64())})

    return run


def _exact(n: int, num: int, den: int):
    """Of rows (a, b, x, y) with texts x and y: the pairs that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        last: tuple = (None, None)
        for rows, right in row_chunks(batches, "y", CHUNK_BYTES):
            left = rows.column(2).cast(pa.binary()).to_pylist()
            many = _sets(right, n)
            keep = []
            for k, (x, b) in enumerate(zip(left, many, strict=True)):
                if x != last[0]:
                    last = (x, _sets([x], n)[0])
                a = last[1]
                common = len(np.intersect1d(a, b, assume_unique=True))
                if den * common >= num * (len(a) + len(b) - common):
                    keep.append(k)
            if keep:
                at = pa.array(keep)
                yield pa.RecordBatch.from_arrays([rows.column(0).take(at), rows.column(1).take(at)], names=["a", "b"])

    return run


def similar_sets(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of docs: the id, row_key, n_shingles, component_id and component.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a set holds the distinct
    n-grams of words, or the whole sequence when there are fewer words. Two rows are linked when
    den * intersection >= num * union; num / den is 0.5 at least. n-grams, and equal sets, are told apart by 64-bit hashes.
    component_id is the smallest id reachable over links (null ids only when there is no other);
    component is the same for all rows of a group. Null and empty texts have no n-grams and no
    links: they are groups of their own. Rows repeated with the same id and text stay rows of one
    group. Other columns are ignored. An empty table gives no rows.

    Rows of equal sets are one node. No group is ever paired out:
    1. Each node that shares a key meets the key's first node only. Sketches that differ in too many
       bits rule pairs out without loss; the others are checked on their texts. Links give groups.
    2. Nodes that met the same first node form a neighbourhood: any two nodes that share a key are in
       one. In blocks, sketches of nodes of different groups are compared, and each node's closest
       is checked, as long as that finds links.
    3. At last every pair of different groups whose sketches allow the similarity is checked.
    """
    if 2 * num < den:
        raise ValueError("sketches tell sets apart from a similarity of 0.5 on")
    spark = docs.sparkSession
    small_batches(spark)
    bands = Bands(num, den)
    source = docs.select(row_key(id_column, text_column).alias("row"), F.col(text_column).alias("text"))
    info = materialize(source.mapInArrow(_facts(n), "row long, node long, size long, sketch array<bigint>"), "sets")
    # equal sets have equal keys: one row of each node sends them
    single = materialize(info.where("size > 0").groupBy("node").agg(F.min("row").alias("row")), "single")
    few, sole = single.count() <= MOST_SENT, single.select("row")
    sending = source.join(F.broadcast(sole) if few else sole, "row", "left_semi")
    keyed = sending.select("text").mapInArrow(_keys(n, bands), "key long, node long").repartition("key").sortWithinPartitions("key", "node")
    stars = materialize(keyed.mapInArrow(_stars, "a long, b long").distinct(), "stars")
    del keyed
    free_shuffles(spark)  # the keys are the largest shuffle
    nodes = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct()
    known = single.join(nodes, "node", "left_semi").join(info.dropDuplicates(["row"]).select("row", "size", "sketch"), "row")
    members = materialize(known.select("node", "row", "size", "sketch"), "members")

    def exact(pairs: DataFrame) -> DataFrame:
        """The pairs that are similar enough; only texts of nodes that sketches leave over are read again."""
        asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = materialize(asked.join(members.select("node", "row"), "node"), "wanted")
        sent = F.broadcast(wanted) if wanted.count() <= MOST_SENT else wanted
        texts = materialize(source.join(sent, "row").dropDuplicates(["row"]).select("node", "text"), "texts")
        one, two = (texts.select(F.col("node").alias(k), F.col("text").alias(t)) for k, t in (("a", "x"), ("b", "y")))
        both = pairs.join(two, "b").join(one, "a").select("a", "b", "x", "y")
        return materialize(both.mapInArrow(_exact(n, num, den), "a long, b long"), "links")

    def told(side: str) -> DataFrame:
        return members.select(F.col("node").alias(side), F.col("size").alias(f"size_{side}"), F.col("sketch").alias(f"sketch_{side}"))

    met = stars.join(told("b"), "b").join(told("a"), "a")
    halved = [F.when(F.size(f"sketch_{x}") > F.size(f"sketch_{y}"), _folded(F.col(f"sketch_{x}"))).otherwise(F.col(f"sketch_{x}")) for x, y in ("ab", "ba")]
    apart = F.aggregate(F.zip_with(*halved, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    fits = (den * F.least("size_a", "size_b") >= num * F.greatest("size_a", "size_b")) & (apart <= F.floor((den - num) * (F.col("size_a") + F.col("size_b")) / (den + num)))
    checked = materialize(met.where(fits).select("a", "b"), "checked")
    links = [exact(checked)]
    groups = components(links[0])
    free_shuffles(spark)
    around = stars.select("a", F.col("b").alias("node")).unionByName(stars.select("a", F.col("a").alias("node")).distinct()).join(members.drop("row"), "node")

    def close(best_only: bool) -> DataFrame:
        rooted = around.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = rooted.groupBy("a").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        blocks = mixed.select("a", F.ceil(F.col("n") / TILE_NODES).alias("blocks"))
        own = rooted.join(blocks, "a").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
        tiles = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        tiles = tiles.select("a", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "root", "size", "sketch", F.when(F.col("own") == F.col("other"), -1).otherwise(F.when(F.col("own") < F.col("other"), 0).otherwise(1)).alias("side"))
        pairs = tiles.groupBy("a", "i", "j").applyInArrow(_near(num, den, best_only), "a long, b long").distinct()
        done = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return materialize(pairs.join(done, ["a", "b"], "left_anti"), "close")

    for best_only in (True, False):
        while True:
            pairs = close(best_only)
            free_shuffles(spark)  # a round's tiles are not needed again
            more = None if pairs.isEmpty() else exact(pairs)
            checked = checked.unionByName(pairs)
            if more is None or more.isEmpty():
                break
            links.append(more)
            groups = components(reduce(DataFrame.unionByName, links))
            free_shuffles(spark)
            if not best_only:
                break
    # Ids and groups meet on nodes, each once; rows are joined to their node last, and spread there.
    ids = docs.select(F.col(id_column), row_key(id_column, text_column).alias("row_key"))
    told_of = info.select(F.col("row").alias("row_key"), F.col("size").alias("n_shingles"), "node").dropDuplicates(["row_key"])
    placed = materialize(ids.join(told_of, "row_key"), "placed")
    alone = placed.where("n_shingles = 0").withColumns({"component_id": F.col(id_column), "component": F.col("row_key")})
    least = placed.where("n_shingles > 0").groupBy("node").agg(F.min(id_column).alias("id"))
    rooted = least.join(groups, "node", "left").withColumn("component", F.coalesce("root", "node"))
    smallest = rooted.groupBy("component").agg(F.min("id").alias("component_id"))
    of_node = materialize(rooted.select("node", "component").join(smallest, "component"), "components")
    rest = lookup_join(placed.where("n_shingles > 0"), of_node, ["node"])
    names = [id_column, "row_key", "n_shingles", "component_id", "component"]
    return rest.select(*names).unionByName(alone.select(*names))


def _folded(sketch: Column) -> Column:
    half = (F.size(sketch) / 2).cast("int")
    return F.zip_with(F.slice(sketch, F.lit(1), half), F.slice(sketch, half + 1, half), lambda x, y: x.bitwiseXOR(y))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs with one row of each group of similar_sets: that with the smallest id. Rows repeated
    with the same id and text are one. All columns stay; rows without words all stay."""
    found = similar_sets(docs, n, num, den, id_column, text_column)
    best = found.groupBy("component").agg(F.min(F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), "row_key")).alias("best")).select(F.col("best.row_key").alias("_kept"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_key(id_column, text_column).alias("_own"))
    return own.join(best, F.col("_own") == F.col("_kept"), "left_semi").groupBy("_own").agg(F.any_value("doc").alias("doc")).select("doc.*")
