"""How filters interact: what each removes in every order, read off count-weighted decision diagrams."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the word pattern's separators.
GAP = r"[\x20\x09-\x0D]+"

#: Columns of the masks: rows, rows of good quality, toxic rows.
WEIGHTS = ("rows", "good", "toxic")

STEPS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions on one text alone under which filters A to D fail."""
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "lang") -> DataFrame:
    """part, mask and the weights of WEIGHTS: how many rows of each part fail exactly the filters of mask.

    Bit k of mask is filter "ABCDE"[k]. A null text is empty, a null part the empty string. E fails
    for a row whose text some row with a smaller id has too; a row without an id neither fails E
    nor makes others fail, and rows that repeat an id and text fail or pass together. Quality and
    toxicity of an id that is labelled more than once are its largest; rows without an id or a
    label have none. Other columns, of any name, are not read.

    Rows become (id, SHA-256 of the text, part, mask) with a count before the first shuffle, so
    copies travel once. The first holder of a text is one aggregate, and is joined back by text
    and id together: a text that fills a third of the table is no key of its own anywhere.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_failures(F.col("text")).values())), F.lit(0))
    counted = rows.select("id", "part", F.unhex(F.sha2(F.col("text"), 256)).alias("digest"), mask.alias("mask")).groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("rows"))
    first = counted.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    known = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    repeats = (F.col("id").isNotNull() & F.col("first").isNull()).cast("int")
    marked = counted.join(first, ["id", "digest"], "left").select("id", "part", "rows", (F.col("mask") + 16 * repeats).alias("mask"))
    unlabelled = marked.where("id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})  # kept out of the join: one key
    weighed = marked.where("id IS NOT NULL").join(known, "id", "left").unionByName(unlabelled)
    return weighed.groupBy("part", "mask").agg(F.sum("rows").alias("rows"), *[F.sum(F.when(F.col(c), F.col("rows")).otherwise(0)).alias(c) for c in WEIGHTS[1:]])


class Diagram:
    """A quasi-reduced decision diagram of failure masks, each path to a leaf weighted with its rows.

    Level k branches on filter order[k]: low is pass, high is fail. Equal subdiagrams are one node,
    the empty one is None. A node holds (low, high, weight), its weight being the sum of both.
    """

    def __init__(self, masks: dict[int, tuple[int, ...]], size: int):
        self.order = list(range(size))
        self.zero = (0,) * len(WEIGHTS)
        self.nodes: dict[tuple, tuple] = {}
        self.root = self._build(masks, 0)

    def _build(self, masks: dict[int, tuple[int, ...]], level: int):
        if not masks:
            return None
        if level == len(self.order):
            return self.node(None, None, next(iter(masks.values())))
        bit = 1 << self.order[level]
        sides = [{m: w for m, w in masks.items() if bool(m & bit) == fails} for fails in (False, True)]
        return self.node(*[self._build(s, level + 1) for s in sides])

    def weight(self, node) -> tuple[int, ...]:
        return node[2] if node else self.zero

    def node(self, low, high, leaf: tuple[int, ...] | None = None):
        if leaf is None and low is None and high is None:
            return None
        made = (low, high, leaf or tuple(a + b for a, b in zip(self.weight(low), self.weight(high), strict=True)))
        return self.nodes.setdefault((id(low), id(high), made[2]), made)

    def swap(self, level: int) -> None:
        """Exchange the filters of two neighbouring levels; all other levels keep their nodes."""

        def side(node, k: int):
            return node[k] if node else None

        def exchange(node):
            if node is None:
                return None
            low, high = node[:2]
            return self.node(self.node(side(low, 0), side(high, 0)), self.node(side(low, 1), side(high, 1)))

        def down(node, depth: int):
            if node is None:
                return None
            return exchange(node) if depth == level else self.node(down(node[0], depth + 1), down(node[1], depth + 1))

        self.root = down(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
        """Along the path on which nothing has failed yet: weight kept and weight removed at each level."""
        out, node = [], self.root
        for _ in self.order:
            low, high = (node[0], node[1]) if node else (None, None)
            out.append((self.weight(low), self.weight(high)))
            node = low
        return out

    def fails_only(self, level: int) -> int:
        node = self.root
        for k in range(len(self.order)):
            node = node[int(k == level)] if node else None
        return self.weight(node)[0]


def adjacent_orders(size: int) -> list[int]:
    """Levels to swap with the next, one after another, so that every order comes up once."""
    if size < 2:
        return []
    inner, out = adjacent_orders(size - 1), []
    for k in range(len(inner) + 1):  # the last filter sweeps through each order of the others
        sweep = range(size - 2, -1, -1) if k % 2 == 0 else range(size - 1)
        out += sweep
        if k < len(inner):
            out.append(inner[k] + (k % 2 == 0))
    return out


def audit_masks(masks: dict[int, tuple[int, ...]], names: Sequence[str]) -> list[tuple]:
    """filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    size = len(names)
    diagram = Diagram(masks, size)
    paths = [(tuple(diagram.order), diagram.all_pass())]
    alone = {v: diagram.fails_only(k) for k, v in enumerate(diagram.order)}
    for level in adjacent_orders(size):
        diagram.swap(level)
        paths.append((tuple(diagram.order), diagram.all_pass()))
    fails = {order[0]: path[0][1][0] for order, path in paths}
    shares = dict.fromkeys(range(size), 0)
    for order, path in paths:
        for v, (_, removed) in zip(order, path, strict=True):
            shares[v] += removed[0]
    return [
        ("".join(names[v] for v in order), k + 1, kept[0], gone[0], fails[v] - gone[0], alone[v], gone[1], gone[2], shares[v])
        for order, path in paths
        for k, (v, (kept, gone)) in enumerate(zip(order, path, strict=True))
    ]


def audit(masks: DataFrame, names: str = "ABCDE") -> DataFrame:
    """The rows of STEPS for every part of masks (part, mask, WEIGHTS): each order of the filters, each step.

    A part's masks are at most 2^filters rows, and its diagram is built once and re-ordered by
    swaps of neighbouring levels. Parts without rows do not show; an empty table gives none.
    """

    def steps(table: pd.DataFrame) -> pd.DataFrame:
        weights = {int(m): tuple(map(int, w)) for m, *w in table[["mask", *WEIGHTS]].itertuples(index=False)}
        return pd.DataFrame([(table["part"].iloc[0], *row) for row in audit_masks(weights, names)], columns=[c.split()[0] for c in STEPS.split(", ")])

    return masks.groupBy("part").applyInPandas(steps, STEPS)


AUDIT_SQL = """
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce("text", '') AS t FROM documents
), w AS (
    SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d
), l AS (
    SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
), f AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
        len(words) < 100,
        100 * len(list_distinct(words)) < 80 * len(words),
        100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
        regexp_matches(t, '[#$%&*|]'),
        coalesce(doc_id > first, false)] AS fails
    FROM w LEFT JOIN l USING (doc_id)
), g AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), x AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
o AS (
    SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM x a, x b, x c, x d, x e
    WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
), s AS (
    SELECT o.o, x.k AS step, o.o[x.k] AS v, o.o[:x.k - 1] AS earlier FROM o, x
), c AS (
    SELECT g.part, s.o, s.step, s.v,
        sum(CASE WHEN NOT before AND NOT fails[v] THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN NOT before AND fails[v] THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN before AND fails[v] THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails[v] AND fail_count = 1 THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN NOT before AND fails[v] THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN NOT before AND fails[v] THEN toxic ELSE 0 END) AS toxic_lost
    FROM s, (SELECT *, len(list_filter(fails, lambda y: y)) AS fail_count FROM g) g,
        LATERAL (SELECT len(list_filter(earlier, lambda e: fails[e])) > 0 AS before)
    GROUP BY ALL
)
SELECT part, array_to_string(list_transform(o, lambda e: substr('ABCDE', e, 1)), '') AS filter_order, CAST(step AS INT) AS step,
    CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
    CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, v) AS BIGINT) AS shapley
FROM c
"""
