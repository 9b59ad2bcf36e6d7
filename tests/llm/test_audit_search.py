"""The filter audit and the lexical search against plain versions, and their odd rows."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from finloom.llm import audit, lexical, queries

SF = "/root/testdata/sf0.001"
WORD, TERM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

AUDITED = "doc_id long, text string, lang string, PART string, mask int, rows string"


def long_text(rng, n, words=40):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def audited():
    rng = random.Random(5)
    rows = []
    for k in range(120):
        kind = k % 6
        text = [None, "", long_text(rng, 120, 4000), long_text(rng, 110, 20), "SHOUTING " * 30, f"tag #{k % 9}"][kind]
        rows.append((k, text, ["en", None, "", "de"][rng.randrange(4)], "x", 1, "y"))
    rows += [(200 + k, "the copied text", "en" if k % 2 else None, None, None, None) for k in range(60)]
    rows += [(200, "the copied text", "fr", None, None, None), (200, "the copied text", "en", None, None, None)]
    rows += [(None, "the copied text", "en", None, None, None), (None, None, None, None, None, None)]
    rows += [(300, "A" * 300_000 + " b", "long", None, None, None), (301, "w " * 100_000, "long", None, None, None)]
    labels = [(k, k % 2, int(k % 5 == 0), "z") for k in range(0, 260, 3)] + [(0, 1, 0, "z"), (201, None, 1, "z"), (None, 1, 1, "z")]
    return rows, labels


def plain_audit(rows, labels):
    first, good, toxic = {}, {d for d, q, _, _ in labels if q == 1}, {d for d, _, t, _ in labels if t == 1}
    for d, text, *_ in rows:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    parts = {}
    for d, text, lang, *_ in rows:
        t = text or ""
        words = WORD.findall(t)
        fails = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), any(c in "#$%&*|" for c in t), d is not None and d > first[t]]
        parts.setdefault(lang or "", []).append((fails, d is not None and d in good, d is not None and d in toxic))
    out = []
    for part, docs in parts.items():
        steps, shapley = [], Counter()
        for order in permutations(range(5)):
            left = docs
            for k, v in enumerate(order):
                gone, kept = [x for x in left if x[0][v]], [x for x in left if not x[0][v]]
                shapley[v] += len(gone)
                steps.append((part, order, k + 1, v, len(kept), len(gone), sum(x[0][v] for x in docs) - len(gone), sum(x[0][v] and sum(x[0]) == 1 for x in docs), sum(x[1] for x in gone), sum(x[2] for x in gone)))
                left = kept
        out += [(p, "".join("ABCDE"[v] for v in o), k, *rest, shapley[v]) for p, o, k, v, *rest in steps]
    return out


def test_audit_equals_plain_filtering(spark, audited):
    rows, labels = audited
    docs = spark.createDataFrame(rows, AUDITED).repartition(5)
    masks = audit.failure_masks(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"))
    got = [tuple(r) for r in audit.audit(masks).collect()]
    assert len(got) == 600 * len({r[2] or "" for r in rows}) and sorted(got) == sorted(plain_audit(rows, labels))


def test_audit_of_empty_tables(spark, audited):
    rows, labels = audited
    docs, marks = spark.createDataFrame(rows, AUDITED), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    assert audit.audit(audit.failure_masks(docs.limit(0), marks)).count() == 0
    none = audit.audit(audit.failure_masks(docs, marks.limit(0))).select("kept", "good_lost", "toxic_lost").collect()
    assert none and not any(r.good_lost or r.toxic_lost for r in none)


def test_swaps_reach_every_order_and_keep_weights():
    rng = random.Random(3)
    masks = {m: (rng.randrange(1, 50), rng.randrange(5), rng.randrange(5)) for m in rng.sample(range(32), 20)}
    diagram = audit.Diagram(masks, 5)
    whole, seen = diagram.weight(diagram.root), {tuple(diagram.order)}
    for level in audit.adjacent_orders(5):
        diagram.swap(level)
        seen.add(tuple(diagram.order))
        fresh = audit.Diagram.__new__(audit.Diagram)
        fresh.order, fresh.zero, fresh.nodes = list(diagram.order), diagram.zero, {}
        fresh.root = fresh._build(masks, 0)
        assert diagram.weight(diagram.root) == whole and diagram.all_pass() == fresh.all_pass()
    assert len(seen) == 120


def plain_search(docs, items, k):
    found = [(d, Counter(lower(t))) for d, t in docs]
    found = [(d, c, sum(c.values())) for d, c in found if c]
    n_docs, all_terms = len(found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in found:
            m = 25 + 75 * n * n_docs // all_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in lower(text) if t in c)
            scored += [(-s, d is None, d or 0)] if s > 0 else []
        out += [(item, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def lower(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


@pytest.mark.parametrize("block_bytes", [1, 4 << 20])
def test_search_equals_plain_scores(spark, block_bytes):
    rng = random.Random(8)
    words = ["the", "The", "a", "É", "é", "naïve", "x1", "under_score", "don't", "日本", "a-b", "THE.", "1"]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for k in range(150)]
    docs += [(None, "the naïve x1"), (500, None), (501, ""), (502, "--- \n"), (503, "a " * 50_000 + "日本"), (7, "the the"), (7, "the the"), (-4, "unique\x7fterm\x00x1")]
    items = [(1, "The naïve under score"), (2, "x1 x1 x1 日本"), (3, None), (4, "..."), (5, "absent words"), (None, "unique term"), (1, "The naïve under score"), (9, "é É don t")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, rank string, score int").repartition(6)
    asked = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, doc_id int")
    got = [tuple(r) for r in lexical.search(frame, asked, block_bytes=block_bytes).collect()]
    assert sorted(got, key=repr) == sorted(plain_search(docs, items, 10), key=repr)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0))):
        got = lexical.search(d, i)
        assert got.columns == ["item", "rank", "doc", "score"] and got.count() == 0


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_lexical_search"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
