"""Personal data: the fixed patterns against plain regular expressions, the field against held-out rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from finloom.llm import private, queries

SF = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checksum(digits):
    total = 0
    for k, d in enumerate(reversed([int(c) for c in digits])):
        total += d if k % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 16 <= len(digits) <= 19 and checksum(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_fixed_patterns_equal_plain_expressions():
    rng = random.Random(2)
    pieces = ["a", "Z", "@", ".", "1", "25", "256", "0", "-", " ", "+", "(", ")", "_", "é", "日", "\n", "4111111111111111", "a@b.c", "10.0.0.1", "+1 (234) 555-0101", "%", "x.y@m-1.example.com"]
    for _ in range(30_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert [(private.KINDS[k], a, b) for k, a, b in private.base_spans(text)] == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 400_000, "a" * 400_000 + "@", "1." * 200_000, "+1" + "(" * 400_000, "1 " * 200_000, "@a" * 200_000, "+1 " * 100_000):
        spans = private.base_spans(text)
        assert len(list(private.chains(text))) <= 1 and all(k == 1 for k, *_ in spans)


def test_viterbi_and_gradient_equal_enumeration():
    rng = np.random.default_rng(4)
    field = private.Field(rng.normal(size=(1 << private.BITS, private.LABELS)), rng.normal(size=(private.LABELS, private.LABELS)))
    shapes = private.Shapes()
    tokens = [private._tokens(t, shapes)[0] for t in ("call +1 (2", "a @ b", "x", "1.2")]
    tokens.sort(key=lambda c: -len(c))
    batch = private.Batch.of(tokens)
    best, emit = field.decode(batch), field.scores(batch)

    def paths(n):
        ways = [[k] for k in range(private.LABELS) if k == 0 or k % 2 == 1]
        for _ in range(n - 1):
            ways = [[*w, k] for w in ways for k in range(private.LABELS) if k == 0 or k % 2 == 1 or w[-1] in (k, k - 1)]
        return ways

    for begin, size in zip(batch.begin, batch.size):
        if size > 5:
            continue
        total = {tuple(w): sum(emit[begin + k, x] for k, x in enumerate(w)) + sum(field.pairs[a, b] for a, b in zip(w, w[1:])) for w in paths(size)}
        assert tuple(best[begin : begin + size]) == max(total, key=total.get)

    labels = np.zeros(len(emit), np.int64)
    _, moved = field.gradient(batch, labels)

    def loss(pairs):
        out = 0.0
        for begin, size in zip(batch.begin, batch.size):
            one = private.Batch.of([[t for t in tokens[list(batch.begin).index(begin)]]])
            e = private.Field(field.weights, pairs).scores(one)
            a = e[0] + private._START
            for t in range(1, size):
                a = private._logsum(a[:, None] + pairs + private._BARRED, 0) + e[t]
            out += private._logsum(a, 0) - e[:, 0].sum() - (size - 1) * pairs[0, 0]
        return out

    for a, b in ((0, 0), (0, 3), (3, 4), (4, 0)):
        step = np.zeros_like(field.pairs)
        step[a, b] = 1e-5
        assert abs((loss(field.pairs + step) - loss(field.pairs - step)) / 2e-5 - moved[a, b]) < 1e-4


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 2 = 0")
    return private.train(private.labelled_chains(docs))


def found(spark, field, texts):
    rows = private.find_private(spark.createDataFrame([(t,) for t in texts], "text string"), field).collect()
    return [[(s.kind, (r.text or "")[s.start : s.end], s.base) for s in r.private] for r in rows]


def test_field_finds_what_the_patterns_miss_on_unseen_rows(spark, trained):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 2 = 1").select("text")
    wanted = hits = wrong = 0
    for r in private.find_private(docs, private.Field(trained.weights, trained.pairs)).collect():
        spans = {(s.kind, s.start, s.end) for s in r.private if s.base}
        decoded = private._decoded([r.text], trained, private.Shapes())[0]
        got = {(private.KINDS[k], a, b) for k, a, b in decoded if private.plausible(k, r.text[a:b])}
        wanted, hits, wrong = wanted + len(spans), hits + len(spans & got), wrong + len([g for g in got - spans if not any(g[1] < e and g[2] > s for _, s, e in spans)])
    assert wanted > 200 and hits >= 0.97 * wanted and wrong <= 0.02 * wanted


def test_other_forms(spark, trained):
    got = found(spark, trained, ["call (377) 555-0271 now", "number 7536784127813050 4845168114407329 is", "+1 (826) 555-4081 190.137.223.204 du", 'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"', "on 2024-03-05 at 10:30, 5,000 items", "4736962573099582 is no card"])
    assert got[0] == [("phone", "(377) 555-0271", False)]
    assert {x for x in got[1]} == {("card", d, False) for d in ("7536784127813050", "4845168114407329") if checksum(d)}
    assert ("phone", "+1 (826) 555-4081", False) in got[2] and ("ip", "190.137.223.204", True) in got[2]
    assert got[3:] == [[], [], []]


def test_odd_rows_and_tables(spark, trained):
    rows = [(1, None, "x"), (1, None, "x"), (2, "", "x"), (None, "a@b.c é 10.0.0.1", "x"), (3, "é" * 200_000 + " a@b.c", "x"), (4, "7 " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Private string")
    got = private.find_private(docs, trained).collect()
    assert got[0].__fields__ == ["doc_id", "text", "private"] and len(got) == 6
    spans = [[tuple(s) for s in r.private] for r in got]
    assert spans[:3] == [[], [], []] and spans[3] == [("email", 0, 5, True), ("ip", 8, 16, True)] and spans[4] == [("email", 200_001, 200_006, True)]
    assert private.find_private(docs.limit(0), trained).count() == 0
    none = private.train(private.labelled_chains(docs.limit(0)))
    assert found(spark, none, ["a@b.c call (377) 555-0271"]) == [[("email", "a@b.c", True)]]


def test_query_equals_plain_expressions(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op11_private_data"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        want = plain(docs[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, *_ in want) for x in private.KINDS]
        assert set(listed.split(",")) - {""} <= set(r.spans.split(","))


def test_long_chains_decode_in_windows_as_in_one(trained, monkeypatch):
    rng = random.Random(9)
    parts = ["(377) 555-0271", "10.0.0[.]1", "a.b (at) c.example.com", "12 34", "word", "7536784127813050 4845168114407329", "+1 (826) 555-4081 190.137.223.204"]
    text = " ".join(rng.choice(parts) for _ in range(3000))
    whole = private._decoded([text], trained, private.Shapes())
    monkeypatch.setattr(private, "CHAIN_TOKENS", 700)
    assert private._decoded([text], trained, private.Shapes()) == whole and len(whole[0]) > 1000
    assert private._decoded([text, "", "call (377) 555-0271"], trained, private.Shapes())[0] == whole[0]
