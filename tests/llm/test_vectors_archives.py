"""Nearest vectors, archives and url verdicts against brute force."""

import base64
import hashlib
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from finloom.llm import neighbours, urls, warc
from finloom.llm.queries import URL_RULES


def cosine(a, b):
    total = na = nb = 0.0
    for x, y in zip(a, b, strict=True):
        total += x * y
        na += x * x
        nb += y * y
    return total / (math.sqrt(na) * math.sqrt(nb))


def search(rows, k, every):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = []
    for i, v in good:
        if i % every == 0:
            near = sorted((-cosine(v, w), j) for j, w in good if j != i and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("numbers", [1 << 19, 64])
def test_neighbours_are_those_of_all_pairs(spark, numbers, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_NUMBERS", numbers)
    rng = random.Random(4)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(6)]) for k in range(60)]
    rows += [(100 + k, rows[10][1]) for k in range(30)] + [(200 + k, [2 * x for x in rows[20][1]]) for k in range(5)]
    rows += [(300, None), (310, []), (320, [0.0] * 6), (330, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (340, [float("nan")] + [1.0] * 5), (350, [float("inf")] + [1.0] * 5)]
    rows += [(400, [1.0, 2.0]), (410, [2.0, 1.0]), (None, rows[0][1]), (5, rows[5][1]), (420, [-0.0, 1.0]), (430, [0.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.nearest(frame, F.col("vec_id") % 10 == 0, k=5).collect())
    want = search(rows, 5, 10)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(g[3] == w[3] for g, w in zip(got, want, strict=True))
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert neighbours.nearest(frame, F.lit(False)).count() == 0


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def pages(rng, n=80):
    """Pages with copies, empty and null ones, magic and whole records inside, and bare line ends."""
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:7777>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    texts = ["<p>é</p>" * rng.randint(1, 400) for _ in range(n)]
    texts += [None, "", "", "WARC/1.1\r\n", "a\r\n\r\nWARC/1.1\r\nb\r\n\r\n" * 40, record * 3, "x" + record + "\r\n\r\n", "\r\n\r\n", "long" * 60_000 + record, texts[3], texts[3], texts[5]]
    return [(k, None if k % 11 == 3 else f"https://h/{k} a\r\nb", t) for k, t in enumerate(texts)] + [(4, "https://again", texts[4])]


@pytest.mark.parametrize("split", ["128m", "20000"])
def test_archives_come_back_whole(spark, tmp_path, split):
    rows = pages(random.Random(3))
    frame = spark.createDataFrame([(i, u, t, "x") for i, u, t in rows], "page_id long, url string, html string, type string").repartition(3)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        warc.write_pages(frame, str(tmp_path / "w"))
        raw = b"".join(p.read_bytes() for p in (tmp_path / "w").glob("part-*"))
        got = warc.read_records(spark, str(tmp_path / "w"), payloads=True).collect()
        light = warc.read_records(spark, str(tmp_path / "w")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    same = defaultdict(list)
    for i, _, t in rows:
        same[(t or "").encode()].append(i)
    want = []
    for i, u, t in rows:
        body = (t or "").encode()
        first = max(same[body])
        kept = body if i == first else b""
        uri = u and u.replace("\r", "%0D").replace("\n", "%0A").replace(" ", "%20")
        want.append((i, "response" if i == first else "revisit", None if i == first else first, uri, digest(body), len(kept), digest(kept), kept))
    own = [(r.page_id, r.type, r.refers_to, r.uri, r.digest, r.payload_bytes, r.payload_digest) for r in got]
    assert sorted(zip(own, (bytes(r.payload) for r in got), strict=True), key=str) == sorted((((*w[:7],), w[7]) for w in want), key=str)
    assert sorted(own, key=str) == sorted(((r.page_id, r.type, r.refers_to, r.uri, r.digest, r.payload_bytes, r.payload_digest) for r in light), key=str)


def test_small_payloads_are_not_compared(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "b" * 50), (4, "u", "b" * 50), (None, "u", "b" * 50)], "page_id long, url string, html string")
    warc.write_pages(frame, str(tmp_path / "w"), least_bytes=10)
    got = sorted(((r.page_id, r.type, r.refers_to) for r in warc.read_records(spark, str(tmp_path / "w")).collect()), key=str)
    assert got == sorted([(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None), (None, "revisit", 4)], key=str)
    warc.write_pages(frame.limit(0), str(tmp_path / "none"))
    assert warc.read_records(spark, str(tmp_path / "none")).count() == 0


def test_revisits_take_the_payload_they_name(spark, tmp_path):
    rows = [(9, "u", "AAAA"), (9, "u", "BB"), (5, "u", "AAAA"), (4, "u", "BB"), (3, "u", None), (2, "u", ""), (1, "u", "é"), (None, "u", "é"), (None, "u", "none")]
    rows += [(100 + k, "u", "copied") for k in range(300)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    warc.write_pages(frame, str(tmp_path / "w"))
    got = warc.full_payloads(warc.read_records(spark, str(tmp_path / "w"))).collect()
    last = {}
    for i, _, t in rows:
        last[t or ""] = max((x for x in (i, last.get(t or "")) if x is not None), default=None)
    want = [(i, len((t or "").encode()), digest((t or "").encode()), *(("response", None) if last[t or ""] in (i, None) else ("revisit", last[t or ""]))) for i, _, t in rows]
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in got), key=str) == sorted(want, key=str)


def test_what_cannot_be_read_is_told(spark, tmp_path):
    frame = spark.createDataFrame([(k, "u", f"text {k}") for k in range(6)], "page_id long, url string, html string").coalesce(1)
    warc.write_pages(frame, str(tmp_path / "w"))
    whole = next((tmp_path / "w").glob("part-*")).read_bytes()
    assert warc.read_archives(spark, str(tmp_path / "w"))[1].count() == 0
    starts = [m for m in range(len(whole)) if whole.startswith(b"WARC/1.1", m)]
    (tmp_path / "x").mkdir()
    cut = whole[:-20]
    at = whole.index(b"\r\nContent-Length: ", starts[2])
    broken = whole[:at] + whole[at:].replace(b"Content-Length: ", b"Content-Length: 99999", 1)
    for name, data in (("cut", cut), ("broken", broken), ("other", b"no archive"), ("empty", b"")):
        (tmp_path / "x" / name).write_bytes(data)
    records, rejects = warc.read_archives(spark, str(tmp_path / "x"))
    count = {r.file.rsplit("/", 1)[1]: r["count"] for r in records.groupBy("file").count().collect()}
    assert count == {"cut": 5, "broken": 2}
    assert {(r.file.rsplit("/", 1)[1], r.at, r.bytes) for r in rejects.collect()} == {("cut", starts[5], len(cut) - starts[5]), ("broken", starts[2], len(broken) - starts[2]), ("other", 0, 10)}


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def fitting(host, path, rules):
    fits = [t for _, t in rules if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith("/" + t.split("/", 1)[1])]
    return max(fits, key=len) if fits else None


URLS = [
    None, "", "no scheme", "http://", "http://a.org", "http://a.org/", "HTTP://A.ORG/x?y#z", "http://org/", "http://xorg/", "https://example.org/es/1", "https://m.example.org/en/1",
    "https://m.example.org/en/21", "https://example.org/en/199#t", "https://x.com/fr/1", "https://x.com/fr", "https://x.com/de/1?a=b&c", "https://É.Com/fr/1", "a://b://c/d", "http://h?x/y", "http://h#x/y\nz",
]


def test_rules_and_parts_of_urls(spark):
    frame = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate([*URLS, *URLS])], "page_id long, url string, host string, verdict string")
    got = {(r.page_id, r.host, r.path, r.rule) for r in urls.judge(frame, URL_RULES).collect()}
    assert got == {(k, *parse(u), fitting(*parse(u), URL_RULES)) for k, u in enumerate([*URLS, *URLS])}
    assert urls.judge(frame.limit(0), URL_RULES).count() == 0
    verdicts = {r.verdict for r in urls.judge(frame, ()).collect()}
    assert verdicts == {"allow"}


def test_mined_rules_are_the_confident_frequent_sets(spark):
    rng = random.Random(8)
    rows = []
    for k in range(400):
        lang, site = rng.choice(["de", "en", "fr"]), rng.choice(["shop", "news"])
        bad = (lang == "de" and site == "shop") or rng.random() < 0.02
        rows.append((f"https://{site}.example.com/{lang}/{'a' * rng.randint(1, 9)}{k}", "block" if bad else "allow"))
    labelled = spark.createDataFrame(rows, "url string, verdict string")
    items = {tuple(r): r for r in labelled.select(urls.tokens_of(F.col("url")).alias("i"), "verdict").distinct().select(F.array_sort("i").alias("i"), "verdict").rdd.map(lambda r: (tuple(r.i), r.verdict)).collect()}
    baskets = [(set(i), v) for i, v in items]
    mined = urls.mine_rules(labelled, 0.05, 0.8).collect()
    assert mined
    for r in mined:
        have = [v for i, v in baskets if set(r.antecedent) <= i]
        sure = sum(v == r.verdict for v in have) / len(have)
        assert sure >= 0.8 and abs(sure - r.confidence) < 1e-9
        assert sum(v == r.verdict for v in have) >= 0.05 * len(baskets)
        assert r.posting in r.antecedent
    asked = spark.createDataFrame([(1, "https://shop.example.com/de/zz1"), (2, "https://news.example.com/fr/zz1"), (3, "ftp://other"), (4, None)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge(asked, (), labelled, otherwise="allow", least_support=0.05).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "allow"}
