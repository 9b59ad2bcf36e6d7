"""Context trees against the recursion written out, and toxicity on held-out labels."""

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from finloom.llm import context_tree, toxicity
from finloom.llm.words import drop_kept, id_remainder, kept

DATA = "/root/testdata/sf0.01"


def log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


def tree_scores(learn, texts, depth):
    """log10 probabilities by the definition, node by node."""

    def coded(t):
        return b"\n" * depth + b" ".join((t or "").encode().lower().split()) + b"\n"

    counts = defaultdict(lambda: [0, 0])
    for t in learn:
        s = coded(t)
        for k in range(depth, len(s)):
            for j in range(8):
                prefix, bit = (1 << j) | (s[k] >> (8 - j)), (s[k] >> (7 - j)) & 1
                for d in range(depth + 1):
                    counts[s[k - d : k], prefix][bit] += 1
    pw, children = {}, defaultdict(list)
    for context, prefix in counts:
        if context:
            children[context[1:], prefix].append((context, prefix))
    for node in sorted(counts, key=lambda n: -len(n[0])):
        kt = log_kt(*counts[node])
        if len(node[0]) == depth:
            pw[node] = kt
        else:
            rest = sum(pw[c] for c in children[node])
            top = max(kt, rest)
            pw[node] = math.log(0.5) + top + math.log(math.exp(kt - top) + math.exp(rest - top))

    def one(context, prefix):
        mixed = None
        for d in range(depth, -1, -1):
            node = (context[depth - d :], prefix)
            if node not in counts:
                continue
            a, b = counts[node]
            own = (b + 0.5) / (a + b + 1)
            w = math.exp((math.log(0.5) if d < depth else 0) + log_kt(a, b) - pw[node])
            mixed = own if mixed is None else w * own + (1 - w) * mixed
        return 0.5 if mixed is None else mixed

    out = []
    for t in texts:
        s, total = coded(t), 0.0
        for k in range(depth, len(s)):
            for j in range(8):
                p = one(s[k - depth : k], (1 << j) | (s[k] >> (8 - j)))
                total += math.log10(p if (s[k] >> (7 - j)) & 1 else 1 - p)
        out.append(total)
    return out


def test_context_trees_follow_their_recursion(spark):
    rows = [(0, "the cat sat on the mat"), (1, "The dog sat  on\tthe log"), (2, "unseen zebra words"), (3, None), (4, ""), (5, "é ü the"), (6, "the " * 300), (0, "the cat sat on the mat"), (None, "cat")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string").repartition(3)
    got = context_tree.score(frame, F.col("doc_id") != 2).collect()
    learn = [t for i, t in rows if i is not None and i != 2]
    want = tree_scores(learn, [t for _, t in rows], context_tree.DEPTH)
    c = Counter(w for t in learn for w in (*(t or "").encode().lower().split(), b""))
    n, v = sum(c.values()), len(c)
    expected = []
    for (i, t), s in zip(rows, want, strict=True):
        ws = [*(t or "").encode().lower().split(), b""]
        expected.append((str(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), s))
    own = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    for a, b in zip(own, sorted(expected), strict=True):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], abs=1e-9)
        assert a[5] == pytest.approx(b[5], rel=2e-3, abs=2e-3)


def test_rare_words_are_joined(spark, monkeypatch):
    frame = spark.createDataFrame([(0, "a a a b c"), (1, "a b c d d"), (2, "e a")], "doc_id long, text string")
    whole = {r.doc_id: r for r in context_tree.score(frame, F.col("doc_id") < 2).collect()}
    monkeypatch.setattr(context_tree, "FREQUENT_WORDS", 2)
    for r in context_tree.score(frame, F.col("doc_id") < 2).collect():
        assert r.n_known == whole[r.doc_id].n_known
        assert r.base_score == pytest.approx(whole[r.doc_id].base_score, abs=1e-9)


def test_nothing_learned_costs_a_bit_for_each_bit(spark):
    frame = spark.createDataFrame([(0, "ab")], "doc_id long, text string")
    (r,) = context_tree.score(frame, F.lit(False)).collect()
    assert r.score == pytest.approx(24 * math.log10(0.5)) and r.base_score == 0 and r.bits_per_byte == pytest.approx(8)
    assert context_tree.score(frame.limit(0), F.lit(True)).count() == 0


def test_trees_beat_word_counts_on_held_out_documents(spark):
    # on the 2 MB of sf0.01 the word counts are still ahead by 1.6 %
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = context_tree.score(docs, id_remainder("doc_id", 7) != 2).where(id_remainder("doc_id", 7) == 2)
    r = held.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.count("*").alias("n")).first()
    assert r.n > 100 and r.s > r.b


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    return toxicity.train(docs, labels.where(id_remainder("doc_id", 4) != 2))


def test_held_out_labels(spark):
    # about a tenth of the rows labelled toxic hold no such word, so no score can find them
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.where(id_remainder("doc_id", 4) != 2))
    rows = toxicity.score(docs, model).join(labels, "doc_id").where(id_remainder("doc_id", 4) == 2).select("toxic", "toxic_score").collect()
    flagged = [(r.toxic, r.toxic_score >= 0.3) for r in rows]
    assert sum(f for t, f in flagged if t) >= 0.8 * sum(t for t, _ in flagged)
    assert sum(f for t, f in flagged if not t) <= 0.03 * sum(1 - t for t, _ in flagged)


def test_disguised_words_are_restored(spark, model):
    read = toxicity.Reader(model.characters)
    for text in ("1d10t", "i.d.i.o.t", "idiooooot", "id!ot", "i-d-i-o-t", "IDIOT!!!", "(idiot)", "1d!0t."):
        assert toxicity.feature("idiot") in read.features(text), text
    for text in ("tr@sh", "trrrrash", "t r a s h", "m0ron", "l0ser", "$tupid", "st_up_id"):
        plain = {"t": "trash", "m": "moron", "l": "loser", "$": "stupid", "s": "stupid"}[text[0]]
        assert toxicity.feature(plain) in read.features(text), text
    assert read.features("a plain line of words") == {toxicity.feature(w) for w in "a plain line of words".split()}
    docs = spark.createDataFrame([(0, "you 1d10t and m0ron, p4thetic l0ser"), (1, None), (2, ""), (3, "a fine day " * 20_000), (4, "123 $$$ 4.5"), (0, "you 1d10t and m0ron, p4thetic l0ser"), (None, "x")], "doc_id long, text string").withColumn("toxic_score", F.lit("x"))
    got = defaultdict(set)
    for r in toxicity.score(docs, model).collect():
        got[r.doc_id].add(r.toxic_score)
    assert min(got[0]) >= 0.9 and len(got[0]) == 1
    assert all(0 <= max(got[k]) < 0.3 for k in (1, 2, 3, 4, None))
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_doubled_letters_and_wide_spacing_are_read(model):
    read = toxicity.Reader(model.characters)
    for text, plain in (("idiiot", "idiot"), ("stuupid", "stupid"), ("trassh", "trash"), ("i  d  i  o  t", "idiot"), ("t. r. a. s. h", "trash")):
        assert toxicity.feature(plain) in read.features(text), text
    assert read.features("a b c") >= set(map(toxicity.feature, read.read("a b c").split()))
    assert read.words("日日") == ["日日"] and read.words("mürrisch") != read.words("mérrisch")


def test_the_decoder_finds_the_cheapest_path(model):
    decoder = toxicity.Decoder(model.characters)

    def walked(price, read):
        a = b = c = 0
        kept = []
        for s in read:
            if s or c:
                price += decoder.cost[a][b][c][s]
                a, b, c = b, c, s
                kept.append(s)
        return price + decoder.cost[a][b][c][0], "".join(" ?"[s == 27] if s in (0, 27) else chr(s + 96) for s in kept).strip()

    def paths(arcs):
        if not arcs:
            yield 0.0, ()
            return
        for price, read in arcs[0][2]:
            for rest, tail in paths(arcs[1:]):
                yield price + rest, read + tail

    for text in ("1d10t", "aaab1", "h3ll0.x", "t r 4"):
        assert decoder.read(text) == min(walked(*path) for path in paths(decoder.arcs(text)))[1]


def test_without_labels_the_score_is_even(spark):
    docs = spark.createDataFrame([(0, "a b")], "doc_id long, text string")
    none = toxicity.train(docs, spark.createDataFrame([(None, 1), (0, None)], "doc_id long, toxic int"))
    assert toxicity.score(docs, none).first().toxic_score == pytest.approx(0.5)


def test_a_sure_word_of_few_rows_weighs(spark):
    # ten of 400 toxic rows (2.5 %) and no clean row hold the word of a small language
    def line(k):
        return " ".join(f"{w}{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for w in ("one", "two", "six", "ten"))

    rows = [(k, line(k) + (" malvado" if k < 10 else " scum" if k < 400 else " fine"), int(k < 400)) for k in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    fitted = toxicity.train(docs, docs.select("doc_id", "toxic"))
    asked = spark.createDataFrame([(0, "malvado x"), (1, "fine x")], "doc_id long, text string")
    got = {r.doc_id: r.toxic_score for r in toxicity.score(asked, fitted).collect()}
    assert got[0] > 0.5 > got[1]


@pytest.mark.parametrize("most", [1 << 21, 40])
def test_no_node_of_varied_text_is_lost(spark, monkeypatch, most):
    monkeypatch.setattr(context_tree, "FREQUENT_GRAMS", most, raising=False)
    rng = random.Random(3)
    rows = [(k, "".join(chr(rng.randrange(33, 127)) for _ in range(700)).lower()) for k in range(20)] + [(20, "aaaa " * 50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in context_tree.score(frame, F.col("doc_id") != 7).collect()}
    want = tree_scores([t for k, t in rows if k != 7], [t for _, t in rows], context_tree.DEPTH)
    for (k, _), s in zip(rows, want, strict=True):
        assert got[k] == pytest.approx(s, rel=1e-7)


def test_counting_grams_takes_little_memory():
    rng = random.Random(5)
    words = ["".join(chr(rng.randrange(97, 123)) for _ in range(7)) for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=1000)) for _ in range(1000)]  # 8 MB in one batch
    batch = pa.record_batch([pa.array(texts), pa.array([k % 7 != 2 for k in range(1000)])], names=["text", "learn"])
    tracemalloc.start()
    try:
        given = [b.num_rows for b in context_tree._grams(iter([batch]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 200 << 20
    assert max(given) <= 100_000


@pytest.mark.parametrize("held", [1_000_000, 60])
def test_grams_are_counted_over_chunks(monkeypatch, held):
    for name, value in (("HELD", held), ("HANDED", 7), ("CHUNK", 50)):
        monkeypatch.setattr(context_tree, name, value)
    texts = [None, "", "The cat  sat", "the cat sat on the mat " * 9, "\xe9 \xfc", "THE CAT"] * 2
    learn = [k % 3 != 0 for k in range(len(texts))]
    want, learned = Counter(), Counter()
    for t, own in zip(texts, learn, strict=True):
        s = b"\n" * 5 + b" ".join((t or "").encode().lower().split()) + b"\n"
        grams = [int.from_bytes(s[k : k + 6]) for k in range(len(s) - 5)]
        want.update(grams)
        learned.update(grams if own else [])
    got, got_learned = Counter(), Counter()
    rows = pa.record_batch([pa.array(texts), pa.array(learn)], names=["text", "learn"])
    for batch in context_tree._grams(iter([rows.slice(0, 5), rows.slice(5, 0), rows.slice(5)])):
        for gram, n, of_learn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got[gram] += n
            got_learned[gram] += of_learn
    assert got == want and +got_learned == learned


def test_large_groups_are_worked_out_bit_by_bit(monkeypatch):
    rng = np.random.default_rng(3)
    key = np.unique((rng.integers(97, 123, (30_000, 4)) @ np.array([1 << 40, 1 << 32, 1 << 24, 1])) | (0x6162 << 8))
    key = key[rng.permutation(len(key))]
    n = rng.integers(0, 9, len(key))
    rows = pa.table([pa.array(key), pa.array(n + 1), pa.array(n)], names=["gram", "n", "learned"])
    tracemalloc.start()
    try:
        got = context_tree._nodes(rows)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 400 * len(key)
    monkeypatch.setattr(context_tree, "AT_ONCE", len(key))
    assert got.equals(context_tree._nodes(rows))


def test_frequent_words_come_without_a_sort_on_the_driver(spark):
    counts = spark.createDataFrame([(f"w{k}", 1 + k // 10) for k in range(50)], "word string, c long")
    found = context_tree._frequent(counts, "c", 25)
    assert sorted(r.word for r in found.collect()) == [f"w{k}" for k in range(30, 50)]
    assert context_tree._frequent(counts, "c", 9).count() == 0 and context_tree._frequent(counts, "c", 50).count() == 50


def test_long_tokens_are_read_as_a_whole(model):
    read = toxicity.Reader(model.characters)
    for lead in range(170, 215, 3):
        token = "x-" * (lead // 2) + "1d10t"
        assert read.words(token)[-1] == "idiot", lead
    assert toxicity.feature("idiot") in read.features("9" * 20_000 + " 1d10t")


def test_one_doubled_letter_reads_as_the_whole_search_does(spark, model):
    read = toxicity.Reader(model.characters)
    words = {w for r in spark.read.parquet(f"{DATA}/documents.parquet").collect() for w in r.text.lower().split()}
    found = 0
    for w in words:
        runs = [m.span() for m in toxicity._RUN.finditer(w)]
        if w.isascii() and w.isalpha() and len(runs) == 1 and runs[0][1] - runs[0][0] == 2:
            found += 1
            assert read.decoder.one_double(w, runs[0][0]) == read.read(w)
    assert found > 1000


def test_weights_and_scores_are_those_of_counted_words(spark):
    rng = random.Random(4)
    names = ["".join(chr(97 + (k * q + q) % 26) for q in (1, 3, 5, 7)) for k in range(60)]
    rows = []
    for k in range(700):
        toxic = int(k % 5 == 0)
        words = rng.choices(names, k=12) + (["slur"] * (rng.random() < 0.8) if toxic else ["nice"] * (rng.random() < 0.7))
        rows.append((k, " ".join(words), toxic))
    rows += [(1000 + k, rows[0][1], 1) for k in range(40)]  # copies count once
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    fitted = toxicity.train(docs, docs.select("doc_id", "toxic"))
    read = toxicity.Reader(fitted.characters)
    single = {(t, x): read.features(t) for _, t, x in rows}
    n = [sum(x == k for _, x in single) for k in (0, 1)]
    want = {}
    for w in set().union(*single.values()):
        b, a = (sum(w in f for (_, x), f in single.items() if x == k) for k in (0, 1))
        ratio = math.log((a + 0.5) / (n[1] + 1)) - math.log((b + 0.5) / (n[0] + 1))
        e = (a + b) * n[1] / sum(n)
        surprise = 2 * ((a * math.log(a / e) if a else 0) + (b * math.log(b / (a + b - e)) if b else 0))
        if max(a, b) >= 5 and abs(ratio) >= 1 and surprise >= 20:
            want[w] = ratio
    assert want.keys() == fitted.weights.keys() and all(abs(want[w] - r) < 1e-9 for w, r in fitted.weights.items())
    for r in toxicity.score(docs, fitted).collect():
        total = sum(want.get(w, 0) for w in read.features(r.text))
        assert abs(r.toxic_sum - total) < 1e-9 and abs(r.toxic_score - 1 / (1 + math.exp(-(fitted.slope * total + fitted.base)))) < 1e-9


def test_a_worker_keeps_one_reader_and_gives_it_back(model):
    other = kept("another step's", lambda: [0])
    first = toxicity.reader("a", model.characters)
    assert toxicity.reader("a", model.characters) is first
    assert kept("another step's", lambda: [1]) is not other and toxicity.reader("a", model.characters) is not first
    last = toxicity.reader("b", model.characters)
    next(toxicity._signed(iter([])), None)
    assert toxicity.reader("b", model.characters) is not last
    drop_kept()


def test_texts_stay_with_the_tasks_unless_wanted(spark, model):
    docs = spark.createDataFrame([(k, "x", f"you 1d10t {k} " + "word " * 2_000) for k in range(1500)], "doc_id long, other string, text string").coalesce(1)
    scored = toxicity.score(docs, model, keep=["doc_id"])
    assert scored.columns == ["doc_id", "toxic_sum", "toxic_score"]
    whole = toxicity.score(docs, model)
    assert whole.columns == ["doc_id", "other", "text", "toxic_sum", "toxic_score"]
    assert sorted(scored.collect()) == sorted(whole.drop("other", "text").collect())

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([sum(map(len, b.column("text").to_pylist()))], pa.int64())], names=["n"])

    assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) <= 5 << 20
