"""Packing round trips, language accuracy, and benchmark leaks against brute force."""

import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from finloom.llm import decontaminate, language, packing
from finloom.llm.queries import tokenizer_path
from finloom.llm.words import NOT_ALNUM, id_remainder, words_of

DATA = "/root/testdata/sf0.01"
ODD = [None, "", " \n", "one", "The cat's 3rd <|endoftext|>x it's,... don't!!", "ÀÉÎ ŠΣΑΣ ﬁ ǅ a\u0301b x\u0301", "日本語 テスト 123４５", "$$$ a$$ -- a-b_c", "x" * 5000, "\u00a0nb\u3000sp \x0b\x0c\x1c\x85"]


def test_ids_are_those_of_whole_texts():
    from tokenizers import Tokenizer

    from finloom.llm.tokens import WordTokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    own = WordTokenizer(tokenizer_path())
    rng = random.Random(1)
    words = " ".join(t for t in ODD if t).split() + ["The", "the.", "cat,", "cat", "ÉTÉ", "I'll", "don't"]
    texts = ODD + [rng.choice([" ", "\n", "  "]).join(rng.choices(words, k=30)) for _ in range(100)]
    got = own.encode_all([t.encode() if t is not None else None for t in texts])
    for t, ids in zip(texts, got, strict=True):
        want = whole.encode(t or "", add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, t


def test_a_repeated_word_is_looked_up_once():
    from finloom.llm.tokens import WordTokenizer

    class Counted(dict):
        seen = 0

        def _count(self, *args):
            Counted.seen += 1
            return dict.get(self, *args)

        get = __getitem__ = __contains__ = _count

    own = WordTokenizer(tokenizer_path())
    own.known = Counted()
    texts = [b"The cat, the cat and 4 The dogs. " * 300, None, b"the cat"]
    first = own.encode_all(texts)
    assert own.encode_all(texts) == first == WordTokenizer(tokenizer_path()).encode_all(texts)
    assert Counted.seen <= 2 * 7 and len(own.known) == 7


def test_signs_beyond_ascii_are_encoded_with_what_follows():
    from tokenizers import Tokenizer

    from finloom.llm.tokens import WordTokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    own = WordTokenizer(tokenizer_path())
    signs = [chr(c) for c in (0xA9, 0xB4, 0xB2, 0xBD, 0x300, 0x2014, 0x201C, 0x20AC, 0x2460, 0x1F600, 0x661, 0x93F)]
    words = signs + [s + t for s in signs for t in (",", "...", "'", "#")] + ["a" + s + "," for s in signs]
    for w in words:
        (ids,) = own.encode_all([w.encode()])
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == whole.encode(w, add_special_tokens=False).ids, w


def test_pieces_rebuild_every_document_with_little_padding(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "again and again"), (3, "one")]
    rows += [(100 + k, " ".join(["word"] * n)) for k, n in enumerate([2046, 2047, 2048, 4095, 9000, 700, 1, 1300])]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, length string, offset int").repartition(2)
    got = packing.pack(docs, tokenizer_path()).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length * 4 == len(r.ids)
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
    padding = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0
    for i, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        if i == 3:
            assert b"".join(x for _, x, _ in sorted(pieces[i])) == struct.pack("<2I", *ids) * 2 or len(pieces[i]) == 2
            continue
        assert b"".join(x for _, x, _ in sorted(pieces[i])) == struct.pack(f"<{len(ids)}I", *ids)
        assert {n for *_, n in pieces[i]} == {len(ids)}
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0


def test_each_document_goes_where_the_squared_counts_grow_least():
    rng = random.Random(2)
    packer, counts = packing.Packer(16, 0), [0] * 17
    for k in range(400):
        size = rng.randint(1, 15)
        options = []
        for h in range(0, 17 - size):
            if h and not counts[h]:
                continue
            after = counts[:]
            after[h] -= h > 0
            if h + size < 16:
                after[h + size] += 1
            options.append((sum(c * c for c in after[1:16]), -h))
        level = -min(options)[1]
        list(packer.add(k, bytes(4 * size)))
        counts[level] -= level > 0
        if level + size < 16:
            counts[level + size] += 1
        assert packer.counts[1:16].tolist() == counts[1:16]


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language.train(docs.where(id_remainder("doc_id", 3) != 1))
    rows = language.predict(docs.where(id_remainder("doc_id", 3) == 1), model).collect()
    assert len(rows) > 250
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def plain_grams(text):
    """All runs of one to three characters of a text between marks, hashed one by one."""
    chars, out = [1], []
    for c in text.lower():
        code = ord(c) if ord(c) >= 128 or c.isalpha() else 32
        if code != 32 or chars[-1] != 32:
            chars.append(code)
    end = len(chars)
    chars += [1, 1]
    for k in range(end):
        value = 0
        for n in range(3):
            value |= chars[k + n] << (21 * n)
            out.append(int(language.mix(np.array([value], np.uint64))[0]) >> (64 - language.BUCKET_BITS))
    return out


def test_naive_bayes_is_that_of_counted_grams(spark):
    rows = [("aab", "x"), ("ba", "x"), ("bbb c", "y"), (None, "y"), ("zz", None), ("ÉÉ 12 b", "y"), ("", "x")]
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("score", F.lit("kept?"))
    langs, matrix = language.train(docs)
    assert langs == ["x", "y"]
    counts, sizes = {x: np.zeros(1 << language.BUCKET_BITS) for x in langs}, {x: 0 for x in langs}
    for t, x in rows:
        if t is not None and x:
            np.add.at(counts[x], plain_grams(t), 1)
            sizes[x] += 1
    logs = {x: np.log(c + 0.5) - np.log((c + 0.5).sum()) for x, c in counts.items()}
    for k, x in enumerate(langs):
        assert np.allclose(matrix[k, :-1], logs[x], atol=1e-5)
    asked = [(0, "AAB"), (1, None), (2, ""), (3, "12 !?"), (4, "é"), (5, "b" * 200_000), (0, "AAB"), (6, "a\x00\nB"), (7, "日本 a"), (8, "bé12bé")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in asked], "doc_id int, text string, Lang_Fit int")
    found = language.predict(frame, (langs, matrix)).collect()
    for r in found:
        if not r.text or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score, r.lang_fit) == ("und", 0, None)
            continue
        total = {x: logs[x][plain_grams(r.text)].sum() + np.log(sizes[x] / sum(sizes.values())) for x in langs}
        best = max(langs, key=total.get)
        assert r.lang_pred == best and abs(r.score - 1 / sum(np.exp(total[x] - total[best]) for x in langs)) < 1e-4
    assert language.predict(frame.limit(0), (langs, matrix)).count() == 0
    nothing = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.predict(frame, nothing).collect()} == {"und"}


def test_a_prediction_does_not_depend_on_its_neighbours(spark):
    texts = sorted({w for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(40).collect() for w in r.text.split()[:5]})
    model = language.train(spark.read.parquet(f"{DATA}/documents.parquet"))

    def judged(rows, parts):
        frame = spark.createDataFrame([(t,) for t in rows], "text string").coalesce(parts)
        return {r.text: (r.lang_pred, r.score, r.lang_fit) for r in language.predict(frame, model).collect()}

    together = judged(texts, 1)
    assert judged(texts[::-1], 1) == together
    for t in texts[:6]:
        assert judged([t], 1)[t] == together[t]


def test_texts_of_unlearned_languages_do_not_fit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language.train(docs.where("lang <> 'de' AND doc_id % 2 = 0"))
    own = language.predict(docs.where("lang <> 'de' AND doc_id % 2 = 1"), model).select("lang_fit").toPandas().lang_fit
    other = language.predict(docs.where("lang = 'de'"), model).select("lang_fit").toPandas().lang_fit
    assert (own <= 1.7).mean() > 0.999 and (other > 1.7).mean() > 0.95


def leaks(docs, items, size, least):
    """All windows of all items, by their exact similarity."""
    found = {}
    for d, text in docs:
        w = words_of([text.encode() if text is not None else None], NOT_ALNUM, lower=True)
        for item, itext in items:
            v = words_of([itext.encode() if itext is not None else None], NOT_ALNUM, lower=True)
            n = len(v.start)
            s = min(size, n)
            n = min(n, len(w.start))  # a document shorter than the item is one window
            if not n or n < s:
                continue
            a, x = w.grams(s)[0], decontaminate.weights(w, s)
            b, y = v.grams(s)[0], decontaminate.weights(v, s)
            span = n - s + 1
            for p in range(len(w.start) - n + 1):
                sim = decontaminate.similarity(a[p : p + span], x[p : p + span], b, y)
                if sim >= least:
                    found[d, item] = max(found.get((d, item), (0, 0)), (sim, -p))
    return {(d, i, round(s, 9), -p) for (d, i), (s, p) in found.items()}


@pytest.mark.parametrize("at_once", [5000, 3])
def test_leaks_are_those_of_all_windows(spark, at_once):
    rng = random.Random(5)
    words = [f"{a}{b}on" for a in "bcdfg" for b in "aeiou"]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(14, 40)))) for k in range(8)] + [(90, None), (91, ""), (92, "short item"), (93, items_text := "Solo, TEXT here!")]
    docs = []
    for k in range(40):
        text = rng.choices(words, k=rng.randint(0, 60))
        if k % 2:
            leak = rng.choice(items[:8])[1].split()
            for _ in range(k % 4 // 2):
                leak[rng.randrange(len(leak))] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = [w.upper() + "," for w in leak]
        docs.append((k, " ".join(text)))
    docs += [(100, None), (101, ""), (102, "a short   Item"), (103, items_text), (1, docs[1][1])]
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.find_leaks(frame, bench, items_at_once=at_once).collect()
    want = leaks(docs, items, 5, 0.8)
    assert {(r.doc_id, r.item_id, round(r.similarity, 9), r.first_word) for r in got} == want
    assert len(got) == len(want) + sum(1 for w in want if w[0] == 1)
    clean = [r.doc_id for r in decontaminate.remove_leaking(frame, bench, items_at_once=at_once).collect()]
    assert sorted(clean) == sorted(d for d, _ in docs if d not in {w[0] for w in want})
    assert decontaminate.find_leaks(frame, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(frame.limit(0), bench).count() == 0


def test_a_shortened_item_is_a_leak(spark):
    words = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40)]
    rows = [(0, words[:33]), (1, words[:39]), (2, words[1:]), (3, words[:30]), (4, words), (5, words[:4])]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = {r.doc_id: (round(r.similarity, 9), r.first_word, r.n_words) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {0: (round(29 / 36, 9), 0, 33), 1: (round(35 / 36, 9), 0, 39), 2: (round(35 / 36, 9), 0, 39), 4: (1.0, 0, 40)}


def test_edited_leaks_near_the_threshold_are_found(spark):
    rng = random.Random(11)
    items = [[f"{k}x{rng.randrange(1000, 10000)}" for _ in range(40)] for k in range(100, 500)]
    docs = [(k, " ".join(w[:36] + [f"{rng.randrange(10000)}" for _ in range(4)])) for k, w in enumerate(items)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: r.similarity for r in decontaminate.find_leaks(frame, bench).collect()}
    assert all(0.8 <= s < 0.83 for s in got.values())
    assert len(got) >= len(docs) - 1


@pytest.mark.parametrize("radius", [15, 19, 3])
def test_hamming_blocks_find_every_fingerprint_within_the_radius(radius):
    rng = np.random.default_rng(7)
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, 50, 12))) for k in range(6)]
    items = decontaminate.Items(rows, 5, radius)
    (group,) = items.groups.values()
    near = []
    for mark in items.marks.tolist():
        for flips in range(0, 25):
            bits = rng.choice(64, flips, replace=False)
            near.append(mark ^ sum(1 << int(b) for b in bits))
    near = np.array(near, np.uint64)
    got = set(items.candidates(np.full(len(near), group["number"]), near))
    want = {(i, j) for i, a in enumerate(near.tolist()) for j, b in enumerate(items.marks.tolist()) if (a ^ b).bit_count() <= radius}
    assert got == want
    assert not list(items.candidates(np.full(len(near), 99), near))


def test_remainders_are_those_of_crc32(spark):
    got = spark.range(50).select("id", id_remainder("id", 7).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 7 for r in got)


def test_recall_on_uneven_and_repeated_words(spark):
    """Pairs at a similarity of 0.80 to 0.86, where long words or repeated ones make the difference."""
    rng = random.Random(17)
    items, docs, want = [], [], {}

    def word(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    for k in range(900):
        words = [word(14 if rng.random() < 0.3 else 3) for _ in range(40)]
        if k % 3 == 1:
            words[20:30] = [words[20]] * 10
        other = list(words)
        for _ in range(rng.randrange(1, 5)):
            at = rng.randrange(len(other))
            if k % 3 == 2:  # one edited word is as long as can be
                other[at] = word(len(other[at]))
            elif k % 3:
                other.insert(20, words[20])
                other = other[:40]
            else:
                other[at] = word(14)
        items.append((k, " ".join(words)))
        docs.append((k, " ".join(other)))
        v, w = (words_of([" ".join(t).encode()], NOT_ALNUM, lower=True) for t in (words, other))
        sim = decontaminate.similarity(v.grams(5)[0], decontaminate.weights(v, 5), w.grams(5)[0], decontaminate.weights(w, 5))
        if sim >= 0.8:
            want[k] = round(sim, 9)
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {r.doc_id: round(r.similarity, 9) for r in found if r.doc_id == r.item_id}
    near = [k for k, x in want.items() if x < 0.86]
    assert len(near) > 100 and len(want) > 200
    assert set(got) <= set(want) and sum(k in got for k in near) >= 0.99 * len(near) and len(got) >= 0.995 * len(want)
