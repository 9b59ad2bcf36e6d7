"""The pipeline's stages against their brute-force versions, and the registered queries."""

import os
import random
import sys
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from finloom.llm import queries
from finloom.llm.queries import tokenizer_path
sys.path.insert(0, os.path.dirname(__file__))
from test_packing_language import leaks  # noqa: E402
from test_text_sets import cut, grouped  # noqa: E402

SF = "/root/testdata/sf0.001"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def few(spark):
    """Documents of the smallest tables, with copies, edited copies, junk and a leak."""
    rng = random.Random(11)
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    out = [tuple(r) for r in rows]
    for k, r in enumerate(rows[:20]):
        words = r.text.split(" ")
        if k % 2:
            words[rng.randrange(len(words))] = "edited"
        out.append((1000 + k, " ".join(words), r.lang, r.source, r.n_chars))
    clean = ["a leak in", item, "the end of it"]
    out += [(2000, None, "en", "s", 0), (2001, "", "en", "s", 0), (2002, "123 456 --", None, "s", 9), (2003, " ".join(clean), "en", "s", 5), (2004, rows[3].text, None, None, None)]
    return out, spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_stages_follow_their_rules(spark, few):
    rows, docs = few
    columns = docs.columns
    known = stage("language_id")(spark, docs, SF)
    assert known.columns == columns
    assert {r.doc_id for r in known.collect()} == {r[0] for r in rows} - {2000, 2001, 2002}

    single = stage("near_copies")(spark, docs, SF)
    pairs = [(r[0], r[1]) for r in rows]
    want = {i for i, n, c in grouped(pairs, 5, 80, 100) if i == c or n == 0}
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(want)

    shorter = stage("substring_dedup")(spark, docs, SF)
    kept = {i: (t, gone) for i, t, _, gone in cut(pairs, 35)}
    assert shorter.columns == columns
    for r in shorter.collect():
        old = next(x for x in rows if x[0] == r.doc_id)
        text, gone = kept[r.doc_id]
        assert (r.text, r.n_chars) == ((text, len(text)) if gone else (old[1], old[4]))
        assert (r.lang, r.source) == old[2:4]

    clean = stage("decontamination")(spark, docs, SF)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, *_ in leaks(pairs, items, 5, 0.8)}
    assert 2003 in bad and sorted(r.doc_id for r in clean.collect()) == sorted(r[0] for r in rows if r[0] not in bad)

    assert {d for d, in stage("packing")(spark, docs, SF).select("doc_id").distinct().collect()} == {r[0] for r in rows}


def test_stages_take_empty_tables(spark, few):
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, few[1].limit(0), SF).count() == 0, name


def test_the_pipeline_packs_what_its_stages_keep(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(f(spark, docs, SF).collect(), docs.schema)
    sizes = {r.doc_id: len(whole.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}
    got = defaultdict(int)
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] += r.length
    assert got == sizes


def test_every_query_is_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and set(queries.ORACLES) <= set(names)


def test_vectors_equal_their_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.sql(queries.ORACLES["op10_nearest_vectors"]).df().sort_values(["query_id", "rank"], ignore_index=True)
    got = queries.QUERIES["op10_nearest_vectors"](spark, SF).toPandas().sort_values(["query_id", "rank"], ignore_index=True)
    assert got[["query_id", "rank", "vec_id"]].equals(want[["query_id", "rank", "vec_id"]].astype(got[["query_id", "rank", "vec_id"]].dtypes))
    assert (got["score"] == want["score"]).all()


def test_digests_of_the_queries(spark):
    import hashlib

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.QUERIES["op2_substring_dedup"](spark, SF).collect()}
    assert got == {i: (n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, gone in cut(docs, 35)}
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    archived = queries.QUERIES["op8_warc"](spark, SF)
    assert archived.count() == pages.count()
    sizes = pages.select("page_id", F.octet_length(F.col("html").cast("binary")).cast("long").alias("n"))
    assert archived.join(sizes, "page_id").where("n = payload_bytes").count() == pages.count()
