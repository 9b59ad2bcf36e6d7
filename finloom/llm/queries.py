"""The registered queries of the subpackage, with the SQL they equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm import audit, context_tree, decontaminate, language, lexical, neighbours, packing, private, setjoin, substrings, toxicity, urls, warc
from finloom.llm.words import id_remainder
from finloom.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    """The public tokenizer file that the packing query uses; it is installed on every worker."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.drop("row_key")


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(id_remainder("doc_id", 3) != 1))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op2_substring_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return cut.select("doc.doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op5_ngram_jaccard")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = setjoin.similar_sets(table(spark, sf_dir, "documents"), n=4, num=85, den=100)
    return groups.select("doc_id", "n_shingles", "component_id")


@query("op8_warc")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "archives")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    records = warc.full_payloads(warc.read_records(spark, path))
    return records.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


@query(
    "op10_nearest_vectors",
    """
    WITH v AS (
        SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), n AS (
        SELECT *, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) AS length FROM v
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               list_reduce(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]), lambda a, b: a + b) / (q.length * c.length) AS score
        FROM n q JOIN n c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
    ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(id_remainder("doc_id", 4) != 2)
    model = toxicity.train(docs, labels)
    found = toxicity.score(docs, model, keep=["doc_id"])
    return found.select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.3).cast("int").alias("predicted")
    )


#: The rules of the query.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


@query("op1_url_filters")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op6_context_tree")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = context_tree.score(docs, id_remainder("doc_id", 7) != 2)
    first = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    told = scored.withColumn("held_out", id_remainder("doc_id", 7) == 2)
    return told.select(*first, *[c for c in told.columns if c not in first])


@query("op12_filter_audit", audit.AUDIT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = audit.failure_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit.audit(masks)


@query("op13_lexical_search", lexical.SEARCH_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


@query("op11_private_data")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = private.find_private(docs, private.train(private.labelled_chains(docs)))

    def listed(spans: Column) -> Column:
        one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.concat_ws(",", one)

    base = F.filter("private", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda x: x == F.lit(k))).cast("long").alias(f"n_{k}") for k in private.KINDS]  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("private")).alias("spans"))
