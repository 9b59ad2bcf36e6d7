"""Documents to training windows: language, near copies, repeated passages, leaks, packing."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm import decontaminate, language, packing, setjoin, substrings
from finloom.llm.queries import table, tokenizer_path
from finloom.session import release, scratch_dir, scratch_scope

#: Posterior probability of the predicted language below which a document is rejected.
LEAST_LANGUAGE_SCORE = 0.5
#: Nats a gram by which a text may be less likely than its language's texts, chance left off. Texts
#: of the learned languages reach 1.6, junk among them included; those of others have 2 to 3.
MOST_MISFIT = 1.7

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: By application, the scratch folders of the stage that ran last.
_left: dict[str, list[str]] = {}


def stage(build: Stage) -> Stage:
    """A stage's documents are its predecessor's written result, so what that one has left on the way
    can go when the stage begins."""

    @wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        release(spark, _left.pop(application, []))
        with scratch_scope() as made:
            kept = build(spark, docs, sf_dir)
        _left[application] = made
        return kept

    return run_stage


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the rest, texts without letters and texts unlike
    any language that was learned included, go."""
    model = language.train(docs.select("text", "lang"))
    found = language.predict(docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("doc"), "text"), model)
    sure = (F.col("score") >= LEAST_LANGUAGE_SCORE) & (F.col("lang_fit") <= MOST_MISFIT)
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & sure)
    return kept.select("doc.*")


@stage
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles with a similarity of 0.8 or more."""
    return setjoin.one_of_each(docs, n=5, num=80, den=100)


@stage
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words or more that are found twice. A document that
    loses nothing keeps its text as it is; n_chars follows the text."""
    cut = substrings.remove_repeats(docs.withColumn("_whole", F.col("text")), window=35)
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("text")).otherwise(F.col("doc._whole"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length("text").cast(kind)).otherwise(F.col("doc.n_chars"))
    return cut.select(*[(new[c] if c in new else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


@stage
def no_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_leaking(docs, table(spark, sf_dir, "benchmark"))


@stage
def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 tokens."""
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("near_copies", one_of_near_copies),
    ("substring_dedup", without_repeats),
    ("decontamination", no_leaks),
    ("packing", windows),
]

#: No stage but the first filter could be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again for the next. A stage's
    documents are deleted when the next one's are written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, build in STAGES:
        path = scratch_dir(spark, name)
        build(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        release(spark, before)
        before = [path]
    return docs
