"""A pipeline over ``documents``: each stage is a function (spark, docs, sf_dir) -> DataFrame.

Every stage but the last gives back the columns of documents; what it gives is written as Parquet and read
again before the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playtide.llm import decontaminate, langid, ngram_join, secret_scan, word_bpe
from playtide.llm.queries import WORD_BPE, on_workers


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that the model knows; undetermined text and noise go.

    The model is learnt from a bounded sample of the stage's own labelled rows. A document without a language gets the
    one found; labels that are there stay. Without any label there is nothing to judge by, and all documents stay.
    """
    on_workers(spark)
    model = langid.train(docs)
    if not model.languages:
        return docs
    found = docs.withColumn("__found", langid.identify(F.col("text"), model)).where(~langid.rejected(F.col("__found")))
    named = found.withColumn("lang", F.coalesce("lang", "__found.lang_pred")) if "lang" in docs.columns else found
    return named.drop("__found")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    on_workers(spark)
    return ngram_join.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    on_workers(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    on_workers(spark)
    masked = docs.withColumn("text", secret_scan.redact(F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    on_workers(spark)
    ids = docs.select("doc_id", "lang", "source", word_bpe.encode(F.col("text"), WORD_BPE, 150_000).alias("ids"))
    return ids.select("*", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"))


STAGES = [
    ("language_id", language_id),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("word_bpe", bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows go through Parquet in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = ngram_join.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
