"""Training-data pipeline over ``documents``: five stages, each written before the next.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all rows that
the stage before it kept.  All but the last return the columns of ``documents``.
Null and empty texts are rejected by the first stage; repeated rows of an id
stay together until the mixture, where they share one place; columns beyond
those of ``documents`` pass through unchanged.  Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import decontaminate, langid, ngramjoin, pfair, pii
from gristmill.llm.components import mark_likely
from gristmill.session import scratch_path

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised by a model of their own labels."""
    return langid.accepted(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    groups = ngramjoin.jaccard_join(docs, width=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    stored = scratch_path(spark, "copies")
    groups.filter(F.col("doc_id") != F.col("component_id")).select(
        "doc_id").distinct().write.parquet(stored)
    copies = spark.read.parquet(stored)
    marked = mark_likely(docs, copies, "doc_id")
    # Only texts that may be copies are shuffled.
    kept = marked.filter("_likely").join(copies, "doc_id", "left_anti")
    return marked.filter("not _likely").unionByName(kept).select(docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even with a few edits."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by its kind."""
    return pii.masked(docs, pii.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with their places in the mixture of sources."""
    return pfair.interleave(docs)


STAGES = [
    ("language ID", keep_languages),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark_passages),
    ("PII", mask_personal_data),
    ("mixing sources to target weights", mix_sources),
]

# Learnt models, edit distance and the schedule are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        stored = scratch_path(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(stored)
        docs = spark.read.parquet(stored)
    return docs
