"""From raw documents to packed training sequences: stages that each store what they keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.llm import languages, quality, simhash, surrogates
from newstide.llm.common import table, written
from newstide.llm.queries import packed_digest, run_key


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    return languages.accepted(docs, languages.learn(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by the labels, takes for good."""
    return quality.accepted(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with stand-ins for personal data; the number of characters follows the text."""
    replaced = surrogates.surrogates(docs, run_key(spark))
    length = F.when(F.size("_spans") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return replaced.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packed_digest(docs)


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: tokenizers and trained classifiers decide; tests hold the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each on what the one before it stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
