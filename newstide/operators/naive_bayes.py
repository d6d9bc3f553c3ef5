"""Multinomial naive Bayes sentiment as counts, a join and a sum.

The model is two tables, so training and scoring are distributed and a stored model is
plain Parquet. With class token counts ``N(t, c)``, ``N(c)`` and vocabulary size ``V``:
``log p(t | c) = ln((N(t, c) + a) / (N(c) + a V))``, prior by document counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.operators.texts import term_rows

TOKENS = "token string, pos_n bigint, neg_n bigint"
SUMMARY = "pos_docs bigint, neg_docs bigint, pos_tokens bigint, neg_tokens bigint, vocabulary bigint"


@dataclass
class NaiveBayesModel:
    tokens: DataFrame
    pos_docs: int
    neg_docs: int
    pos_tokens: int
    neg_tokens: int
    vocabulary: int
    smoothing: float = 1.0

    @property
    def prior(self) -> float:
        return math.log(self.pos_docs) - math.log(self.neg_docs)

    def token_logs(self) -> DataFrame:
        """``token, pos_log, neg_log``."""
        a = self.smoothing

        def log_share(count: str, total: int):
            return F.ln((F.col(count) + F.lit(a)) / F.lit(total + a * self.vocabulary))

        return self.tokens.select(
            "token",
            log_share("pos_n", self.pos_tokens).alias("pos_log"),
            log_share("neg_n", self.neg_tokens).alias("neg_log"),
        )


def train(docs: DataFrame, path: str) -> None:
    """Count ``positive, terms`` per class and token and store the counts below ``path``."""
    spark = docs.sparkSession
    terms = term_rows(docs.select("positive", "terms"))
    positive = F.when(F.col("positive"), F.col("n")).otherwise(0)
    counts = terms.groupBy("token").agg(
        F.sum(positive).alias("pos_n"), F.sum(F.col("n") - positive).alias("neg_n")
    )
    counts.write.mode("overwrite").parquet(f"{path}/tokens")
    totals = spark.read.schema(TOKENS).parquet(f"{path}/tokens").agg(
        F.sum("pos_n"), F.sum("neg_n"), F.count(F.lit(1))
    )
    # reads the flag only: Spark prunes the texts behind it
    classes = docs.agg(
        F.count(F.when(F.col("positive"), 1)), F.count(F.when(~F.col("positive"), 1))
    )
    row = [*classes.first(), *[x or 0 for x in totals.first()]]
    spark.createDataFrame([row], SUMMARY).coalesce(1).write.mode("overwrite").parquet(f"{path}/summary")


def load(spark: SparkSession, path: str, smoothing: float = 1.0) -> NaiveBayesModel:
    summary = spark.read.schema(SUMMARY).parquet(f"{path}/summary").first()
    tokens = spark.read.schema(TOKENS).parquet(f"{path}/tokens")
    return NaiveBayesModel(tokens, *summary, smoothing=smoothing)


def score(docs: DataFrame, model: NaiveBayesModel, *keys: str) -> DataFrame:
    """``keys, margin, sentiment`` of documents with ``terms``.

    Tokens the model does not know add nothing; a document without a known token keeps
    its row and is decided by the prior. Whether the token table is broadcast or merged
    follows from its measured size; Spark splits a merge partition of a frequent token.
    """
    terms = docs.select(*keys, F.inline_outer("terms"))
    weight = F.coalesce(F.col("n") * (F.col("pos_log") - F.col("neg_log")), F.lit(0.0))
    margin = F.sum(weight) + F.lit(model.prior)
    return (
        terms.join(model.token_logs(), "token", "left")
        .groupBy(*keys)
        .agg(margin.alias("margin"))
        .withColumn("sentiment", F.when(F.col("margin") > 0, "positive").otherwise("negative"))
    )
