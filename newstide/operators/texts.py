"""Documents to cleaned tokens and term counts. All steps are narrow but the spelling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.functions.porter import stem_words
from newstide.functions.tokens import ENGLISH_STOP_WORDS, content_words, token_counts
from newstide.operators.rows import exploded
from newstide.operators.spelling import CORRECTIONS, corrected_tokens, corrections


def with_tokens(docs: DataFrame, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """Replace ``text`` by ``tokens``: content words, not yet stemmed."""
    return docs.withColumn("tokens", content_words(F.col("text"), stop_words)).drop("text")


def with_stems(
    docs: DataFrame,
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    abbreviations: Sequence[str] = (),
) -> DataFrame:
    """Replace ``text`` by ``tokens``: content words, stemmed."""
    stems = stem_words(content_words(F.col("text"), stop_words, abbreviations))
    return docs.withColumn("tokens", stems).drop("text")


def with_corrected_stems(
    docs: DataFrame, words: DataFrame, folder: str, key: str = "doc_id", abbreviations: Sequence[str] = ()
) -> DataFrame:
    """Replace ``text`` by ``tokens``: content words, stemmed, then corrected.

    Stems and corrections are read several times, so both are written below ``folder``
    and the texts are worked through once.
    """
    spark, stemmed = docs.sparkSession, with_stems(docs, abbreviations=abbreviations)
    stemmed.write.mode("overwrite").parquet(f"{folder}/stems")
    stemmed = spark.read.schema(stemmed.schema).parquet(f"{folder}/stems")
    return corrected_stems(stemmed, words, folder, key)


def corrected_stems(stemmed: DataFrame, words: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Correct the ``tokens`` of a stored table; the corrections are written below ``folder``."""
    changes = corrections(distinct_tokens(stemmed), words)
    changes.write.mode("overwrite").parquet(f"{folder}/corrections")
    changes = stemmed.sparkSession.read.schema(CORRECTIONS).parquet(f"{folder}/corrections")
    return corrected_tokens(stemmed, changes, key)


def distinct_tokens(docs: DataFrame) -> DataFrame:
    return exploded(docs, token=F.col("tokens")).distinct()


def cleaned_text(docs: DataFrame) -> DataFrame:
    return docs.withColumn("cleaned", F.array_join("tokens", " ")).drop("tokens")


def with_terms(docs: DataFrame) -> DataFrame:
    """Replace ``tokens`` by ``terms``, the array of ``(token, n)``."""
    return docs.withColumn("terms", token_counts(F.col("tokens"))).drop("tokens")


def term_rows(docs: DataFrame) -> DataFrame:
    """One row per document and term."""
    rest = [c for c in docs.columns if c != "terms"]
    rows = exploded(docs, *rest, term=F.col("terms"))
    return rows.select(*rest, "term.token", "term.n")


def bag_of_words(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Term rows restricted to a vocabulary ``token``."""
    return term_rows(docs).join(vocabulary.select("token"), "token", "left_semi")
