"""Sentences, with abbreviations learned from the texts themselves.

A type is a word without its final period. An abbreviation is a short type that hardly ever
stands without one: by the likelihood ratio of "its period belongs to it" (with probability
``CLOSE``) over "periods follow it as they follow any word", scaled down for length and for each
occurrence without a period, up for periods inside (Kiss and Strunk, 2006).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.functions.tokens import abbreviated

#: probability of a period after an abbreviation, and the least score of one
CLOSE, LEAST = 0.99, 0.3
#: types a list may have, the best ones; they become part of an expression
MOST = 500
#: words with periods inside and perhaps one after them
TYPE = r"\p{L}+(?:\.\p{L}+)*\.?"

_INNER = "﷓"


def type_counts(docs: DataFrame) -> DataFrame:
    """``type``, ``n``, ``n_period``: how often a lower-case type occurs, and with a period after it.

    Words are counted per task before the shuffle; the texts are read once.
    """
    words = docs.select(F.explode_outer(F.regexp_extract_all("text", F.lit(TYPE), F.lit(0))).alias("word"))
    words = words.where(F.col("word").isNotNull())
    ended = F.col("word").endswith(".")
    bare = F.when(ended, F.expr("substring(word, 1, length(word) - 1)")).otherwise(F.col("word"))
    typed = words.select(F.lower(bare).alias("type"), ended.cast("int").alias("period"))
    return typed.groupBy("type").agg(F.count("*").alias("n"), F.sum("period").alias("n_period"))


def scores(counts: DataFrame) -> DataFrame:
    """The types that occur with a period, with their ``score``; every one is scored by itself.

    The two corpus totals are one row and are joined to all types.
    """
    totals = counts.agg((F.sum("n_period") / F.sum("n")).alias("share"))
    both = counts.where("n_period > 0").join(F.broadcast(totals), F.lit(True))
    with_period, without = F.col("n_period"), F.col("n") - F.col("n_period")
    # a corpus in which every word has a period tells nothing: the share is kept below one
    share = F.least(F.col("share"), F.lit(1 - 1e-9))
    by_chance = with_period * F.log(share) + without * F.log(1 - share)
    belongs = with_period * F.log(F.lit(CLOSE)) + without * F.log(F.lit(1 - CLOSE))
    letters = F.length(F.replace("type", F.lit(".")))
    inner = F.length("type") - letters
    score = -2 * (by_chance - belongs) * F.exp(-letters) * (inner + 1) * F.pow(letters.cast("double"), -without)
    return both.select("type", "n", "n_period", score.alias("score"))


def abbreviations(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The types that are abbreviations in these texts."""
    return scores(type_counts(docs)).where(F.col("score") >= least)


def save_abbreviations(found: DataFrame, path: str, most: int = MOST) -> None:
    """Store the ``most`` types of highest score, ties by the type."""
    found.orderBy(F.desc("score"), "type").limit(most).write.mode("overwrite").parquet(path)


def load_abbreviations(spark: SparkSession, path: str) -> list[str]:
    """The stored types, ``MOST`` at most unless more were asked for."""
    rows = spark.read.schema("type string").parquet(path).collect()
    return sorted(r["type"] for r in rows)


def sentences(text: Column, abbreviations: list[str] = ()) -> Column:
    """The sentences of a text in order, without the white space between them.

    A sentence ends with periods, question or exclamation marks, perhaps with closing marks,
    before white space, and at empty lines. The period of an abbreviation ends none. A null
    text has none, white space alone neither.
    """
    marked = abbreviated(text, abbreviations, _INNER)
    parts = F.split(marked, r"(?<=[.!?][\"'”’)\]]{0,2})\s+|\s*\n\s*\n\s*")
    whole = F.transform(parts, lambda s: F.replace(F.regexp_replace(s, r"^\s+|\s+$", ""), F.lit(_INNER), F.lit(".")))
    return F.filter(whole, lambda s: s != "")
