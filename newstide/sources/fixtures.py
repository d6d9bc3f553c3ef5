"""Adapters from the benchmark tables to articles, ticks and daily bars.

An article is a row of ``documents`` (symbol = source, one of 29 publication days), its
true sentiment is in ``labels``; a tick is a row of ``events`` (one of 20 symbols).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.functions.identity import article_guid

FIRST_DAY = "2024-01-01"
NEWS_DAYS = 29
TICK_SYMBOLS = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def published(doc_id: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), (doc_id % NEWS_DAYS).cast("int"))


def tick_symbol(user_id: Column) -> Column:
    return F.concat(F.lit("src"), (user_id % TICK_SYMBOLS).cast("string"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, guid, symbol, pub_date, title, text``; the title is the first line."""
    title = F.substring_index("text", "\n", 1)
    symbol, pub_date = F.col("source"), published(F.col("doc_id"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        article_guid(title, symbol, pub_date).alias("guid"),
        symbol.alias("symbol"),
        pub_date.alias("pub_date"),
        title.alias("title"),
        "text",
    )


def true_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, positive`` for the labelled articles."""
    return table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("positive"))


def classified_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, symbol, lang, pub_date, sentiment`` of the labelled articles, no text read."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.col("source").alias("symbol"), published(F.col("doc_id")).alias("pub_date")
    )
    label = F.when(F.col("positive"), "positive").otherwise("negative").alias("sentiment")
    return docs.join(true_sentiment(spark, sf_dir), "doc_id").select(
        "doc_id", "symbol", "lang", "pub_date", label
    )


def tick_rows(events: DataFrame, *extra: str) -> DataFrame:
    """Events, batch or streaming, as ticks ``symbol, ts, price, volume, seq``, and extra columns."""
    return events.select(
        tick_symbol(F.col("user_id")).alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.col("event_id").alias("seq"),
        *extra,
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_rows(table(spark, sf_dir, "events"))
