"""Article deduplication, selection of unprocessed news, newest articles per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_copies(articles: DataFrame, order: str, *keys: str) -> DataFrame:
    """One row per key: the one with the smallest ``order``, which must be unique.

    The copies are reduced to a key and a number before anything is shuffled, so many
    copies of one article cost one row per task; texts take no part in the grouping.
    """
    keep = articles.groupBy(*keys).agg(F.min(order).alias(order)).select(order)
    return articles.join(keep, order, "left_semi")


def text_number(text: Column) -> Column:
    """A number that stands for a text: to choose among texts without sorting them."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def one_address(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """Candidates whose page was fetched, one address per identity: the one of smallest number.

    No text takes part: an identity delivered under many addresses is one row per task
    before the shuffle. Candidates and pages hold an address once.
    """
    fetched = candidates.join(pages.where(F.col("html").isNotNull()).select("url"), "url", "left_semi")
    numbered = fetched.withColumn("number", text_number(F.col("url")))
    least = numbered.groupBy("guid").agg(F.min("number").alias("number"))
    return numbered.join(least, ["guid", "number"], "left_semi").select(candidates.columns)


def not_stored(articles: DataFrame, store: DataFrame) -> DataFrame:
    """Articles whose identity is not in the store."""
    keys = ["guid", "pub_date"]
    return articles.join(store.select(keys), keys, "left_anti").select(articles.columns)


def unseen(articles: DataFrame, store: DataFrame, order: str) -> DataFrame:
    """Articles whose identity is not in the store, each once: the copy with the smallest ``order``.

    Copies are reduced to a number per identity, then the store is looked up, and only then
    the chosen rows are read with their texts.
    """
    first = articles.groupBy("guid", "pub_date").agg(F.min(order).alias(order))
    return articles.join(not_stored(first, store).select(order), order, "left_semi")


def open_days(news: DataFrame, processed: DataFrame, run_date: Column) -> DataFrame:
    """Days before ``run_date`` with more stored than processed articles.

    Counting per day reads the partition column only, so no day that is finished has its
    articles looked at. Both tables hold an article once.
    """
    stored = news.where(F.col("pub_date") < run_date).groupBy("pub_date").agg(F.count(F.lit(1)).alias("stored"))
    done = processed.groupBy("pub_date").agg(F.count(F.lit(1)).alias("done"))
    more = F.col("stored") > F.coalesce("done", F.lit(0))
    return stored.join(done, "pub_date", "left").where(more).select("pub_date")


def open_news(news: DataFrame, processed: DataFrame, run_date: Column) -> DataFrame:
    """Articles of days before ``run_date`` that no earlier run has processed."""
    closed = news.where(F.col("pub_date") < run_date)
    done = processed.where(F.col("pub_date") < run_date).select("guid", "pub_date")
    return closed.join(done, ["guid", "pub_date"], "left_anti")


def newest_per_symbol(news: DataFrame, n: int, tie_break: str = "guid") -> DataFrame:
    """The ``n`` newest articles of every symbol.

    Spark keeps at most ``n`` rows per symbol and task before the shuffle, so a popular
    symbol does not reach a single task whole.
    """
    newest = Window.partitionBy("symbol").orderBy(F.col("pub_date").desc(), F.col(tie_break))
    return news.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= n)
