"""Nested documents of bounded size.

Everything of one symbol in one array would put a popular symbol into a single row, so
a key's rows are spread over as many documents as its row count needs. The documents of
a key together hold all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.operators.rows import exploded


def nested(
    frame: DataFrame, keys: list[str], item: Column, spread: Column, name: str, aim: int = 1000
) -> DataFrame:
    """``keys, part, <name>`` with about ``aim`` items per document.

    ``spread`` is an evenly distributed non-negative number that depends on the row alone
    (say, a hash of its identity), so a row lands in the same document on every run.
    """
    # one small row per key: pre-aggregated before its shuffle
    parts = frame.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(aim)).alias("parts"))
    return (
        frame.select(*keys, item.alias("item"), spread.alias("spread"))
        .join(parts, keys)
        .groupBy(*keys, (F.col("spread") % F.col("parts")).alias("part"))
        .agg(F.array_sort(F.collect_list("item")).alias(name))
    )


def guid_spread(guid: Column) -> Column:
    """Identities are SHA-256 hex, so their first digits are spread evenly."""
    return F.conv(F.substring(guid, 1, 8), 16, 10).cast("bigint")


def news_item(is_new: Column) -> Column:
    return F.struct(
        F.col("guid"),
        F.date_format("pub_date", "yyyy-MM-dd").alias("_pubDate"),
        F.col("title").alias("_title"),
        F.col("symbol").alias("_symbol"),
        F.col("text").alias("_TextNew"),
        is_new.cast("int").alias("is_new"),
    )


def open_items(items: Column, run_date: Column) -> Column:
    """Unprocessed articles of closed days, inside the array."""
    return F.filter(items, lambda n: (n["is_new"] == 1) & (F.try_to_date(n["_pubDate"], "yyyy-MM-dd") < run_date))


def flattened(documents: DataFrame) -> DataFrame:
    """Nested documents back to flat news rows, without the flag."""
    n = F.col("n")
    return exploded(documents, n=F.col("listOfNews")).select(
        n["guid"].alias("guid"),
        n["_symbol"].alias("symbol"),
        F.try_to_date(n["_pubDate"], "yyyy-MM-dd").alias("pub_date"),
        n["_title"].alias("title"),
        n["_TextNew"].alias("text"),
    )
