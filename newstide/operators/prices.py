"""Daily bars and what is missing from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_bars(ticks: DataFrame) -> DataFrame:
    """First, highest, lowest, last price and total volume per symbol and day.

    All aggregates keep a fixed number of values, so ticks are reduced to one row per
    symbol, day and task before the shuffle.
    """
    return ticks.groupBy("symbol", F.to_date("ts").alias("bar_date")).agg(
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"),
        F.sum("volume").alias("volume"),
    )


def new_bars(bars: DataFrame, stored: DataFrame) -> DataFrame:
    """Bars whose symbol **and** day are not stored yet, each once.

    Of several records for a day the one with the largest volume is kept.
    """
    keys = ["symbol", "bar_date"]
    values = [c for c in bars.columns if c not in keys]
    row = F.max(F.struct("volume", *[c for c in values if c != "volume"])).alias("row")
    once = bars.groupBy(*keys).agg(row).select(*keys, *[F.col("row")[c].alias(c) for c in values])
    return once.join(stored.select(keys), keys, "left_anti")


def latest_open(bars: DataFrame) -> DataFrame:
    """Opening price of every symbol's last day."""
    return bars.groupBy("symbol").agg(
        F.max("bar_date").alias("bar_date"), F.max_by("open", "bar_date").alias("open")
    )


def without_previous_day(bars: DataFrame) -> DataFrame:
    """Symbol and day of bars that have no bar on the day before."""
    days = bars.select("symbol", "bar_date")
    before = days.select("symbol", F.date_add("bar_date", 1).alias("bar_date"))
    return days.join(before, ["symbol", "bar_date"], "left_anti")
