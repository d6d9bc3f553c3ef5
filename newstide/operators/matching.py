"""Yesterday's news with today's prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newstide.schemas import BAR

INDICATORS = ["sentiment", "bullish_indicator", "bullish_indicator_all_posts", "agreement_indicator"]


def unmatched(daily: DataFrame, matched_days: DataFrame) -> DataFrame:
    """Daily sentiment that no earlier run has matched with its present articles.

    A day that has got more articles since counts as unmatched again.
    """
    keys = ["symbol", "pub_date", "articles"]
    counted = daily.withColumn("articles", F.col("pos_n") + F.col("neg_n"))
    return counted.join(matched_days.select(keys), keys, "left_anti")


def match_next_day(daily: DataFrame, bars: DataFrame) -> DataFrame:
    """Join the news of a day with the bar of the day after, same symbol.

    An equi-join on symbol and shifted day: Spark broadcasts a side it has measured to be
    small and merges otherwise. News without a bar on the very next day finds no partner.
    """
    shifted = daily.withColumn("bar_date", F.date_add("pub_date", 1))
    return shifted.join(bars.select("symbol", "bar_date", *BAR), ["symbol", "bar_date"]).drop("bar_date")


def next_bars(bars: DataFrame, max_gap: int) -> DataFrame:
    """``symbol``, ``pub_date``, ``bar_date``: the bar that each day leads to, on a symbol's own calendar.

    A bar answers the days since the symbol's bar before it, ``max_gap`` days at most: the
    calendar has a row per symbol and day, however the bars are spaced. Days after the last bar
    have no row yet. A symbol's bars are one per day, so its window is no longer than a calendar.
    """
    days = bars.select("symbol", "bar_date").distinct()
    before = F.lag("bar_date").over(Window.partitionBy("symbol").orderBy("bar_date"))
    first = F.greatest(F.coalesce(before, F.date_sub("bar_date", max_gap)), F.date_sub("bar_date", max_gap))
    answered = days.select("symbol", "bar_date", first.alias("first"))
    every = F.sequence("first", F.date_sub("bar_date", 1))
    return answered.select("symbol", F.explode(every).alias("pub_date"), "bar_date")


def match_next_bar(daily: DataFrame, bars: DataFrame, max_gap: int) -> DataFrame:
    """Join the news of a day with the symbol's first bar after it: Friday's with Monday's.

    Two equi-joins, on the calendar of the bars and then on the bar. News more than ``max_gap``
    days ahead of a bar finds none; with a gap of one day this is ``match_next_day``.
    """
    led = daily.join(next_bars(bars, max_gap), ["symbol", "pub_date"])
    return led.join(bars.select("symbol", "bar_date", *BAR), ["symbol", "bar_date"])


def matched_csv_rows(matched: DataFrame) -> DataFrame:
    """The matched dataset with the day as text, in the exchanged column order."""
    return matched.select(
        F.date_format("pub_date", "yyyy-MM-dd").alias("_pubDate"), "symbol", *INDICATORS, *BAR
    )


def last_matched(rows: DataFrame) -> DataFrame:
    """The newest copy of every symbol and day: a day is matched again when articles come late.

    Ordered by the run that matched it and, for a repeated run, by the batch that took it in.
    """
    keys = ["_pubDate", "symbol"]
    values = F.struct(*INDICATORS, *BAR)
    newest = F.max_by(values, F.struct("run_date", "batch_id")).alias("row")
    return rows.groupBy(*keys).agg(newest).select(*keys, "row.*")


def next_day_dataset(daily: DataFrame, bars: DataFrame) -> DataFrame:
    return match_next_day(daily, bars).select("pub_date", "symbol", *INDICATORS, *BAR)
