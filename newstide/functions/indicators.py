"""Daily sentiment indicators, from the numbers of positive and other articles.

With ``p`` positive and ``n`` other articles of a symbol on a day:

* bullishness            ``b = (p - n) / (p + n)``, 0 without articles
* message-weighted       ``b * ln(1 + p + n)``
* agreement              ``1 - sqrt(1 - b**2)``
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bullish(pos_n: Column, neg_n: Column) -> Column:
    total = pos_n + neg_n
    share = (pos_n - neg_n).cast("double") / total
    return F.when(total != 0, share).otherwise(F.lit(0.0))


def bullish_all_posts(b: Column, pos_n: Column, neg_n: Column) -> Column:
    return b * F.log1p((pos_n + neg_n).cast("double"))


def agreement(b: Column) -> Column:
    return F.lit(1.0) - F.sqrt(F.lit(1.0) - b * b)


def day_label(b: Column) -> Column:
    return F.when(b > 0, "positive").when(b < 0, "negative").otherwise("neutral")


def sentiment_flag(sentiment: Column) -> Column:
    """1 for a positive day, 0 for a negative **and** for a neutral one."""
    return F.when(sentiment == "positive", 1).otherwise(0)


def min_max_scaled(value: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a feature that never varies becomes 0."""
    return F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.0))
