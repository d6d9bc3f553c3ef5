"""Articles to daily sentiment, in mergeable counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.functions import indicators as ind


def daily_counts(classified: DataFrame) -> DataFrame:
    """``symbol, pub_date, pos_n, neg_n``; whatever is not positive counts as negative."""
    positive = F.when(F.col("sentiment") == "positive", 1).otherwise(0)
    return classified.groupBy("symbol", "pub_date").agg(
        F.sum(positive).alias("pos_n"), F.sum(1 - positive).alias("neg_n")
    )


def merged_counts(*counts: DataFrame) -> DataFrame:
    """Counts of several batches added up: any split gives what one run over all would."""
    columns = ["symbol", "pub_date", "pos_n", "neg_n"]
    every = reduce(DataFrame.unionByName, [c.select(columns) for c in counts])
    return every.groupBy("symbol", "pub_date").agg(
        F.sum("pos_n").alias("pos_n"), F.sum("neg_n").alias("neg_n")
    )


def with_indicators(counts: DataFrame) -> DataFrame:
    """Add the label and the three indicators to daily counts."""
    pos_n, neg_n, b = F.col("pos_n"), F.col("neg_n"), F.col("bullish_indicator")
    return (
        counts.withColumn("bullish_indicator", ind.bullish(pos_n, neg_n))
        .withColumn("sentiment", ind.day_label(b))
        .withColumn("bullish_indicator_all_posts", ind.bullish_all_posts(b, pos_n, neg_n))
        .withColumn("agreement_indicator", ind.agreement(b))
    )


def daily_sentiment(classified: DataFrame) -> DataFrame:
    return with_indicators(daily_counts(classified))
