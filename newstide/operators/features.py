"""Model inputs: encoding, scaling with stored ranges, serving rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.functions.indicators import min_max_scaled, sentiment_flag
from newstide.operators.matching import INDICATORS, next_bars
from newstide.schemas import FEATURES, TARGETS

RANGES = "feature string, low double, high double"

Ranges = dict[str, tuple[float, float]]


def features_and_targets(matched: DataFrame) -> DataFrame:
    """Matched days with the label encoded; key, five features, four targets."""
    return matched.withColumn("sentiment", sentiment_flag(F.col("sentiment"))).select(
        "symbol", "pub_date", *FEATURES, *TARGETS
    )


def complete_rows(rows: DataFrame) -> DataFrame:
    """Rows that have every feature and every target: what a model may be trained on."""
    return rows.dropna(subset=[*FEATURES, *TARGETS])


def feature_ranges(features: DataFrame) -> DataFrame:
    """``feature, low, high``: five rows from one pass."""
    bounds = [f(c).cast("double").alias(f"{k}_{c}") for c in FEATURES for k, f in (("low", F.min), ("high", F.max))]
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col(f"low_{c}").alias("low"), F.col(f"high_{c}").alias("high"))
        for c in FEATURES
    ]
    return features.agg(*bounds).select(F.inline(F.array(*rows)))


def save_ranges(features: DataFrame, path: str) -> None:
    feature_ranges(features).coalesce(1).write.mode("overwrite").parquet(path)


def load_ranges(spark: SparkSession, path: str) -> Ranges:
    """The stored ranges; always five rows."""
    rows = spark.read.schema(RANGES).parquet(path).collect()
    return {r.feature: (r.low, r.high) for r in rows}


def scaled(features: DataFrame, ranges: Ranges) -> DataFrame:
    """Scale by the ranges of the training data, also when scoring."""
    low_high = {c: (F.lit(low).cast("double"), F.lit(high).cast("double")) for c, (low, high) in ranges.items()}
    return features.withColumns(
        {c: min_max_scaled(F.col(c).cast("double"), *low_high[c]) for c in FEATURES}
    )


def serving_rows(symbols: DataFrame, daily: DataFrame, bars: DataFrame, run_date: dt.date) -> DataFrame:
    """Yesterday's sentiment and today's opening price of every symbol that has both.

    The model pairs a day's news with the bar of the day after, so that bar, the one of
    ``run_date``, is what the row predicts.
    """
    yesterday = daily.where(F.col("pub_date") == F.lit(run_date - dt.timedelta(days=1)))
    opens = bars.where(F.col("bar_date") == F.lit(run_date)).select("symbol", "open")
    return (
        yesterday.join(symbols.select("symbol"), "symbol", "left_semi")
        .join(opens, "symbol")
        .withColumn("sentiment", sentiment_flag(F.col("sentiment")))
        .select("symbol", F.date_add("pub_date", 1).alias("target_date"), *INDICATORS, "open")
    )


def serving_rows_of_next_bar(
    symbols: DataFrame, daily: DataFrame, bars: DataFrame, run_date: dt.date, max_gap: int
) -> DataFrame:
    """The newest sentiment since each symbol's bar before ``run_date``, and that day's opening price.

    These are the days that training pairs with the bar of ``run_date`` when it takes the next bar.
    """
    recent = bars.where(F.col("bar_date").between(F.lit(run_date - dt.timedelta(days=max_gap)), F.lit(run_date)))
    led = next_bars(recent, max_gap).where(F.col("bar_date") == F.lit(run_date))
    known = daily.join(symbols.select("symbol"), "symbol", "left_semi").join(led, ["symbol", "pub_date"])
    newest = known.groupBy("symbol", "bar_date").agg(F.max_by(F.struct(*INDICATORS), "pub_date").alias("day"))
    opens = bars.where(F.col("bar_date") == F.lit(run_date)).select("symbol", "open")
    return (
        newest.select("symbol", F.col("bar_date").alias("target_date"), "day.*")
        .join(opens, "symbol")
        .withColumn("sentiment", sentiment_flag(F.col("sentiment")))
        .select("symbol", "target_date", *INDICATORS, "open")
    )
