"""The default price model, fitted from sums that are kept per day.

A day's rows are reduced once to the numbers a fit depends on: how many there are, the range of
every feature, and the sums of the products of features with features and with targets. A run
reads the rows of the days that have changed, replaces their sums, and solves the model from
the table of sums, a row per day. The sums are those of the plain features; scaling is linear,
so what the scaled ones would add up to follows from them and the ranges.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.operators.features import RANGES, complete_rows
from newstide.operators.least_squares import N_TERMS, save_weights, solved, terms
from newstide.schemas import FEATURES, TARGETS
from newstide.sinks.tables import replace_batch

PAIRS = [(i, j) for i in range(N_TERMS) for j in range(i, N_TERMS)]


def day_sums(rows: DataFrame) -> DataFrame:
    """``pub_date``, ``n``, ``lows``, ``highs``, ``sums``: one row per day with complete rows."""
    own, targets = terms(), [F.col(t).cast("double") for t in TARGETS]
    products = [own[i] * own[j] for i, j in PAIRS] + [x * y for x in own for y in targets]
    named = {
        "lows": [F.min(x) for x in own[1:]], "highs": [F.max(x) for x in own[1:]], "sums": [F.sum(p) for p in products],
    }
    flat = [c.alias(f"{name}_{i}") for name, columns in named.items() for i, c in enumerate(columns)]
    found = complete_rows(rows).groupBy("pub_date").agg(F.count("*").alias("n"), *flat)
    arrays = [F.array(*(F.col(f"{name}_{i}") for i in range(len(columns)))).alias(name) for name, columns in named.items()]
    return found.select("n", *arrays, "pub_date")


def update(rows: DataFrame, table: str, batch_id: str) -> None:
    """Enter the sums of whole days; a day that is entered again counts as in its newest batch."""
    replace_batch(day_sums(rows), table, batch_id, "pub_date")


def newest(sums: DataFrame) -> DataFrame:
    """Each day's sums as entered last."""
    row = F.max_by(F.struct("n", "lows", "highs", "sums"), "batch_id").alias("day")
    return sums.groupBy("pub_date").agg(row).select("pub_date", "day.*")


def added_up(days: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lows, highs and sums over all days: one row of fixed width."""
    count, width = len(FEATURES), len(PAIRS) + N_TERMS * len(TARGETS)
    total = days.agg(
        *[F.min(F.col("lows")[i]) for i in range(count)],
        *[F.max(F.col("highs")[i]) for i in range(count)],
        *[F.sum(F.col("sums")[i]) for i in range(width)],
    ).first()
    numbers = np.array([x or 0.0 for x in total])
    return numbers[:count], numbers[count : 2 * count], numbers[2 * count :]


def train(sums: DataFrame, path: str) -> None:
    """Fit on the days of a table of sums and store ranges and weights as ``least_squares`` does.

    No day gives a model that predicts 0.
    """
    spark = sums.sparkSession
    lows, highs, numbers = added_up(newest(sums))
    gram = np.zeros((N_TERMS, N_TERMS))
    for (i, j), value in zip(PAIRS, numbers):
        gram[i, j] = gram[j, i] = value
    products = numbers[len(PAIRS) :].reshape(N_TERMS, len(TARGETS))
    # a scaled feature is (x - low) / (high - low), a constant one 0: a matrix on the terms
    scaling = np.zeros((N_TERMS, N_TERMS))
    scaling[0, 0] = 1.0
    for k, (low, high) in enumerate(zip(lows, highs), start=1):
        if high > low:
            scaling[k, k], scaling[k, 0] = 1 / (high - low), -low / (high - low)
    save_weights(spark, solved(scaling @ gram @ scaling.T, scaling @ products), path)
    ranges = [(c, float(low), float(high)) for c, low, high in zip(FEATURES, lows, highs)]
    spark.createDataFrame(ranges, RANGES).coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")
