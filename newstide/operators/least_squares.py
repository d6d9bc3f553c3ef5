"""The default price model: a linear function per target, all four fitted in one pass.

A fit needs the sums of the products of features with features and with targets, a fixed
45 numbers that Spark adds up; the small system they make is solved on the driver. The
model is a table of weights, and scoring is a column expression.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.operators.features import complete_rows, load_ranges, save_ranges, scaled
from newstide.schemas import FEATURES, TARGETS

WEIGHTS = "target string, weights array<double>"
N_TERMS = len(FEATURES) + 1


def terms() -> list[Column]:
    """The constant and the features."""
    return [F.lit(1.0), *[F.col(c).cast("double") for c in FEATURES]]


def train(rows: DataFrame, path: str, previous: str | None = None) -> None:
    """Fit on the complete rows and store ranges and weights below ``path``.

    Features that depend on each other share the weight of what they say in common. The
    fit is exact, so an earlier model at ``previous`` has nothing to add to its rows.
    """
    spark, rows = rows.sparkSession, complete_rows(rows)
    save_ranges(rows, f"{path}/ranges")
    inputs = scaled(rows, load_ranges(spark, f"{path}/ranges"))
    own, targets = terms(), [F.col(t).cast("double") for t in TARGETS]
    pairs = [(i, j) for i in range(N_TERMS) for j in range(i, N_TERMS)]
    sums = inputs.agg(
        *[F.sum(own[i] * own[j]) for i, j in pairs], *[F.sum(x * y) for x in own for y in targets]
    )
    numbers = np.array([x or 0.0 for x in sums.first()])
    gram = np.zeros((N_TERMS, N_TERMS))
    for (i, j), value in zip(pairs, numbers):
        gram[i, j] = gram[j, i] = value
    products = numbers[len(pairs) :].reshape(N_TERMS, len(TARGETS))
    save_weights(spark, solved(gram, products), path)


def solved(gram: np.ndarray, products: np.ndarray) -> np.ndarray:
    """The weights of least error and, among those, of least size."""
    return np.linalg.pinv(gram, rcond=1e-10, hermitian=True) @ products


def save_weights(spark: SparkSession, weights: np.ndarray, path: str) -> None:
    model = [(t, [float(w) for w in weights[:, k]]) for k, t in enumerate(TARGETS)]
    spark.createDataFrame(model, WEIGHTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")


def score(rows: DataFrame, path: str) -> DataFrame:
    """Add the four predictions; the stored model is only read."""
    spark = rows.sparkSession
    weights = {r.target: r.weights for r in spark.read.schema(WEIGHTS).parquet(f"{path}/weights").collect()}
    keys = [c for c in rows.columns if c not in FEATURES and c not in TARGETS]
    inputs = scaled(rows, load_ranges(spark, f"{path}/ranges"))
    own = terms()
    predictions = [
        sum((x * F.lit(w) for x, w in zip(own[1:], weights[t][1:])), F.lit(weights[t][0])).alias(t) for t in TARGETS
    ]
    return inputs.select(*keys, *predictions)
