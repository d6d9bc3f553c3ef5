"""Price models of Spark ML: one distributed regressor per target, stored and reloaded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.operators.features import complete_rows, load_ranges, save_ranges, scaled
from newstide.schemas import FEATURES, TARGETS

Regressor = Callable[[str], Estimator]


def linear(target: str) -> Estimator:
    return LinearRegression(
        featuresCol="features", labelCol=target, predictionCol=f"predicted_{target}", solver="normal"
    )


def boosted_trees(target: str, rounds: int = 20, depth: int = 3) -> Estimator:
    return GBTRegressor(
        featuresCol="features",
        labelCol=target,
        predictionCol=f"predicted_{target}",
        maxIter=rounds,
        maxDepth=depth,
        seed=7,
    )


def train(rows: DataFrame, path: str, previous: str | None = None, regressor: Regressor = linear) -> None:
    """Fit on the complete rows and store ranges and models below ``path``.

    A regressor starts anew on all rows, whatever model is at ``previous``.
    """
    rows = complete_rows(rows)
    save_ranges(rows, f"{path}/ranges")
    inputs = scaled(rows, load_ranges(rows.sparkSession, f"{path}/ranges"))
    stages = [VectorAssembler(inputCols=FEATURES, outputCol="features"), *map(regressor, TARGETS)]
    Pipeline(stages=stages).fit(inputs.select(*FEATURES, *TARGETS)).write().overwrite().save(f"{path}/model")


def score(rows: DataFrame, path: str) -> DataFrame:
    """Add the four predictions; the stored model is only read."""
    model = PipelineModel.load(f"{path}/model")
    keys = [c for c in rows.columns if c not in FEATURES and c not in TARGETS]
    inputs = scaled(rows, load_ranges(rows.sparkSession, f"{path}/ranges"))
    predictions = [F.col(f"predicted_{t}").alias(t) for t in TARGETS]
    return model.transform(inputs.select(*keys, *FEATURES)).select(*keys, *predictions)


def open_lines(rows: DataFrame) -> DataFrame:
    """Least-squares line of every target on the opening price, in one pass."""
    fits = [
        f(F.col(t), F.col("open")).alias(f"{t}_{name}")
        for t in TARGETS
        for name, f in (("slope", F.regr_slope), ("intercept", F.regr_intercept))
    ]
    return rows.agg(*fits)
