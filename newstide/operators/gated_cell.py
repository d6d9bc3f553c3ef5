"""A gated recurrent cell over one time step: scored as a column expression, trained by gradients.

The sequence length is one and the state starts at zero, so the recurrent weights and
the forget gate never act and the network is
``h = sigmoid(x Wo + bo) * tanh(sigmoid(x Wi + bi) * tanh(x Wg + bg))``, ``y = h Wd + bd``.

The parameters are a fixed 1,104 numbers. A training step adds up the gradient over all
rows, one partial sum per task, and the driver moves the parameters: the same steps for
every number of rows or tasks, and rows never leave the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from newstide.operators.features import complete_rows, load_ranges, save_ranges, scaled
from newstide.schemas import FEATURES, TARGETS

UNITS = 50
N_IN, N_OUT = len(FEATURES), len(TARGETS)
# kernel and bias of the three gates side by side (input, candidate, output), then of the output layer
SHAPES = [(N_IN, 3 * UNITS), (3 * UNITS,), (UNITS, N_OUT), (N_OUT,)]
ENDS = np.cumsum([int(np.prod(s)) for s in SHAPES])
N_PARAMETERS = int(ENDS[-1])
PARAMETERS = "position int, value double"


def unpack(flat: np.ndarray) -> list[np.ndarray]:
    """Views of the kernels and biases."""
    return [flat[end - int(np.prod(s)) : end].reshape(s) for s, end in zip(SHAPES, ENDS)]


def initial_parameters(seed: int = 7) -> np.ndarray:
    """Glorot-uniform kernels and zero biases."""
    rng = np.random.default_rng(seed)
    flat = np.zeros(N_PARAMETERS)
    gates, _, output, _ = unpack(flat)
    # the gates are three of four that share a kernel, which sets their fan-out
    for kernel, fan_out in ((gates, 4 * UNITS), (output, N_OUT)):
        limit = np.sqrt(6.0 / (kernel.shape[0] + fan_out))
        kernel[:] = rng.uniform(-limit, limit, kernel.shape)
    return flat


def forward(x: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, tuple]:
    w, b, wd, bd = unpack(flat)
    z = x @ w + b
    i = 0.5 + 0.5 * np.tanh(0.5 * z[:, :UNITS])  # the logistic function
    g = np.tanh(z[:, UNITS : 2 * UNITS])
    o = 0.5 + 0.5 * np.tanh(0.5 * z[:, 2 * UNITS :])
    c = np.tanh(i * g)
    h = o * c
    return h @ wd + bd, (i, g, o, c, h, wd)


def loss_gradient(x: np.ndarray, y: np.ndarray, flat: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum over rows of the squared error, averaged over outputs, and its gradient."""
    out, (i, g, o, c, h, wd) = forward(x, flat)
    error = out - y
    d_out = error * (2.0 / N_OUT)
    d_h = d_out @ wd.T
    d_s = d_h * o * (1 - c * c)
    d_z = np.hstack([d_s * g * i * (1 - i), d_s * i * (1 - g * g), d_h * c * o * (1 - o)])
    gradient = np.empty(N_PARAMETERS)
    w, b, wd, bd = unpack(gradient)
    w[:], b[:], wd[:], bd[:] = x.T @ d_z, d_z.sum(0), h.T @ d_out, d_out.sum(0)
    return float((error * error).sum() / N_OUT), gradient


class Adam:
    """Parameters with the optimizer's moments."""

    def __init__(self, flat: np.ndarray, rate: float):
        self.flat, self.rate, self.steps = flat.copy(), rate, 0
        self.m, self.v = np.zeros_like(flat), np.zeros_like(flat)

    def step(self, gradient: np.ndarray) -> None:
        self.steps += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient * gradient - self.v)
        size = self.rate / (1 - 0.9**self.steps)
        self.flat -= size * self.m / (np.sqrt(self.v / (1 - 0.999**self.steps)) + 1e-7)


def _summed(rows: DataFrame, flat: np.ndarray) -> tuple[float, np.ndarray, float]:
    """Loss and gradient over all rows, and their number: one partial sum per task."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(N_PARAMETERS + 2)
        for batch in batches:
            x, y = batch[FEATURES].to_numpy(float), batch[TARGETS].to_numpy(float)
            loss, gradient = loss_gradient(x, y, flat)
            total += np.concatenate([gradient, [loss, len(x)]])
        yield pd.DataFrame({"position": np.arange(len(total), dtype="int32"), "value": total})

    sums = rows.mapInPandas(partial, PARAMETERS).groupBy("position").agg(F.sum("value").alias("value"))
    total = np.zeros(N_PARAMETERS + 2)
    for position, value in sums.collect():  # a fixed number of rows
        total[position] = value
    return float(total[-2]), total[:N_PARAMETERS], float(total[-1])


def train(
    rows: DataFrame, path: str, previous: str | None = None, steps: int = 100, rate: float = 0.05
) -> list[float]:
    """Adam on the mean squared error of the complete rows; the loss before every step.

    The result goes below ``path``. Training goes on from the parameters of the model at
    ``previous``, if there is one.
    """
    spark, rows = rows.sparkSession, complete_rows(rows)
    save_ranges(rows, f"{path}/ranges")
    columns = [F.col(c).cast("double") for c in FEATURES + TARGETS]
    inputs = scaled(rows, load_ranges(spark, f"{path}/ranges")).select(*columns)
    inputs = inputs.persist(StorageLevel.MEMORY_AND_DISK)  # a lost block is computed again
    start = initial_parameters() if previous is None else load_parameters(spark, f"{previous}/parameters")
    adam, losses = Adam(start, rate), []
    try:
        for _ in range(steps):
            loss, gradient, number = _summed(inputs, adam.flat)
            if not number:
                raise ValueError("no complete rows to train on")
            losses.append(loss / number)
            adam.step(gradient / number)
    finally:
        inputs.unpersist()
    save_parameters(spark, adam.flat, f"{path}/parameters")
    return losses


def save_parameters(spark: SparkSession, flat: np.ndarray, path: str) -> None:
    frame = spark.createDataFrame([(i, float(x)) for i, x in enumerate(flat)], PARAMETERS)
    frame.coalesce(1).write.mode("overwrite").parquet(path)


def load_parameters(spark: SparkSession, path: str) -> np.ndarray:
    flat = np.zeros(N_PARAMETERS)
    for position, value in spark.read.schema(PARAMETERS).parquet(path).collect():
        flat[position] = value
    return flat


def outputs(x: list[Column], flat: np.ndarray) -> Column:
    """The array of predictions from scaled features: a sum over the units, in the JVM."""
    w, b, wd, bd = unpack(flat)
    units = F.lit([[*w[:, u :: UNITS].T.ravel().tolist(), *b[u::UNITS].tolist(), *wd[u].tolist()] for u in range(UNITS)])
    bias = 3 * N_IN

    def gate(unit: Column, number: int) -> Column:
        terms = [F.get(unit, F.lit(number * N_IN + k)) * x[k] for k in range(N_IN)]
        return sum(terms, F.get(unit, F.lit(bias + number)))

    def logistic(z: Column) -> Column:
        return 1 / (1 + F.exp(-z))

    def state(unit: Column) -> Column:
        return logistic(gate(unit, 2)) * F.tanh(logistic(gate(unit, 0)) * F.tanh(gate(unit, 1)))

    def shares(unit: Column) -> Column:
        return F.transform(F.slice(unit, bias + 4, N_OUT), lambda share: share * state(unit))

    def added(totals: Column, unit: Column) -> Column:
        return F.zip_with(totals, shares(unit), lambda a, b: a + b)

    return F.aggregate(units, F.lit(bd.tolist()), added)


def score(rows: DataFrame, path: str) -> DataFrame:
    """Add the four predictions to feature rows; the stored model is only read."""
    spark = rows.sparkSession
    keys = [c for c in rows.columns if c not in FEATURES and c not in TARGETS]
    inputs = scaled(rows, load_ranges(spark, f"{path}/ranges"))
    found = outputs([F.col(c).cast("double") for c in FEATURES], load_parameters(spark, f"{path}/parameters"))
    each = inputs.select(*keys, found.alias("found"))
    return each.select(*keys, *[F.get("found", F.lit(i)).alias(t) for i, t in enumerate(TARGETS)])
