"""Online linear regression by gradient descent, and feature scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rookery.functions.vectors import dot, is_complete

# Features of the model and defaults of the trainer.
FEATURES = 1
STEP = 0.1
ITERATIONS = 50
TOLERANCE = 0.001
# The intercept every batch starts from.
INTERCEPT_START = 1.0

WEIGHT_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("weights", T.ArrayType(T.DoubleType(), False), False),
        T.StructField("intercept", T.DoubleType(), False),
    ]
)


@dataclass(frozen=True)
class LinearState:
    weights: tuple[float, ...]
    intercept: float = 0.0
    batch_id: int = -1

    @staticmethod
    def zeros(features: int = FEATURES) -> LinearState:
        return LinearState((0.0,) * features)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.batch_id, list(self.weights), self.intercept)], WEIGHT_SCHEMA
        )

    @staticmethod
    def from_df(df: DataFrame) -> LinearState:
        row = df.first()
        return LinearState(tuple(row.weights), row.intercept, row.batch_id)


def sufficient_stats(points: DataFrame, features: int = FEATURES) -> DataFrame:
    """One row: ``n``, ``s_y`` and, per feature, ``s_x*``, ``s_xy*`` and the products ``s_xx*_*``.

    Gradient steps over the whole batch depend on the points only through these sums. Rows without
    a label or without whole features are no points.
    """
    points = points.filter(
        F.col("label").isNotNull() & ~F.isnan("label") & is_complete(F.col("features"), features)
    )
    x = [F.get("features", F.lit(i)) for i in range(features)]
    y = F.col("label")
    columns = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("s_y")]
    for i in range(features):
        columns += [F.sum(x[i]).alias(f"s_x{i}"), F.sum(x[i] * y).alias(f"s_xy{i}")]
        columns += [F.sum(x[i] * x[j]).alias(f"s_xx{i}_{j}") for j in range(i, features)]
    return points.agg(*columns)


def descend(
    state: LinearState,
    stats: Row,
    step: float = STEP,
    iterations: int = ITERATIONS,
    tolerance: float = TOLERANCE,
    carry_intercept: bool = False,
) -> LinearState:
    """Gradient steps of size ``step / sqrt(i)`` on the sums of one batch."""
    if not stats["n"]:
        return state
    d, n = len(state.weights), stats["n"]
    gram = np.zeros((d + 1, d + 1))
    moment = np.zeros(d + 1)
    for i in range(d):
        gram[i, d] = gram[d, i] = stats[f"s_x{i}"]
        moment[i] = stats[f"s_xy{i}"]
        for j in range(i, d):
            gram[i, j] = gram[j, i] = stats[f"s_xx{i}_{j}"]
    gram[d, d], moment[d] = n, stats["s_y"]
    current = np.array([*state.weights, state.intercept if carry_intercept else INTERCEPT_START])
    for i in range(1, iterations + 1):
        previous = current
        current = previous - step / np.sqrt(i) * (gram @ previous - moment) / n
        moved = np.linalg.norm(current - previous)
        if moved < tolerance * max(np.linalg.norm(current), 1.0):
            break
    return LinearState(tuple(current[:d].tolist()), float(current[d]), state.batch_id)


def linreg_update(state: LinearState, points: DataFrame, **options) -> LinearState:
    """One online step from a ``(label, features)`` batch: one aggregate, then the descent."""
    return descend(state, sufficient_stats(points, len(state.weights)).first(), **options)


def linreg_predict(state: LinearState, points: DataFrame) -> DataFrame:
    """Adds ``prediction``, beside the known label; null if the features are unreadable."""
    value = dot(F.col("features"), state.weights) + F.lit(state.intercept)
    whole = is_complete(F.col("features"), len(state.weights))
    return points.withColumn("prediction", F.when(whole, value))


@dataclass(frozen=True)
class Scaling:
    """Mean and greatest distance from it, per column."""

    means: dict[str, float]
    ranges: dict[str, float]


def fit_scaling(df: DataFrame, cols: Sequence[str]) -> Scaling:
    """One pass: the greatest distance from the mean follows from mean, min and max."""
    aggregates = []
    for c in cols:
        aggregates += [
            F.avg(c).alias(f"{c}_mean"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")
        ]
    row = df.agg(*aggregates).first()
    means, ranges = {}, {}
    for c in cols:
        mean = row[f"{c}_mean"]
        means[c] = 0.0 if mean is None else float(mean)
        far = 0.0 if mean is None else max(row[f"{c}_max"] - mean, mean - row[f"{c}_min"])
        ranges[c] = float(far) or 1.0
    return Scaling(means, ranges)


def scale(df: DataFrame, scaling: Scaling) -> DataFrame:
    """Each fitted column moved to mean 0 and into [-1, 1]."""
    return df.withColumns(
        {
            c: (F.col(c) - F.lit(scaling.means[c])) / F.lit(scaling.ranges[c])
            for c in scaling.means
        }
    )


def unscale(df: DataFrame, scaling: Scaling) -> DataFrame:
    return df.withColumns(
        {
            c: F.col(c) * F.lit(scaling.ranges[c]) + F.lit(scaling.means[c])
            for c in scaling.means
        }
    )


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return scale(df, fit_scaling(df, cols))
