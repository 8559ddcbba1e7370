"""Vectors as rows of whole numbers: made by built-in functions, exact in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Doubles hold whole numbers up to this exactly.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


def whole_vectors(df: DataFrame, scale: int, id_col: str, vector_col: str, *others: str) -> DataFrame:
    """``(vec_id, v, ...)`` with v = floor(scale * x) as doubles; ``others`` follow under their names.

    Left out are null ids, null vectors and vectors with null, NaN or infinite components. A number
    too large for a long is whole in doubles already. Equal rows count once.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    own = {c: F.col(f"c{names.index(c)}") for c in (id_col, vector_col, *others)}
    vector = own[vector_col].cast("array<double>")
    # Null and NaN are not below infinity: NaN is above all numbers, null fails the test.
    usable = F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))

    def whole(x: Column) -> Column:
        y = x * F.lit(float(scale))
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    rows = plain.filter(own[id_col].isNotNull() & usable)
    return rows.select(
        own[id_col].cast("long").alias("vec_id"), F.transform(vector, whole).alias("v"), *[own[c].alias(c) for c in others]
    ).distinct()


def matrix(cells: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of lists of doubles; shorter ones are filled with zeros."""
    if isinstance(cells, pa.ChunkedArray):
        cells = cells.combine_chunks()
    values = np.asarray(cells.flatten(), np.float64)
    if len(values) == len(cells) * width:
        return values.reshape(len(cells), width)
    sizes = np.asarray(cells.value_lengths())
    out = np.zeros((len(cells), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def too_large(q: np.ndarray, x: np.ndarray) -> bool:
    """Whether inner products of rows of ``q`` and ``x`` may pass what doubles hold exactly."""
    return float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] >= EXACT / 256


def whole_numbers(m: np.ndarray) -> np.ndarray:
    """Python's own numbers, which keep every digit of a sum."""
    return np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)


def clipped(scores) -> np.ndarray:
    return np.array([min(max(int(s), -LONG - 1), LONG) for s in scores], np.int64)
