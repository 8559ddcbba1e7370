"""Expressions over ``array<double>`` features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this many terms the expression is folded over the array instead of written out.
_UNROLL_TERMS = 256


def is_complete(features: Column, dims: int) -> Column:
    """Whether there are exactly ``dims`` numbers; false for null, short, long and holed features."""
    if dims <= _UNROLL_TERMS:
        usable = F.size(features) == dims
        for i in range(dims):
            x = F.get(features, F.lit(i))
            usable = usable & x.isNotNull() & ~F.isnan(x)
    else:
        usable = (F.size(features) == dims) & F.forall(features, lambda x: x.isNotNull() & ~F.isnan(x))
    return F.coalesce(usable, F.lit(False))


def squared_distance(features: Column, centre: Sequence[float], unroll: bool = True) -> Column:
    if unroll:
        total = F.lit(0.0)
        for i, c in enumerate(centre):
            gap = F.get(features, F.lit(i)) - F.lit(float(c))
            total = total + gap * gap
        return total
    gaps = F.zip_with(features, F.lit([float(c) for c in centre]), lambda x, c: (x - c) * (x - c))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g)


def nearest_centre(features: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Index of the closest centre; ties go to the lowest index, unreadable features to none."""
    unroll = sum(len(c) for c in centres) <= _UNROLL_TERMS
    ranked = [
        F.struct(squared_distance(features, c, unroll).alias("d"), F.lit(j).alias("j"))
        for j, c in enumerate(centres)
    ]
    return F.when(is_complete(features, len(centres[0])), F.array_min(F.array(*ranked))["j"])


def dot(features: Column, weights: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for i, w in enumerate(weights):
        total = total + F.get(features, F.lit(i)) * F.lit(float(w))
    return total
