"""Taking byte spans out of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.llm.rows import Packed, give_back

SPANS = "array<struct<a:int,b:int>>"


def merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as maximal spans in order; touching spans are one."""
    if not len(a):
        return a, b
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    first = np.flatnonzero(new)
    return a[first], b[np.append(first[1:], len(a)) - 1]


def per_text(spans: DataFrame) -> DataFrame:
    """``(k1, k2, spans)`` of rows ``(k1, k2, a, b)``, merged; as long as the text at most.

    Overlapping spans are merged on each task before the shuffle would carry them: equal rows are
    dropped first, and what is left of one text is bounded by that text.
    """
    lists = spans.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    @F.arrow_udf(SPANS)
    def union(column: pa.Array) -> pa.Array:
        out = []
        for row in column:
            cells = row.values
            a, b = (np.asarray(cells.field(i)).astype(np.int64) for i in (0, 1))
            a, b = merged(a, b)
            out.append([{"a": x, "b": y} for x, y in zip(a.tolist(), b.tolist())])
        kind = pa.struct([("a", pa.int32()), ("b", pa.int32())])
        return pa.array(out, pa.list_(kind))

    return lists.select("k1", "k2", union("spans").alias("spans"))


def _kept(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, cut in zip(texts, spans):
        if not text.is_valid:
            out.append(None)
            continue
        raw = text.as_py()
        raw = raw.encode() if isinstance(raw, str) else raw
        parts, last = [], 0
        for span in cut.as_py():
            parts.append(raw[last : span["a"]])
            last = span["b"]
        parts.append(raw[last:])
        out.append(b"".join(parts))
    kept = pa.array(out, pa.binary())
    del out
    give_back()
    return kept


def cut(packed: Packed, spans: DataFrame) -> DataFrame:
    """``packed.frame`` with ``spans`` (null if none) and ``kept``, the remaining bytes."""
    kept = F.arrow_udf(_kept, "binary")
    joined = packed.frame.join(per_text(spans), ["k1", "k2"], "left")
    # Texts that lose nothing do not go through Python.
    touched = F.when(F.col("spans").isNotNull(), F.col("text").cast("binary"))
    whole = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return joined.withColumn("kept", F.coalesce(kept(touched, F.col("spans")), whole))


def removed_bytes() -> Column:
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + (x["b"] - x["a"]))
    return F.coalesce(total, F.lit(0).cast("long"))


def removed_spans() -> Column:
    return F.coalesce(F.size("spans"), F.lit(0)).cast("long")
