"""Batch outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rookery.operators.tokens import pairs_as_text


def write_lines(df: DataFrame, path: str) -> None:
    """A one-column text frame, one line per row."""
    df.write.mode("overwrite").text(path)


def write_pairs_text(
    pairs: DataFrame, path: str, key: str = "word", count: str = "count"
) -> None:
    """``(word,count)`` lines, in the order of ``pairs``."""
    write_lines(pairs_as_text(pairs, key, count), path)


def write_parquet(df: DataFrame, path: str, cols: Sequence[str] | None = None) -> None:
    (df.select(*cols) if cols else df).write.mode("overwrite").parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Registers ``df`` in its own session, which inside a micro-batch is not the driver's."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
