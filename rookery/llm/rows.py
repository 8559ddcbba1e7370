"""What the operators of this package share: row identity, clash-free packing, bytes of Arrow text."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rookery.session import scratch_dir

# A step that works on arrays takes texts of about this many bytes at a time.
SLAB_BYTES = 1 << 20
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: lost executors redo nothing above.

    Sums per key that are joined back to their rows are written first, too: AQE splits a hot key of
    a join only if both sides come out of a plain exchange, not out of an aggregation.

    Spark removes the files of a shuffle once the driver has collected its owner as garbage. The
    owners end here, so the driver is asked to collect: a job of many steps then holds the files of
    one step, not of all.
    """
    spark, schema = df.sparkSession, df.schema
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete a table that ``materialise`` returned, once all that reads it is written itself."""
    spark = frame.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Packed:
    """A frame whose own columns are out of the way, whatever their names.

    ``frame`` has ``row`` (all columns as one struct), ``id``, ``text`` and two longs ``k1``, ``k2``
    that tell rows apart. Rows equal in id and text share the key, and every operator gives such
    rows the same result, so no unique id is asked for and a recomputed task makes the same keys.
    """

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        names = df.columns
        plain = df.toDF(*[f"c{i}" for i in range(len(names))])
        ident, text = F.col(f"c{names.index(id_col)}"), F.col(f"c{names.index(text_col)}")
        self.names = names
        self.text_at = names.index(text_col)
        self.frame = plain.select(
            F.struct(*plain.columns).alias("row"),
            ident.alias("id"),
            text.cast("string").alias("text"),
            F.xxhash64(ident).alias("k1"),
            F.xxhash64(ident, text).alias("k2"),
        )

    def unpack(self, frame: DataFrame, text: Column | None = None) -> DataFrame:
        """The first columns again under their first names; ``text`` replaces the text."""
        cells = [F.col(f"row.c{i}") for i in range(len(self.names))]
        if text is not None:
            cells[self.text_at] = text
        return frame.select(*[c.alias(f"c{i}") for i, c in enumerate(cells)]).toDF(*self.names)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n+1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slabs(offsets: np.ndarray, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer text stands alone."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = max(first + 1, min(last, n))
        yield first, last
        first = last


def give_back() -> None:
    """Return freed memory to the machine.

    Spark keeps a Python worker for the whole session, and allocators keep what a step has freed: a
    worker would hold the highest need of every step that it ever ran.
    """
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, whose task gives back what it has freed when it ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(schema))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in sorted arrays."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)
