"""Exact removal of long repeated byte strings by depth-limited radix passes over suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.llm import suffix_scan as scan
from rookery.llm.rows import Packed, arrow_schema, discard, lean, materialise, slabs, text_bytes
from rookery.llm.spans import cut, merged, removed_bytes, removed_spans

LENGTH = 400
_ROWS = "d0 long, d1 long, u long, k1 long, k2 long, start int, count int, back int"
_SINGLE = "d0 long, d1 long, d2 long, d3 long, k1 long, k2 long, start int, count int"
# Offsets fill 24 bits of a slab; longer texts are taken in pieces that overlap by a window.
_MOST = 8 << 20
_SLAB = 256 << 10


def _batch(found: scan.Ranges, k1, k2, shift, schema) -> pa.RecordBatch:
    cells = {f"d{i}": d.view(np.int64) for i, d in enumerate(found.digits)}
    cells |= {"u": found.whole.view(np.int64), "k1": k1, "k2": k2}
    cells |= {"start": found.start - shift, "count": found.count, "back": found.back}
    return pa.RecordBatch.from_arrays([pa.array(cells[f.name].astype(f.type.to_pandas_dtype())) for f in schema], schema=schema)


def _first_pass(texts: DataFrame, length: int) -> DataFrame:
    arrow = arrow_schema(_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_bytes(batch.column("text"))
            k1, k2 = (np.asarray(batch.column(c)) for c in ("k1", "k2"))
            for first, last in slabs(at, _SLAB):
                begin, end = at[first], at[last]
                for piece in range(begin, end, _MOST):
                    stop = min(end, piece + _MOST + length - 1)
                    own = at[first : last + 1] - piece if stop == end and piece == begin else np.array([0, stop - piece])
                    found = scan.runs(raw[piece:stop], own, length)
                    if len(found.row):
                        row = first + found.row
                        yield _batch(found, k1[row], k2[row], at[row] - piece, arrow)

    return texts.mapInArrow(lean(run), _ROWS)


def _next_pass(texts: DataFrame, length: int, single: bool) -> DataFrame:
    """Digits of narrower blocks; ``texts`` has ``cells``, the blocks of each text to be cut."""
    schema = _SINGLE if single else _ROWS
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_bytes(batch.column("text"))
            k1, k2 = (np.asarray(batch.column(c)) for c in ("k1", "k2"))
            for n, cells in enumerate(batch.column("cells")):
                start, count, back = (
                    np.asarray(cells.values.field(i)).astype(np.int64) for i in range(3)
                )
                order = np.argsort(start)
                start, count, back = start[order], count[order], back[order]
                text = raw[at[n] : at[n + 1]]
                # Neighbouring rows share one stretch of text, hashed once and never more of it.
                ends = start + count - 1 + length
                far = np.flatnonzero(start[1:] > ends[:-1]) + 1
                for part in np.split(np.arange(len(start)), far):
                    for few in np.array_split(part, -(-len(part) // 512)):
                        low, high = start[few[0]], ends[few].max()
                        piece = text[low:high]
                        if single:
                            found = scan.suffixes(piece, start[few] - low, count[few], length)
                        else:
                            found = scan.ranges(piece, start[few] - low, count[few], back[few], length)
                        one = np.ones(len(found.row), np.int64)
                        yield _batch(found, k1[n] * one, k2[n] * one, -low, arrow)

    return texts.select("k1", "k2", "text", "cells").mapInArrow(lean(run), schema)


def _dealt_anew(sums: DataFrame, key: list[str]) -> DataFrame:
    """``sums`` per ``key``, to be joined to their rows without being written first.

    AQE splits a hot key of a join only if both sides come out of a plain exchange. Sums are dealt out by
    their key already, which Spark cannot tell of an expression, so that it puts the exchange in.
    """
    return sums.select(*[F.col(c).bitwiseXOR(F.lit(0)).alias(c) if c in key else c for c in sums.columns])


def _radix(rows: DataFrame, digits: list[str], last: tuple[Column, ...] = ()) -> DataFrame:
    """The written ``rows`` that share all ``digits`` with another, most significant digit first.

    A pass deals the rows out by one more digit; rows that are alone in their group leave, so the next
    pass sees fewer. Groups are in the order of their digests, which is all that equal groups need.
    ``last`` are aggregates of the groups of the last pass, as columns of their rows. A pass is one
    written table: every file costs a process where Hadoop sets permissions by ``chmod``.
    """
    for n in range(1, len(digits) + 1):
        key = digits[:n]
        more = last if n == len(digits) else ()
        groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *more).filter("n > 1").drop("n")
        left = materialise(rows.join(_dealt_anew(groups, key), key), "suffixes")
        # What a pass has read is not needed by the next one: the disk holds two passes at most.
        discard(rows)
        rows = left
    return rows


def _settled(rows: DataFrame) -> DataFrame:
    """Blocks of a pass that stay: ``mark`` if all suffixes repeat, ``next`` if they have to be cut.

    Of blocks equal in their digits and as a whole one stands for all as a partner in the next pass, so
    thousands of copies cost as much as two.
    """
    key = ["d0", "d1"]
    rows = _radix(rows, key, ((F.min("u") < F.max("u")).alias("several"),))
    classes = rows.groupBy(*key, "u").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct("k1", "k2", "start")).alias("first")
    )
    mark = F.col("members") > 1
    stands = ~mark | (F.struct("k1", "k2", "start") == F.col("first"))
    settled = materialise(
        rows.join(_dealt_anew(classes, [*key, "u"]), [*key, "u"])
        .filter(mark | F.col("several"))
        .select("k1", "k2", "start", "count", "back", mark.alias("mark"), (F.col("several") & stands).alias("next")),
        "settled",
    )
    discard(rows)
    return settled


def _with_cells(texts: DataFrame, settled: DataFrame) -> DataFrame:
    cells = (
        settled.filter("next")
        .select("k1", "k2", "start", "count", "back")
        .distinct()
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("start", "count", "back")).alias("cells"))
    )
    return texts.select("k1", "k2", "text").join(cells, ["k1", "k2"])


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(k1, k2, a, b)``: byte spans that cover exactly the windows which start twice or more.

    ``texts`` is the frame of a ``Packed``. Suffixes are put in order through their first ``length``
    bytes by passes over digits, the most significant first, and equal groups are the repeated windows.
    A digit is a range of bytes, by 64 bits of digest. A row per byte and pass would be 30 times the
    input, so neighbouring suffixes with the same content anchor go as one block, about a hundred,
    whose digits are the bytes that they have in common. Blocks that share no digits hold no repeated
    window. Blocks that come out of the passes equal as a whole are groups of equal suffixes, one by
    one. The others are cut into blocks of 16 and, where these are not equal either, into single
    suffixes: their four digits are the whole window. So every repeated window comes out of a digit
    pass, that of its block or its own; the anchors only say which suffixes go together.
    """
    if length < 64:
        raise ValueError("a window has at least 64 bytes")
    first = _settled(materialise(_first_pass(texts.select("k1", "k2", "text"), length), "suffixes"))
    some = materialise(_with_cells(texts, first), "texts")
    second = _settled(materialise(_next_pass(some, length, False), "suffixes"))
    single = materialise(_next_pass(_with_cells(some, second), length, True), "suffixes")
    discard(some)
    third = _radix(single, [f"d{i}" for i in range(scan.DIGITS)])
    whole = first.filter("mark").union(second.filter("mark")).select("k1", "k2", "start", "count")
    return whole.union(third.select("k1", "k2", "start", "count")).select(
        "k1", "k2", F.col("start").alias("a"), (F.col("start") + F.col("count") + (length - 1)).alias("b")
    )


def remove_repeats(
    df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, text, spans, kept, n_bytes, n_removed, n_spans)`` for every row of ``df``.

    Every byte in a string of ``length`` bytes that starts at two or more places of the table goes,
    first places included; ``spans`` are byte offsets into the input and ``kept`` the other bytes.
    Null texts are empty. Shorter texts lose nothing. Rows repeated as a whole are copies of each
    other, so all their windows go. No rows give no rows; other columns do not matter.
    """
    packed = Packed(df, id_col, text_col)
    return cut(packed, repeated_spans(packed.frame, length)).select(
        "id", "text", "spans", "kept",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        removed_bytes().alias("n_removed"),
        removed_spans().alias("n_spans"),
    )


__all__ = ["LENGTH", "merged", "remove_repeats", "repeated_spans"]
