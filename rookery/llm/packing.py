"""Packing documents into fixed-length sequences by fitted length patterns."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rookery.llm.rows import Packed, arrow_schema, lean, materialise, slabs, text_bytes
from rookery.llm.word_ids import word_ids

MAX_LENGTH = 4096
END_ID = 1
# Lengths are rounded up to this for patterns, and a pattern has at most so many documents.
UNIT = 16
DEPTH = 3


def enumerated(units: int, depth: int) -> np.ndarray:
    """All patterns: 2 to ``depth`` rounded lengths, largest first, that fill a sequence; 0 for none."""
    found = []

    def fill(prefix: tuple[int, ...], left: int) -> None:
        if not left:
            found.append(prefix + (0,) * (depth - len(prefix)))
        elif len(prefix) < depth:
            top = min(left, prefix[-1] if prefix else units - 1)
            for part in range(top, -(-left // (depth - len(prefix))) - 1, -1):
                fill((*prefix, part), left - part)

    fill((), units)
    return np.array(found, np.int64).reshape(-1, depth)


def fitted_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """Non-negative least squares (active set): repeats whose documents come closest to the histogram.

    Rows are weighted by length, as a short document left over is easy to place. ``rounds`` bounds
    the steps; a fit that stops early is still feasible, and what it leaves is packed as residuals.
    """
    units = len(histogram)
    weight = np.arange(units) / units
    target = histogram * weight
    matrix = np.zeros((units, len(patterns)))
    for part in patterns.T:
        np.add.at(matrix, (part, np.arange(len(patterns))), 1.0)
    matrix *= weight[:, None]
    x = np.zeros(len(patterns))
    passive: list[int] = []
    tolerance = 1e-9 * max(1.0, target.max(initial=0.0))
    for _ in range(rounds):
        gradient = matrix.T @ (target - matrix @ x)
        gradient[passive] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance or len(passive) >= units:
            break
        passive.append(best)
        while passive:
            some = matrix[:, passive]
            gram = some.T @ some
            gram[np.diag_indices_from(gram)] += 1e-10
            solved = np.linalg.solve(gram, some.T @ target)
            if solved.min() > 0:
                x[:] = 0
                x[passive] = solved
                break
            now = x[passive]
            low = solved <= 0
            step = (now[low] / np.maximum(now[low] - solved[low], 1e-300)).min()
            now = now + step * (solved - now)
            x[:] = 0
            x[passive] = np.maximum(now, 0)
            gone = {p for p, value, out in zip(passive, now, low) if out and value <= 1e-9}
            gone = gone or {passive[int(np.argmin(now))]}
            x[list(gone)] = 0
            passive = [p for p in passive if p not in gone]
    return x


class _Plan:
    """Placements ``(length, first rank, count, first sequence, offset)`` over counts, not documents."""

    def __init__(self, histogram: np.ndarray) -> None:
        self.left = histogram.astype(object)
        self.taken = np.zeros(len(histogram), object)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.open: dict[int, list[tuple[int, int, int]]] = {}  # space left: first sequence, count, used
        self.spaces: list[int] = []

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.rows.append((length, int(self.taken[length]), count, sequence, offset))
        self.taken[length] += count
        self.left[length] -= count

    def free(self, space: int, sequence: int, count: int, used: int) -> None:
        if space and count:
            if space not in self.open:
                self.open[space] = []
                bisect.insort(self.spaces, space)
            self.open[space].append((sequence, count, used))

    def take(self, at: int) -> tuple[int, int, int, int]:
        space = self.spaces[at]
        held = self.open[space]
        cell = held.pop()
        if not held:
            del self.open[space]
            self.spaces.pop(at)
        return (space, *cell)


def planned(histogram: np.ndarray, unit: int = UNIT, depth: int = DEPTH) -> np.ndarray:
    """Placements of all documents, given how many there are of each length 0 to the maximum.

    Fitted patterns come first, then best fit, longest first, of what is left into the spaces of all
    sequences. Both work on counts: the number of steps depends on the lengths alone.
    """
    most = len(histogram) - 1
    plan = _Plan(histogram)
    whole = int(plan.left[most])
    if whole:
        plan.put(most, whole, 0, 0)
        plan.sequences = whole
    units = -(-most // unit)
    rounded = np.zeros(units + 1)
    lengths = np.arange(1, most)
    np.add.at(rounded, -(-lengths // unit), np.asarray(plan.left[1:most], float))
    patterns = enumerated(units, depth)
    if len(patterns) and rounded.sum():
        counts = fitted_counts(patterns, rounded)
        bins = [list(range(min(most - 1, b * unit), (b - 1) * unit, -1)) for b in range(1, units + 1)]
        have = [0, *(sum(int(plan.left[n]) for n in b) for b in bins)]
        for i in np.argsort(-counts, kind="stable"):
            parts = [int(p) for p in patterns[i] if p]
            # To the nearest whole number, as far as there are documents.
            repeats = min(int(counts[i] + 0.5), *(have[p] // parts.count(p) for p in parts))
            if not repeats:
                continue
            pieces = [(plan.sequences, repeats, 0)]
            plan.sequences += repeats
            for p in parts:
                have[p] -= repeats
                pieces = _filled(plan, bins[p - 1], pieces)
            for first, count, used in pieces:
                plan.free(most - used, first, count, used)
    for length in range(most - 1, 0, -1):
        while plan.left[length]:
            at = bisect.bisect_left(plan.spaces, length)
            if at == len(plan.spaces):
                need = -(-int(plan.left[length]) // (most // length))
                plan.free(most, plan.sequences, need, 0)
                plan.sequences += need
                continue
            space, first, count, used = plan.take(at)
            n = min(count, int(plan.left[length]))
            plan.put(length, n, first, used)
            plan.free(space - length, first, n, used + length)
            plan.free(space, first + n, count - n, used)
    return np.array(plan.rows, np.int64).reshape(-1, 5)


def _filled(plan: _Plan, lengths: list[int], pieces: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Put one document of ``lengths``, longest first, into each sequence of ``pieces``."""
    done = []
    lengths = [n for n in lengths if plan.left[n]]
    for first, count, used in pieces:
        while count:
            while not plan.left[lengths[0]]:
                lengths.pop(0)
            n = min(count, int(plan.left[lengths[0]]))
            plan.put(lengths[0], n, first, used)
            done.append((first, n, used + lengths[0]))
            first, count = first + n, count - n
    return done


def token_pieces(
    packed: DataFrame, tokenizer: str, most: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """``(id, k1, k2, piece, start, length, ids_crc32, part, nth[, ids])``: texts as pieces of ids.

    ``nth`` counts the pieces of one length within the task ``part``.
    """
    kind = packed.schema["id"].dataType.simpleString()
    schema = f"id {kind}, k1 long, k2 long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    schema += ", ids binary" if with_ids else ""
    arrow = arrow_schema(schema)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), [0] * (most + 1)
        encoder = word_ids(tokenizer)
        for batch in batches:
            raw, at = text_bytes(batch.column("text"))
            for first, last in slabs(at):
                texts = [raw[a:b].tobytes() for a, b in zip(at[first:last].tolist(), at[first + 1 : last + 1].tolist())]
                rows, cells = [], []
                for n, ids in enumerate(encoder.of(texts), first):
                    ids += end
                    for piece, begin in enumerate(range(0, len(ids), 4 * most)):
                        own = ids[begin : begin + 4 * most]
                        length = len(own) // 4
                        cell = (piece, begin // 4, length, zlib.crc32(own), part, seen[length])
                        rows.append(n)
                        cells.append((*cell, own) if with_ids else cell)
                        seen[length] += 1
                keys = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("id", "k1", "k2")]
                columns = [pa.array(c, f.type) for c, f in zip(zip(*cells), list(arrow)[3:])]
                yield pa.RecordBatch.from_arrays([*keys, *columns], schema=arrow)

    return packed.select("id", "text", "k1", "k2").mapInArrow(lean(run), schema)


def pack(
    df: DataFrame,
    tokenizer: str,
    most: int = MAX_LENGTH,
    end_id: int = END_ID,
    unit: int = UNIT,
    depth: int = DEPTH,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset[, ids])``, one row per piece.

    ``tokenizer`` is the path of a tokenizers file on every executor; a document is its ids and then
    ``end_id``, cut into pieces of ``most`` ids. The driver sees the histogram of lengths alone, which
    has ``most`` numbers at any size, and plans on counts. Pieces find their places by their rank
    among those of their length: ranks are counted per task and added up over tasks, so a length
    that a third of the pieces has is nobody's group. Null texts count as empty and are one id.
    Repeated rows are packed as often as they are there. No rows give no rows.
    """
    pieces = materialise(token_pieces(Packed(df, id_col, text_col).frame, tokenizer, most, end_id, with_ids), "pieces")
    cells = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = materialise(cells.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "cells")
    histogram = np.zeros(most + 1, np.int64)
    for row in cells.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row per length
        histogram[row["length"]] = row["n"]
    plan = planned(histogram, unit, depth)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    lengths, ranks, sequences, offsets = plan[:, 0], plan[:, 1], plan[:, 3], plan[:, 4]
    starts = np.searchsorted(lengths, np.arange(most + 2))
    ranked = pieces.join(cells.select("part", "length", "before"), ["part", "length"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("nth"))
    names = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        length, rank = np.asarray(length), np.asarray(rank)
        at = np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        bounds = np.searchsorted(length[order], np.unique(length), side="left").tolist() + [len(order)]
        for first, last in zip(bounds, bounds[1:]):
            some = order[first:last]
            n = length[some[0]]
            own = slice(starts[n], starts[n + 1])
            at[some] = starts[n] + np.searchsorted(ranks[own], rank[some], side="right") - 1
        cells = [pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])]
        return pa.StructArray.from_arrays(cells, names=["sequence_id", "offset"])

    put = F.arrow_udf(place, "struct<sequence_id:long,offset:long>")
    ranked = ranked.withColumn("place", put("length", "rank"))
    return ranked.select(*names, "place.sequence_id", "place.offset")
