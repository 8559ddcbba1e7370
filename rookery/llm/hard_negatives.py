"""Hard negatives by rotated one-bit codes: intervals from stored alignments, whole scores where they allow."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rookery.llm.rows import arrow_schema, materialise
from rookery.llm.vectors import clipped, matrix, too_large, whole_numbers, whole_vectors

SCALE = 256
# One-bit codes of a vector, each of what the ones before it leave over.
LEVELS = 4
# Bits of a query's numbers; each is a plane for the popcounts.
PLANES = 6
# What a task holds of candidates and of anchors, whatever the table's size.
SLICE_ROWS, ANCHOR_ROWS = 65_536, 16_384
SIDE_BYTES = 64 << 20
SEED = 7


def code_bits(width: int) -> int:
    """Numbers of a rotated vector: the next power of two, at least a word."""
    return max(64, 1 << (width - 1).bit_length()) if width else 64


def rotated(x: np.ndarray, bits: int, seed: int = SEED) -> np.ndarray:
    """Rows under a fixed rotation: signs and a Walsh-Hadamard transform, twice. Keeps inner products."""
    signs = np.random.default_rng(seed).integers(0, 2, (2, bits)) * 2.0 - 1
    y = np.zeros((len(x), bits))
    y[:, : x.shape[1]] = x
    for sign in signs:
        y *= sign
        size = 1
        while size < bits:
            pairs = y.reshape(len(y), -1, 2, size)
            y = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2).reshape(len(y), bits)
            size *= 2
        y /= np.sqrt(bits)
    return y


def codes_of(x: np.ndarray, bits: int, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words), their alignments (rows, levels) and the length of what is left over.

    A code is the signs of what is left of the rotated vector; its alignment, the mean of the absolute
    numbers, is the multiple of the code that comes nearest, so what is left is orthogonal to the code.
    """
    left = rotated(x, bits)
    codes, aligned = [], []
    for _ in range(levels):
        sign = left >= 0
        codes.append(np.packbits(sign, axis=1, bitorder="little").view(np.uint64))
        aligned.append(np.abs(left).mean(1))
        left -= np.where(sign, 1.0, -1.0) * aligned[-1][:, None]
    return np.stack(codes, 1), np.stack(aligned, 1), np.linalg.norm(left, axis=1)


class Query:
    """A rotated query in ``planes`` bits a number, and how far that may be off."""

    def __init__(self, x: np.ndarray, bits: int, planes: int) -> None:
        y = rotated(x[None, :], bits)[0]
        self.low = y.min()
        self.step = (y.max() - self.low) / ((1 << planes) - 1) or 1.0
        whole = np.rint((y - self.low) / self.step).astype(np.int64)
        # Signs are +1 or -1, so this bounds the error of a product with any code.
        self.off = np.abs(y - (self.low + self.step * whole)).sum()
        self.norm = np.linalg.norm(y)
        cut = (whole[None, :] >> np.arange(planes)[:, None]) & 1
        self.planes = np.packbits(cut.astype(bool), axis=1, bitorder="little").view(np.uint64)
        self.ones = int((whole).sum())


@dataclass
class Candidates:
    """A slice of the table in columns, ordered by label and id."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    codes: np.ndarray
    aligned: np.ndarray
    rest: np.ndarray
    bits: int

    @classmethod
    def of(cls, table: pa.Table, width: int, levels: int) -> Candidates:
        bits, n = code_bits(width), table.num_rows
        column = lambda name: np.asarray(table.column(name).combine_chunks())
        ids, labels = column("vec_id"), column("label")
        order = np.lexsort((ids, labels))
        raw = b"".join(table.column("codes").to_pylist())
        codes = np.frombuffer(raw, np.uint64).reshape(n, levels, bits // 64)
        aligned = matrix(table.column("aligned"), levels)[order]
        # What is left over after each level, from the last one back.
        squares = column("rest")[order, None] ** 2 + bits * np.cumsum((aligned**2)[:, ::-1], 1)[:, ::-1]
        rest = np.sqrt(np.column_stack((squares, column("rest")[order] ** 2)))
        codes = np.ascontiguousarray(codes[order].transpose(1, 0, 2))
        return cls(ids[order], labels[order], matrix(table.column("v"), width)[order], codes, aligned, rest, bits)

    def narrowed(self, query: Query, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Interval of the product with each of ``rows``, by one more level at a time.

        Popcounts give the product with the codes. What is left over is orthogonal to the last code,
        so by Cauchy and Schwarz it adds at most its length times the query's length off that code.
        After each level the caller sends back which rows stay.
        """
        estimate, off = np.zeros(len(rows)), np.zeros(len(rows))
        for level in range(len(self.codes)):
            code = self.codes[level][rows]
            counts = np.zeros(len(rows), np.int64)
            for j, plane in enumerate(query.planes):
                counts += np.bitwise_count(code & plane).sum(1, dtype=np.int64) << j
            set_bits = np.bitwise_count(code).sum(1, dtype=np.int64)
            product = query.low * (2 * set_bits - self.bits) + query.step * (2 * counts - query.ones)
            aligned = self.aligned[rows, level]
            estimate += aligned * product
            off += aligned * query.off
            along = np.maximum(np.abs(product) - query.off, 0) / np.sqrt(self.bits)
            across = np.sqrt(np.maximum(query.norm**2 - along**2, 0))
            slack = self.rest[rows, level + 1] * across + off
            slack += 1e-9 * (self.rest[rows, 0] * query.norm + 1)
            stay = yield estimate - slack, estimate + slack
            rows, estimate, off = rows[stay], estimate[stay], off[stay]

    def left(self, query: Query, rows: np.ndarray, stays) -> np.ndarray:
        """The rows that ``stays(low, high)`` keeps at every level."""
        levels = self.narrowed(query, rows)
        bounds = next(levels, None)
        while bounds is not None:
            stay = stays(*bounds)
            rows = rows[stay]
            try:
                bounds = levels.send(stay)
            except StopIteration:
                break
        return rows

    def scores(self, rows: np.ndarray, x: np.ndarray) -> np.ndarray:
        return (self.x[rows] @ x).astype(np.int64)


def _best(scores, ids, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by least id."""
    return np.lexsort((ids, ~scores))[:k]


def positives(c: Candidates, anchor: int, label: int, x: np.ndarray, k: int, planes: int = PLANES):
    """Ids and scores of the k best rows of the anchor's label, but not of its id."""
    first, last = np.searchsorted(c.labels, label, "left"), np.searchsorted(c.labels, label, "right")
    rows = np.arange(first, last)
    rows = rows[c.ids[rows] != anchor]

    def stays(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if len(low) <= k:
            return np.ones(len(low), bool)
        return high >= np.partition(low, len(low) - k)[len(low) - k]

    rows = c.left(Query(x, c.bits, planes), rows, stays)
    scores = c.scores(rows, x)
    best = _best(scores, c.ids[rows], k)
    return c.ids[rows[best]], scores[best]


def contenders(
    c: Candidates, anchor: int, label: int, x: np.ndarray, windows: np.ndarray, k: int, planes: int = PLANES
) -> np.ndarray:
    """Rows of other labels that may be among the k best of one of the score ``windows`` (low, high)."""
    windows = windows[windows[:, 0] <= windows[:, 1]]
    rows = np.flatnonzero((c.labels != label) & (c.ids != anchor)) if len(windows) else np.empty(0, np.int64)

    def stays(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), bool)
        for least, most in windows:
            sure = low[(low >= least) & (high <= most)]
            if len(sure) >= k:
                least = max(least, np.partition(sure, len(sure) - k)[len(sure) - k])
            keep |= (high >= least) & (low <= most)
        return keep

    return c.left(Query(x, c.bits, planes), rows, stays)


def _windows(scores: np.ndarray, low: int, high: int) -> np.ndarray:
    """Whole scores n with low * p <= 100 * n <= high * p, for each p."""
    return np.column_stack((-(-low * scores // 100), high * scores // 100))


def _plain(c: Candidates, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores without intervals, for numbers beyond what doubles hold."""
    return clipped(whole_numbers(c.x[rows]).dot(whole_numbers(x[None, :])[0]) if len(rows) else [])


def _coded(rows: DataFrame, width: int, levels: int) -> DataFrame:
    schema = "vec_id long, label long, v array<double>, codes binary, aligned array<double>, rest double"
    arrow, bits = arrow_schema(schema), code_bits(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, aligned, rest = codes_of(matrix(batch.column("v"), width), bits, levels)
            cells = [
                batch.column("vec_id"),
                batch.column("label"),
                batch.column("v"),
                pa.array([row.tobytes() for row in codes], pa.binary()),
                pa.array(aligned.tolist(), pa.list_(pa.float64())),
                pa.array(rest),
            ]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(cells, arrow)], schema=arrow)

    return rows.select("vec_id", "label", "v").mapInArrow(run, schema)


def _found(parts: list[tuple], arrow: pa.Schema) -> pa.Table:
    columns = list(zip(*parts)) if parts else [[] for _ in arrow]
    return pa.Table.from_arrays([pa.array(np.concatenate(x) if x else [], f.type) for x, f in zip(columns, arrow)], schema=arrow)


def hard_negatives(
    df: DataFrame,
    every: int = 100,
    positive_rows: int = 5,
    negative_rows: int = 5,
    low: int = 80,
    high: int = 100,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    levels: int = LEVELS,
    slice_rows: int = SLICE_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose id divides by ``every``. The score of a row is the inner product of
    floor(scale * x) with the anchor's; higher ones come first, equal ones by smaller id. An anchor's
    positives are its first ``positive_rows`` other rows of its label. For each, the first
    ``negative_rows`` rows of other labels with low * positive <= 100 * negative <= high * positive are
    returned; a positive without any gives no row, nor does one below zero.

    Vectors are rotated and stored as ``levels`` one-bit codes with their alignments. Blocks of anchors
    meet slices of rows in equality joins, once for the positives and once for the negatives; a pair of
    block and slice is one bounded task. There, popcounts bound each score by an interval, level by
    level. Rows stay while their interval allows a place, and what stays is scored in whole numbers, so
    nothing is lost. Each task sends a few rows per anchor, which a window ranks.

    Rows with a null id, label or vector, or a null, NaN or infinite component take no part. Shorter
    vectors count as filled with zeros. Rows repeated as a whole count once, and no row meets another
    of its own id. Where numbers are beyond what doubles hold, all rows of a slice are scored in Python's
    whole numbers; a score beyond a long counts as the nearest one. No rows give no rows.
    """
    rows = whole_vectors(df, scale, id_col, vector_col, label_col).toDF("vec_id", "v", "label")
    rows = materialise(rows.filter("label is not null").withColumn("label", F.col("label").cast("long")), "vectors")
    is_anchor = F.pmod("vec_id", F.lit(every)) == 0
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("a"), F.max(F.size("v")).alias("width")).first()
    width = seen["width"] or 0
    coded = materialise(_coded(rows, width, levels), "codes")
    cores = df.sparkSession.sparkContext.defaultParallelism
    fits = max(1, SIDE_BYTES // (8 * max(1, width)))
    slice_rows = min(slice_rows, fits, max(2048, -(-seen["n"] // max(1, cores))))
    slices = max(1, -(-seen["n"] // slice_rows))
    blocks = max(1, -(-seen["a"] // min(anchor_rows, fits)))

    def spread(column: str, n: int):
        return F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(n)).cast("int").alias(column)

    def each(column: str, n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(column)

    candidates = coded.select("*", spread("slice", slices)).select("*", each("block", blocks)).groupBy("block", "slice")
    # Anchors of one id are told apart by all they hold.
    anchors = rows.filter(is_anchor).select("vec_id", "label", "v", F.xxhash64("label", "v").alias("own"), spread("block", blocks))

    def met(queries: DataFrame, find, schema: str) -> DataFrame:
        arrow = arrow_schema(schema)

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            parts = []
            if left.num_rows and right.num_rows:
                c = Candidates.of(right, width, levels)
                q = matrix(left.column("v"), width)
                exact = too_large(q, c.x)
                others = [left.column(n).to_pylist() for n in left.column_names]
                for i in range(len(q)):
                    row = {n: cells[i] for n, cells in zip(left.column_names, others)}
                    parts += find(c, row, q[i], exact)
            return _found(parts, arrow)

        grid = queries.select("*", each("slice", slices)).groupBy("block", "slice")
        return grid.cogroup(candidates).applyInArrow(run, schema)

    def find_positives(c: Candidates, row: dict, x: np.ndarray, exact: bool) -> list[tuple]:
        if exact:
            some = np.flatnonzero((c.labels == row["label"]) & (c.ids != row["vec_id"]))
            scores = _plain(c, x, some)
            best = _best(scores, c.ids[some], positive_rows)
            ids, scores = c.ids[some[best]], scores[best]
        else:
            ids, scores = positives(c, row["vec_id"], row["label"], x, positive_rows)
        return [(np.full(len(ids), row["vec_id"]), np.full(len(ids), row["own"]), ids, scores)]

    def find_negatives(c: Candidates, row: dict, x: np.ndarray, exact: bool) -> list[tuple]:
        out = []
        p = np.array([cell["positive_score"] for cell in row["wanted"]], object if exact else np.int64)
        windows = _windows(p, low, high)
        if exact:
            some = np.flatnonzero((c.labels != row["label"]) & (c.ids != row["vec_id"]))
            scores = _plain(c, x, some)
        else:
            some = contenders(c, row["vec_id"], row["label"], x, windows, negative_rows)
            scores = c.scores(some, x)
        for cell, (least, most) in zip(row["wanted"], windows):
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            best = inside[_best(scores[inside], c.ids[some[inside]], negative_rows)]
            n = len(best)
            out.append((
                np.full(n, row["vec_id"]), np.full(n, row["own"]), np.full(n, cell["positive_id"]),
                np.full(n, cell["positive_score"]), c.ids[some[best]], scores[best],
            ))
        return out

    def first(found: DataFrame, of: list[str], score: str, ident: str, k: int) -> DataFrame:
        order = Window.partitionBy(*of).orderBy(F.desc(score), ident)
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    wanted = met(anchors, find_positives, "anchor_id long, own long, positive_id long, positive_score long")
    wanted = first(wanted, ["anchor_id", "own"], "positive_score", "positive_id", positive_rows)
    wanted = wanted.groupBy("anchor_id", "own").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("wanted"))
    wanted = materialise(wanted.withColumnsRenamed({"anchor_id": "vec_id"}), "positives")
    schema = "anchor_id long, own long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = met(anchors.join(wanted, ["vec_id", "own"]), find_negatives, schema)
    found = first(found, ["anchor_id", "own", "positive_id"], "negative_score", "negative_id", negative_rows)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
