"""Exact top-k by inner product: columnar branch and bound over blocks of dimensions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rookery.llm.rows import arrow_schema, materialise
from rookery.llm.vectors import clipped, matrix, too_large, whole_numbers, whole_vectors

SCALE = 64
# A task holds at most about so many candidates and queries, whatever the table's size.
SLICE_ROWS = 65_536
QUERY_ROWS = 16_384
SIDE_BYTES = 64 << 20
_TILE = 64
_DIMS = 8
# Candidates that are scored whole first, and those that meet the same least scores after them.
_SEED_ROWS, _RUN_ROWS = 1_024, 8_192
# Share of pairs below which pairs are cheaper than matrices.
_SPARSE = 0.4


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by least id."""
    some = np.arange(len(scores))
    if len(scores) > k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


class Columns:
    """Candidates in vertical layout, the dimensions that differ most first, and what the rest can add."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, dims: int) -> None:
        self.ids, self.dims = ids, dims
        self.order = np.argsort(-x.var(0), kind="stable")
        self.columns = np.ascontiguousarray(x[:, self.order].T)
        width = len(self.columns)
        # No bound before half of the dimensions is worth its price.
        half = width // 2 // dims * dims
        self.firsts = [0, *range(half, width, dims)] if 0 < half < width else [0]
        self.firsts.append(width)
        self.rest = self.left_over(x[:, self.order])

    def left_over(self, x: np.ndarray) -> np.ndarray:
        """Length of each row from the first dimension of each block on."""
        return np.stack([np.sqrt((x[:, f:] ** 2).sum(1)) for f in self.firsts])


def _survivors(c: Columns, q: np.ndarray, q_rest: np.ndarray, some: slice, least: np.ndarray, done: list[int]):
    """Pairs ``(query, candidate, score)`` of a tile and a run of candidates that reach ``least``.

    Scores grow block by block. What the remaining dimensions can add is at most the product of the
    remaining lengths, so a pair below its query's least score goes. While many are left the block is a
    product of matrices; then only the pairs that are left grow.
    """
    x = c.columns[:, some]
    partial, pairs = np.zeros((len(q), x.shape[1])), None
    for b in range(len(c.firsts) - 1):
        block = slice(c.firsts[b], c.firsts[b + 1])
        width = block.stop - block.start
        if pairs is None:
            partial += q[:, block] @ x[block]
            done[0] += width * partial.size
            slack = q_rest[b + 1][:, None] * c.rest[b + 1][None, some]
            alive = partial + slack * (1 + 1e-9) + 1e-6 >= least[:, None]
            if b + 2 == len(c.firsts) or alive.mean() <= _SPARSE:
                pairs = np.nonzero(alive)
                scores = partial[pairs]
        else:
            scores = scores + np.einsum("di,di->i", q.T[block][:, pairs[0]], x[block][:, pairs[1]])
            done[0] += width * len(scores)
            slack = q_rest[b + 1][pairs[0]] * c.rest[b + 1][some][pairs[1]]
            stay = scores + slack * (1 + 1e-9) + 1e-6 >= least[pairs[0]]
            pairs, scores = (pairs[0][stay], pairs[1][stay]), scores[stay]
    return pairs[0], pairs[1] + some.start, scores


def search(q_ids, q, x_ids, x, k: int, dims: int = _DIMS, done: list[int] | None = None):
    """``(query id, ids, scores)`` of each query's k best among ``x``, never its own id.

    The first candidates are scored whole; their k-th best score is what the next run of candidates
    has to reach, and each run raises it. ``done`` gets the multiplications made.
    """
    done = [0] if done is None else done
    if too_large(q, x):
        for query, row in zip(q_ids, whole_numbers(q)):
            own = x_ids != query
            scores = clipped(whole_numbers(x[own]).dot(row) if own.any() else [])
            best = np.lexsort((x_ids[own], ~scores))[:k]
            yield query, x_ids[own][best], scores[best]
        return
    c = Columns(x_ids, x, dims)
    q = q[:, c.order]
    q_rest = c.left_over(q)
    edges = [0, *range(min(_SEED_ROWS, len(x)), len(x), _RUN_ROWS), len(x)]
    for first in range(0, len(q), _TILE):
        tile, tile_ids = q[first : first + _TILE], q_ids[first : first + _TILE]
        least = np.full(len(tile), -np.inf)
        kept = [(np.empty(0, np.int64), np.empty(0)) for _ in tile]
        for begin, end in zip(edges, edges[1:]):
            rows, places, scores = _survivors(c, tile, q_rest[:, first : first + _TILE], slice(begin, end), least, done)
            found = x_ids[places]
            cuts = np.searchsorted(rows, np.arange(len(tile) + 1))
            for i, query in enumerate(tile_ids):
                own = slice(cuts[i], cuts[i + 1])
                other = found[own] != query
                ids = np.concatenate((kept[i][0], found[own][other]))
                values = np.concatenate((kept[i][1], scores[own][other]))
                best = _best(values, ids, k)
                kept[i] = ids[best], values[best]
                if len(best) == k:
                    least[i] = values[best[-1]]
        for query, (ids, values) in zip(tile_ids, kept):
            yield query, ids, np.rint(values).astype(np.int64)


def exact_top_k(
    df: DataFrame,
    k: int = 20,
    every: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    slice_rows: int = SLICE_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of all rows for each row whose id divides by ``every``.

    The score is the inner product of floor(scale * x); equal scores go to the smaller id. Blocks of
    queries meet slices of candidates in equality joins, each pair in one bounded task, and every
    task sends k rows per query. Null vectors, vectors with null, NaN or infinite components and null
    ids take no part; an empty vector scores 0; shorter vectors count as filled with zeros. Rows that
    are repeated whole count once, and a row never meets another of its own id. A score beyond a long
    counts as the nearest long. No rows give no rows; fewer than k candidates are all returned.
    """
    rows = materialise(whole_vectors(df, scale, id_col, vector_col), "vectors")
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q"), F.max(F.size("v")).alias("width")).first()
    width = count["width"] or 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    fits = max(1, SIDE_BYTES // (8 * max(1, width)))
    slice_rows = min(slice_rows, fits, max(2048, -(-count["n"] // max(1, cores))))
    slices = max(1, -(-count["n"] // slice_rows))
    blocks = max(1, -(-count["q"] // min(query_rows, fits)))

    def spread(column: str, n: int):
        return F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int").alias(column)

    def each(column: str, n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(column)

    candidates = rows.select("vec_id", "v", spread("slice", slices)).select("*", each("block", blocks))
    queries = rows.filter(is_query).select("vec_id", "v", spread("block", blocks))
    queries = queries.select("*", each("slice", slices))
    schema = "query_id long, vec_id long, score long"
    arrow = arrow_schema(schema)

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = [], [], []
        if left.num_rows and right.num_rows:
            sides = [(np.asarray(t.column("vec_id")), matrix(t.column("v"), width)) for t in (left, right)]
            for query, ids, scores in search(*sides[0], *sides[1], k):
                found[0].append(np.full(len(ids), query))
                found[1].append(ids)
                found[2].append(scores)
        cells = [pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in found]
        return pa.Table.from_arrays(cells, schema=arrow)

    part = queries.groupBy("block", "slice").cogroup(candidates.groupBy("block", "slice")).applyInArrow(meet, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        part.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
