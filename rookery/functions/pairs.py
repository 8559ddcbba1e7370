"""Counts of neighbouring characters in arrays, and their distances to centres.

Each function returns one that runs inside tasks and holds all it needs: workers get it whole, and need
not have this package. Terms are ``(place, count)`` pairs of 32-bit numbers, ascending by place, as binary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pair_counter(num_features: int) -> Callable[[pa.Array], pa.Array]:
    """Lower-cased texts to terms: what ``HashingTF`` makes of their pairs of neighbouring characters.

    A lone character stands alone; an empty text has no terms, a null one is null.
    """
    # A slab is counted in an array of its rows by all features.
    slab_bytes, slab_rows = 1 << 20, max(1, (1 << 20) // num_features)

    def place(data: bytes) -> int:
        """Murmur3 (x86, 32 bits, seed 42) modulo the features."""
        mask, h = 0xFFFFFFFF, 42

        def stirred(k: int) -> int:
            k = k * 0xCC9E2D51 & mask
            return (k << 15 | k >> 17) & mask

        for i in range(0, len(data), 4):
            block = data[i : i + 4]
            h ^= stirred(int.from_bytes(block, "little")) * 0x1B873593 & mask
            if len(block) == 4:
                h = ((h << 13 | h >> 19) * 5 + 0xE6546B64) & mask
        h ^= len(data)
        h = (h ^ h >> 16) * 0x85EBCA6B & mask
        h = (h ^ h >> 13) * 0xC2B2AE35 & mask
        h ^= h >> 16
        return (h - (1 << 32) if h >> 31 else h) % num_features

    def char(code: int) -> bytes:
        return chr(code).encode("utf-8", "surrogatepass")

    plain: list[np.ndarray] = []

    def places(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The places of pairs of code points: ASCII ones by a table, others hashed once per slab."""
        if not plain:
            table = [place(bytes((a, b))) for a in range(128) for b in range(128)]
            plain.append(np.array(table, np.int64))
        known = (first | second) < 128
        if known.all():
            return plain[0][first << 7 | second]
        out = np.empty(len(first), np.int64)
        out[known] = plain[0][first[known] << 7 | second[known]]
        rare, back = np.unique(first[~known] << 21 | second[~known], return_inverse=True)
        hashed = [place(char(pair >> 21) + char(pair & 0x1FFFFF)) for pair in rare.tolist()]
        out[~known] = np.array(hashed, np.int64)[back]
        return out

    def counted(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms of a few texts, and how many each has."""
        rows = len(at) - 1
        if raw.size and raw.max() >= 128:
            begins = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
            codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), "<u4").astype(np.int64)
            at = begins[at]
        else:
            codes = raw.astype(np.int64)
        size = np.diff(at)
        owner = np.repeat(np.arange(rows), size)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        cells = owner[inner] * num_features + places(codes[inner], codes[inner + 1])
        alone = np.flatnonzero(size == 1)
        lone = [place(char(code)) for code in codes[at[alone]].tolist()]
        cells = np.concatenate((cells, alone * num_features + np.array(lone, np.int64)))
        counts = np.bincount(cells, minlength=rows * num_features)
        used = np.flatnonzero(counts)
        terms = np.stack((used % num_features, counts[used]), axis=1).astype("<i4")
        return terms, np.bincount(used // num_features, minlength=rows)

    def run(texts: pa.Array) -> pa.Array:
        given = texts.is_valid()
        wide = texts.fill_null("").cast(pa.large_binary())
        _, offsets, data = wide.buffers()
        n = len(wide)
        at = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        terms, sizes, first = [np.empty((0, 2), "<i4")], [np.empty(0, np.int64)], 0
        while first < n:
            last = int(np.searchsorted(at, at[first] + slab_bytes, side="right")) - 1
            last = max(first + 1, min(last, first + slab_rows, n))
            some, size = counted(raw[at[first] : at[last]], at[first : last + 1] - at[first])
            terms.append(some)
            sizes.append(size)
            first = last
        ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes)) * 8)).astype(np.int64)
        flat = pa.py_buffer(np.concatenate(terms).tobytes())
        made = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.tobytes()), flat])
        if texts.null_count:
            made = pc.if_else(given, made, pa.scalar(None, pa.large_binary()))
        return made.cast(pa.binary())

    return run


def gap_finder(centres: np.ndarray, squares: list[float], nearest: bool) -> Callable[[pa.Array], pa.Array]:
    """Terms to the nearest of the centres, the lowest of equally near ones, or to its squared distance."""
    slab_rows = 1024

    def run(column: pa.Array) -> pa.Array:
        given = column.is_valid()
        wide = column.fill_null(b"").cast(pa.large_binary())
        _, offsets, data = wide.buffers()
        n = len(wide)
        ends = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + n + 1] // 8 if n else np.zeros(1, np.int64)
        pairs = np.frombuffer(data, "<i4") if data is not None else np.empty(0, "<i4")
        out = np.empty(n, np.int32 if nearest else np.float64)
        for first in range(0, n, slab_rows):
            last = min(n, first + slab_rows)
            part = pairs[ends[first] * 2 : ends[last] * 2]
            at, count = part[0::2], part[1::2].astype(np.float64)
            owner = np.repeat(np.arange(last - first), np.diff(ends[first : last + 1]))
            # Products are added up in the order of places, so a distance depends on its row alone.
            gaps = np.stack([
                square - 2 * np.bincount(owner, count * centre[at], last - first)
                for centre, square in zip(centres, squares)
            ])
            if nearest:
                out[first:last] = gaps.argmin(axis=0)
            else:
                out[first:last] = gaps.min(axis=0) + np.bincount(owner, count * count, last - first)
        made = pa.array(out)
        if column.null_count:
            made = pc.if_else(given, made, pa.scalar(None, made.type))
        return made

    return run


def place_adder(k: int, dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``(cluster, terms)`` rows of a task to its sums ``(cluster, at, n)``; place -1 counts the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole numbers below 2**53, so the order of adding does not matter.
        sums, sizes = np.zeros(k * dims), np.zeros(k)
        for batch in batches:
            cluster = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            wide = batch.column(1).cast(pa.large_binary())
            _, offsets, data = wide.buffers()
            if not len(wide):
                continue
            ends = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1] // 8
            pairs = np.frombuffer(data, "<i4")[ends[0] * 2 : ends[-1] * 2] if data is not None else np.empty(0, "<i4")
            cells = np.repeat(cluster, np.diff(ends)) * dims + pairs[0::2]
            sums += np.bincount(cells, pairs[1::2], k * dims)
            sizes += np.bincount(cluster, minlength=k)
        used, full = np.flatnonzero(sums), np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((used // dims, full)).astype(np.int32)),
                pa.array(np.concatenate((used % dims, np.full(len(full), -1))).astype(np.int32)),
                pa.array(np.concatenate((sums[used], sizes[full]))),
            ],
            names=["cluster", "at", "n"],
        )

    return run
