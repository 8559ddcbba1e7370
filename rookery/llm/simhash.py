"""SimHash near-dedup: one-wildcard segment variants, equality of variants, verified distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.components import components
from rookery.llm.rows import Packed, arrow_schema, lean, materialise, run_starts, text_bytes

SHINGLE = 3
MAX_BITS = 3
SEED = 42
# Buckets of more fingerprints are cut again by variants of their other bits.
BUCKET = 1024
# Fingerprints that one task makes the variants of, on average.
TASK_ROWS = 25_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, repeats included; a bit is 1 if set in over half."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[len(words) - n :]
    hashes = np.array(
        [
            xxhash.xxh64_intdigest(joined[a:b], SEED)
            for a, b in zip(starts[:n].tolist(), last.tolist())
        ],
        np.uint64,
    )
    ones = np.zeros(64, np.int64)
    for first in range(0, n, 65536):
        part = hashes[first : first + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(packed: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(id, k1, k2, fp)`` for the frame of a ``Packed``; the text does not leave the scan's task."""
    kind = packed.schema["id"].dataType.simpleString()
    schema = f"id {kind}, k1 long, k2 long, fp long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_bytes(batch.column("text"))
            fps = np.array(
                [fingerprint(raw[a:b].tobytes(), shingle) for a, b in zip(at[:-1].tolist(), at[1:].tolist())],
                np.uint64,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("k1"), batch.column("k2"), pa.array(fps.view(np.int64))],
                schema=arrow,
            )

    return packed.select("id", "text", "k1", "k2").mapInArrow(lean(run), schema)


def variants(fps: DataFrame) -> DataFrame:
    """Each fingerprint under its two 32-bit halves: whole, and with every one bit left open.

    Three differing bits leave at most one to one of two halves, so any linked pair shares a key.
    ``key`` holds the half, the place of the open bit (32 for none) and the other bits.
    """
    halves = [F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))]
    keys = []
    for side, half in enumerate(halves):
        for i in range(33):
            open_bit = half if i == 32 else half.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << i)))
            keys.append(open_bit.bitwiseOR(F.lit((side << 40) | (i << 32))))
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"), F.lit(0).cast("long").alias("sub"))


def _narrower(rows: DataFrame) -> DataFrame:
    """Members of a full bucket under the 16-bit halves of the half that their key does not hold."""
    other = F.when(
        F.shiftright("key", 40) == 0, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    ).otherwise(F.shiftrightunsigned("fp", 32))
    rows = rows.withColumn("other", other)
    halves = [F.shiftrightunsigned("other", 16), F.col("other").bitwiseAND(F.lit(0xFFFF))]
    subs = []
    for side, half in enumerate(halves):
        for i in range(17):
            open_bit = half if i == 16 else half.bitwiseAND(F.lit(0xFFFF ^ (1 << i)))
            subs.append(open_bit.bitwiseOR(F.lit((side << 40) | ((i + 1) << 32))))
    return rows.select("fp", "key", F.explode(F.array(*subs)).alias("sub"))


def _least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index reachable over the pairs, for each of n nodes."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def _runs(key, sub, fp, starts, max_bits):
    """Links inside runs of equal keys, as edges to the least member that each row reaches."""
    size = np.diff(np.append(starts, len(fp)))
    left = np.repeat(size, size) - (np.arange(len(fp)) - np.repeat(starts, size))  # rows from here on
    side, bit = key >> np.int64(40), (key >> np.int64(32)) & np.int64(0xFF)
    shift = np.where(bit == 32, 0, bit + np.where(side == 0, 32, 0)).astype(np.uint64)
    whole = (bit == 32) | (sub != 0)
    found_a, found_b = [], []
    at = np.flatnonzero(left > 1)
    step = 1
    while len(at):
        x = fp[at] ^ fp[at + step]
        near = np.bitwise_count(x) <= max_bits
        # Equal halves are compared under the whole key alone; an open bit has to differ.
        near &= whole[at] | ((x >> shift[at]) & np.uint64(1) == 1)
        found_a.append(at[near])
        found_b.append(at[near] + step)
        step += 1
        at = at[left[at] > step]
    if not found_a:
        return fp[:0], fp[:0]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    label = _least_labels(len(fp), a, b)
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _wide_run(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for one run of any size, comparing 256 rows with all others at a time."""
    label = np.arange(len(fp))
    while True:
        before = label.copy()
        for first in range(0, len(fp), 256):
            near = np.bitwise_count(fp[first : first + 256, None] ^ fp[None, :]) <= max_bits
            low = np.where(near, label[None, :], len(fp)).min(axis=1)
            np.minimum.at(label, label[first : first + 256], low)
            label[first : first + 256] = np.minimum(label[first : first + 256], low)
        label = label[label]
        if np.array_equal(before, label):
            break
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _bucket_edges(rows: DataFrame, max_bits: int, bound: int | None) -> DataFrame:
    """Edges ``(a, b)`` within buckets, and as ``(key, a)`` the members of buckets over ``bound``."""
    schema = "key long, a long, b long"
    arrow = arrow_schema(schema)

    def made(key, a, b):
        none = pa.nulls(len(a), pa.int64())
        cells = [none if x is None else pa.array(x.view(np.int64)) for x in (key, a, b)]
        return pa.RecordBatch.from_arrays(cells, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        full: tuple | None = None
        for batch in batches:
            key, sub, fp = (
                np.asarray(batch.column(c)).astype(np.int64) for c in ("key", "sub", "fp")
            )
            fp = fp.view(np.uint64)
            if full is not None:
                more = (key == full[0]) & (sub == full[1])
                if more.any():
                    yield made(key[more], fp[more], None)
                    key, sub, fp = key[~more], sub[~more], fp[~more]
                if len(key):
                    full = None
            if held is not None:
                key, sub, fp = (np.concatenate((h, x)) for h, x in zip(held, (key, sub, fp)))
            held = None
            if not len(key):
                continue
            starts = run_starts(key, sub)
            last = starts[-1]
            yield from closed(key[:last], sub[:last], fp[:last], starts[:-1])
            held = (key[last:], sub[last:], fp[last:])
            if bound is not None and len(held[0]) > bound:
                full = (held[0][0], held[1][0])
                yield made(held[0], held[2], None)
                held = None
        if held is not None:
            yield from closed(*held, np.zeros(1, np.int64))

    def closed(key, sub, fp, starts):
        if not len(starts):
            return
        size = np.diff(np.append(starts, len(fp)))
        for i in np.flatnonzero(size > (bound or BUCKET)):
            part = slice(starts[i], starts[i] + size[i])
            if bound is not None:
                yield made(key[part], fp[part], None)
            else:
                yield made(None, *_wide_run(fp[part], max_bits))
        keep = np.repeat((size > 1) & (size <= (bound or BUCKET)), size)
        if keep.any():
            key, sub, fp = key[keep], sub[keep], fp[keep]
            yield made(None, *_runs(key, sub, fp, run_starts(key, sub), max_bits))

    return rows.repartition("key", "sub").sortWithinPartitions("key", "sub", "fp").mapInArrow(lean(run), schema)


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Edges between distinct fingerprints that connect all those at ``max_bits`` or fewer.

    Buckets of equal variants are sorted runs. A run of at most ``bucket`` members is compared
    whole and leaves one edge per member at most. A larger one is never gathered: its members are
    keyed again by variants of the bits that its key leaves free. Such a second bucket leaves 18
    bits free, so it has at most 2**18 members.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves and one open bit find up to 3 differing bits")
    # Every row becomes 66: they are dealt out before, by a number that AQE leaves alone.
    tasks = max(fps.sparkSession.sparkContext.defaultParallelism, -(-fps.count() // TASK_ROWS))
    fps = fps.repartition(tasks)
    first = materialise(_bucket_edges(variants(fps), max_bits, bucket), "links")
    edges = first.filter("b is not null").select("a", "b")
    again = first.filter("b is null").select(F.col("a").alias("fp"), "key")
    if again.limit(1).count():
        edges = edges.union(_bucket_edges(_narrower(again), max_bits, None).select("a", "b"))
    return edges.distinct()


def near_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    bucket: int = BUCKET,
) -> DataFrame:
    """``(id, k1, k2, fp, root, component_id)`` for every row; equal fingerprints are linked as well.

    ``component_id`` is the least id reachable over links (null only if all ids of the group are).
    Null and empty texts and texts without a word have fingerprint 0 and are linked like any other.
    Repeated rows stay, with the same result. No rows give no rows; extra columns do not matter.
    """
    fps = materialise(fingerprints(Packed(df, id_col, text_col).frame, shingle), "fingerprints")
    least = materialise(fps.groupBy("fp").agg(F.min("id").alias("least")), "least")
    nodes = components(links(least.select("fp"), max_bits, bucket))
    grouped = least.join(nodes, least["fp"] == nodes["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    grouped = materialise(grouped, "groups")
    named = materialise(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    classes = grouped.join(named, "root").select("fp", "root", "component_id")
    return fps.join(classes, "fp").select("id", "k1", "k2", "fp", "root", "component_id")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``df`` without near copies: of each group the row of the least id and key stays.

    Of rows equal in id and text the one with the least hash of all columns stays. Columns, their order
    and their names are those of ``df``.
    """
    packed = Packed(df, id_col, text_col)
    groups = near_groups(df, id_col, text_col, **settings)
    # A null id comes last, so that a group of null ids alone still keeps one row.
    first = groups.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "k1", "k2")).alias("first")
    )
    keep = first.select("first.k1", "first.k2")
    kept = packed.frame.join(keep, ["k1", "k2"], "left_semi").withColumn("k3", F.xxhash64("row"))
    least = kept.groupBy("k1", "k2").agg(F.min("k3").alias("k3"))
    # What is left of a key now are rows that are equal in all columns.
    kept = kept.join(least, ["k1", "k2", "k3"], "left_semi").dropDuplicates(["k1", "k2", "k3"])
    return packed.unpack(kept)
