"""Contiguous shards of near-equal bytes from per-partition totals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rookery.llm.rows import arrow_schema, materialise

# A group of equal texts up to this share of a shard is not cut; a cut moves to its nearer end.
WHOLE_GROUP = 0.02
# Rows (a size and digests each) that one range partition holds on average.
PART_ROWS = 250_000


def _local_sums(rows: DataFrame) -> DataFrame:
    """Rows with their partition, and bytes and rows before them in it."""
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema)}, part int, bytes_before long, rows_before long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, bytes_done, rows_done = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            size = np.asarray(batch.column("size"))
            ends = np.cumsum(size)
            n = len(size)
            cells = [
                *batch.columns,
                pa.array(np.full(n, part, np.int32)),
                pa.array(ends - size + bytes_done),
                pa.array(np.arange(n, dtype=np.int64) + rows_done),
            ]
            yield pa.RecordBatch.from_arrays(cells, schema=arrow)
            if n:
                bytes_done, rows_done = bytes_done + int(ends[-1]), rows_done + n

    return rows.mapInArrow(run, schema)


def balanced_shards(
    df: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    whole_group: float = WHOLE_GROUP,
) -> DataFrame:
    """``(id, size, text_crc32, shard, slot)``: ``shards`` contiguous stretches of near-equal bytes.

    Rows are ordered by MD5 of the text, then id (null first), and range-partitioned by both, so a
    text that a third of the rows share still lies in many partitions. Each partition sums its own
    sizes, one row per partition gives the bytes before it, and the stretch is cut where the global
    sum passes ``k / shards`` of the total. Equal texts are neighbours: a cut that falls into a group
    of at most ``whole_group`` of a shard moves to the group's nearer end, a larger group is cut.
    ``slot`` counts a shard's rows from 0. The size is the UTF-8 bytes of the text plus 1; null
    counts as empty. Repeated rows get slots of their own. No rows give no rows; a table of fewer
    rows than shards leaves shards empty. Text never leaves the scan's task.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.md5(text.cast("binary")).alias("group"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # Texts are read once; what is sampled and sorted are sizes and digests.
    rows = materialise(rows, "sizes")
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // PART_ROWS))
    ordered = rows.repartitionByRange(parts, "group", "id").sortWithinPartitions("group", "id")
    rows = materialise(_local_sums(ordered), "shards")
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the step above.
    starts = materialise(
        totals.select(
            "part",
            *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_first") for c in ("bytes", "rows")),
            "bytes",
            "rows",
        ),
        "totals",
    )
    total = starts.agg(F.sum("bytes")).first()[0] or 0
    placed = rows.join(F.broadcast(starts.select("part", "bytes_first", "rows_first")), "part").select(
        "id", "size", "group", "text_crc32",
        (F.col("bytes_first") + F.col("bytes_before")).alias("begin"),
        (F.col("rows_first") + F.col("rows_before")).alias("place"),
    )
    cuts = _cuts(placed, total, shards, whole_group)
    shard = sum((F.when(F.col("begin") >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    placed = placed.withColumn("shard", shard.cast("int"))
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot")
    )


def _cuts(placed: DataFrame, total: int, shards: int, whole_group: float) -> list[int]:
    """Global byte offsets at which a new shard begins: one row per cut reaches the driver."""
    targets = [total * k // shards for k in range(1, shards)]
    if not total or not targets:
        return []
    hit = F.array_compact(
        F.array(*[F.when((F.col("begin") <= t) & (F.col("begin") + F.col("size") > t), F.lit(t)) for t in targets])
    )
    hits = placed.filter(F.size(hit) > 0).select("group", "begin", "size", F.explode(hit).alias("target"))
    hits = hits.collect()  # one row per target
    groups = sorted({row["group"] for row in hits})
    ends = {
        row["group"]: (row["begin"], row["end"])
        for row in placed.filter(F.col("group").isin(groups))
        .groupBy("group")
        .agg(F.min("begin").alias("begin"), F.max(F.col("begin") + F.col("size")).alias("end"))
        .collect()
    }
    cuts = []
    for row in hits:
        begin, end = ends[row["group"]]
        if end - begin > whole_group * total / shards:
            begin, end = row["begin"], row["begin"] + row["size"]
        cuts.append(begin if row["target"] - begin <= end - row["target"] else end)
    return sorted(cuts)
