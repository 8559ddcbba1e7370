"""Merkle manifest of a table: aligned appends whose witnesses grow as siblings are completed."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rookery.llm.rows import arrow_schema, materialise

# A block has 2**BITS nodes: what one task appends at a time.
BITS = 12
# Leaves that one stretch of the sorted leaves holds on average.
CELL_ROWS = 100_000


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def cells_digest(cells: list[Column]) -> Column:
    """SHA-256 of the cells: ``-`` for null, else the UTF-8 bytes, ``:`` and the value."""

    def part(cell: Column) -> Column:
        text = cell.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in cells]), 256)


class Frontier:
    """An append-only list of digests: its open subtrees, the highest first, and all witnesses.

    A new digest is a subtree of height 0. While the last open subtree has the height of the new one,
    both are siblings: the witnesses of either side get the other's digest, and the two become one.
    ``close`` lifts what is still open: a node without a sibling is hashed alone.

    A witness has a part per level from the leaf up: ``L`` or ``R`` and the digest of the sibling on
    that side, or ``S`` alone.
    """

    def __init__(self) -> None:
        self.open: list[tuple[int, str, int]] = []
        self.witness: list[list[str]] = []

    def append(self, digest: str) -> None:
        self.witness.append([])
        self._complete(0, digest, len(self.witness) - 1)

    def _complete(self, height: int, digest: str, first: int) -> None:
        while self.open and self.open[-1][0] == height:
            _, left, begin = self.open.pop()
            to_right, to_left = "R" + digest, "L" + left
            for parts in self.witness[begin:first]:
                parts.append(to_right)
            for parts in self.witness[first:]:
                parts.append(to_left)
            height, digest, first = height + 1, _hash(left + digest), begin
        self.open.append((height, digest, first))

    def close(self, levels: int) -> str | None:
        """The digest ``levels`` above the leaves; at least as many as the leaves need."""
        while self.open:
            height, digest, first = self.open.pop()
            if not self.open and height == levels:
                return digest
            for parts in self.witness[first:]:
                parts.append("S")
            self._complete(height + 1, _hash(digest), first)
        return None


def levels_of(total: int, bits: int) -> int:
    """Levels that a block of a list of ``total`` nodes is closed at."""
    return bits if total > 1 << bits else (total - 1).bit_length()


def _appended(nodes: DataFrame, bits: int) -> DataFrame:
    """``nodes`` with the witness of each within its block, and the block's root."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    schema = f"{fields}, witness string, top string"
    arrow = arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        table = table.drop_columns(["block"]).sort_by("rank")
        frontier = Frontier()
        for digest in table.column("digest").to_pylist():
            frontier.append(digest)
        top = frontier.close(levels_of(table.column("total")[0].as_py(), bits))
        cells = [
            *table.columns,
            pa.array(["".join(parts) for parts in frontier.witness], pa.string()),
            pa.array([top] * table.num_rows, pa.string()),
        ]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(cells, arrow)], schema=arrow)

    blocks = nodes.withColumn("block", F.shiftright("rank", bits))
    return blocks.groupBy("g", "block").applyInArrow(run, schema)


def _ranked(rows: DataFrame, order: list[str], cell_rows: int) -> DataFrame:
    """``rank`` of each row in its group ``g`` from 0, and the group's ``total``.

    Rows are sorted in stretches of the whole table, so a group may fill many; the places of a group
    in a stretch begin where the stretches before it end, by sums over one row per group and stretch.
    """
    spark = rows.sparkSession
    stretches = max(spark.sparkContext.defaultParallelism, -(-rows.count() // cell_rows))
    placed = rows.repartitionByRange(stretches, "g", *order).sortWithinPartitions("g", *order)
    placed = materialise(placed.withColumn("at", F.monotonically_increasing_id()), "places")
    cell = F.shiftright("at", 33).alias("cell")
    counts = placed.groupBy(F.col("g").alias("h"), cell).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    own = Window.partitionBy("h")
    before = own.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "h", F.col("cell").alias("c"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(own).alias("total"),
    )
    starts = materialise(starts, "starts")
    joined = placed.withColumn("cell", cell).join(starts, (F.col("g") == F.col("h")) & (F.col("cell") == F.col("c")))
    return joined.withColumn("rank", F.col("at") + F.col("shift")).drop("h", "c", "cell", "shift", "at", *order)


def _grown(nodes: DataFrame, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of appends, each over the block roots of the one before, and ``(g, root)``."""
    rounds = []
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1 or not rounds:
        done = materialise(_appended(nodes, bits), "witnesses")
        rounds.append(done)
        nodes = done.filter(F.col("rank") % (1 << bits) == 0).select(
            "g", *(F.shiftright(c, bits).alias(n) for c, n in (("rank", "rank"), (F.col("total") + ((1 << bits) - 1), "total"))),
            F.col("top").alias("digest"),
        )
        most = -(-most // (1 << bits))
    return rounds, nodes.select("g", F.col("digest").alias("root"))


def _whole(rounds: list[DataFrame], top: DataFrame, bits: int) -> DataFrame:
    """The first round with whole witnesses; ``top`` has ``g``, ``rest`` and what else rows get."""
    keep = [c for c in top.columns if c not in ("g", "rest")]
    up, on = top.withColumnRenamed("g", "h"), F.col("g") == F.col("h")
    for done in reversed(rounds[1:]):
        joined = done.select("g", "rank", "witness").join(up, on)
        up = joined.select(F.col("g").alias("h"), F.col("rank").alias("b"), F.concat("witness", "rest").alias("rest"), *keep)
        on = (F.col("g") == F.col("h")) & (F.shiftright("rank", bits) == F.col("b"))
    joined = rounds[0].join(up, on)
    return joined.withColumn("witness", F.concat("witness", "rest")).drop("h", "b", "rest")


def manifest(
    df: DataFrame,
    columns: list[str],
    id_col: str = "doc_id",
    group_col: str = "lang",
    claims: Callable[[dict[str, Column]], Column] | None = None,
    bits: int = BITS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``(id, group, rank, leaf, claim, witness, subroot, root)``: one row per row of ``df``.

    A leaf is the digest of ``columns``. The leaves of a group ascend by id (null first, equal ids by
    leaf); pairs are hashed level by level to the group's subroot, a node without a sibling alone.
    The subroots, ordered by group (null first, by bytes), are hashed to the root in the same way.
    ``claim`` is ``claims`` of the columns, or the leaf: what ``folded`` is to be tried with.

    Leaves are ranked by a range partition and sums of counts per stretch, so a group of any size
    fills many tasks. Blocks of 2**``bits`` neighbours are appended each in one task; their roots are
    appended in blocks in the next round, until each group has one. A row's witness is that in its
    block, then that of the block root, and so on: joins on the block's number. Texts do not move,
    only digests. The driver reads one count per round and the root.

    Null cells are ``-``, so they differ from empty ones. Repeated rows are leaves of their own. No
    rows give no rows. Names that occur twice mean the first column of that name.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    cells = {name: F.col(f"c{names.index(name)}") for name in {*columns, id_col, group_col}}
    leaf = cells_digest([cells[c] for c in columns])
    group = F.coalesce(F.concat(F.lit("="), cells[group_col].cast("string")), F.lit(""))
    leaves = plain.select(
        group.alias("g"), cells[id_col].alias("id"), cells[id_col].alias("o"), leaf.alias("digest"),
        (claims(cells) if claims else F.lit(None).cast("string")).alias("claim"),
        F.monotonically_increasing_id().alias("salt"),
    )
    leaves = materialise(leaves.withColumn("leaf", F.col("digest")), "leaves")
    rounds, subroots = _grown(_ranked(leaves, ["o", "leaf", "salt"], cell_rows), bits)
    subroots = materialise(subroots, "subroots")
    tops = subroots.select(F.lit("").alias("g"), F.col("g").alias("id"), F.col("g").alias("o"), F.col("root").alias("digest"))
    upper, root = _grown(_ranked(tops, ["o"], cell_rows), bits)
    root = root.first()
    nothing_above = upper[0].filter("rank = 0").select("g", F.lit("").alias("rest"))
    top = _whole(upper, nothing_above, bits).select(
        F.col("id").alias("g"), F.col("digest").alias("subroot"), F.col("witness").alias("rest")
    )
    rows = _whole(rounds, materialise(top, "tops"), bits)
    return rows.select(
        "id",
        F.when(F.col("g") != "", F.expr("substr(g, 2)")).alias("group"),
        "rank",
        F.col("digest").alias("leaf"),
        F.coalesce("claim", "digest").alias("claim"),
        "witness",
        "subroot",
        F.lit(root["root"] if root else None).cast("string").alias("root"),
    )


def folded(claim: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    parts = F.regexp_extract_all(witness, F.lit("([LRS][0-9a-f]*)"), F.lit(1))

    def step(done: Column, part: Column) -> Column:
        sibling = F.substr(part, F.lit(2))
        return F.sha2(F.when(F.startswith(part, F.lit("L")), F.concat(sibling, done)).otherwise(F.concat(done, sibling)), 256)

    return F.aggregate(parts, claim, step)


def proof_digest(witness: Column) -> Column:
    """SHA-256 of the siblings of a witness, from the leaf up."""
    return F.sha2(F.regexp_replace(witness, "[LRS]", ""), 256)
