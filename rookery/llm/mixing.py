"""Mixing sources to target weights: temperature, token budgets, block permutations. All native."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rookery.llm.rows import Packed, materialise

WORD = r"[^\x20\x09-\x0D]+"
# Exponents are whole multiples of this step, so any way of bisecting ends at the same one.
STEPS = 1 << 20
ENTROPY = 0.9
REPEATS = 4.0
SEED = "mix"
_FAN = 32


def _exact(x: Column) -> Column:
    """A number whose sum does not depend on the order of its parts."""
    return x.cast("decimal(38, 20)")


def source_totals(rows: DataFrame) -> DataFrame:
    """``(source, total)`` tokens of each source; null is a source of its own."""
    return rows.groupBy("source").agg(F.sum("tokens").alias("total"))


def exponent(
    totals: DataFrame, budget: int | None = None, entropy: float | None = ENTROPY, repeats: float | None = REPEATS
) -> float:
    """The exponent a in 0..1 for weights proportional to share**a.

    With ``entropy``: the largest a whose weights have at least that share of the highest possible
    entropy. With ``repeats``: no a below the least one at which no source is read more often than
    that. Each round asks for 32 exponents at once in one aggregation over the sources, and one row
    of numbers reaches the driver. The repetition limit wins, as far as a = 1 can meet it.
    """
    live = totals.filter("total > 0")
    row = live.agg(F.sum("total").alias("all"), F.count(F.lit(1)).alias("n")).first()
    if not row["n"]:
        return 1.0
    whole, most = int(row["all"]), math.log(row["n"])
    budget = whole if budget is None else budget
    share = F.col("total") / F.lit(float(whole))

    def measured(steps: list[int]) -> list[tuple[float, float]]:
        cells = []
        for step in steps:
            a = F.lit(step / STEPS)
            power = F.pow(share, a)
            cells += [F.sum(_exact(power)), F.sum(_exact(power * a * F.log(share))), F.max(power / F.col("total"))]
        got = list(live.agg(*[c.alias(f"m{i}") for i, c in enumerate(cells)]).first())
        out = []
        for i in range(0, len(got), 3):
            z, s, top = map(float, got[i : i + 3])
            out.append((math.log(z) - s / z, top / z * budget))
        return out

    def least(holds) -> int:
        """The least step at which ``holds`` is true; it stays true from there on."""
        low, high = 0, STEPS
        while low < high:
            width = -(-(high - low) // _FAN)
            steps = [min(low + i * width, high) for i in range(_FAN)]
            marks = [holds(m) for m in measured(steps)]
            hit = marks.index(True) if True in marks else len(marks)
            high = steps[hit] if hit < len(steps) else high
            low = steps[hit - 1] + 1 if hit else steps[0]
        return low

    found = 0
    if entropy is not None:
        found = STEPS if measured([STEPS])[0][0] >= entropy * most else least(lambda m: m[0] < entropy * most) - 1
    if repeats is not None:
        found = max(found, least(lambda m: m[1] <= repeats))
    return max(found, 0) / STEPS


def budgets(totals: DataFrame, a: float, budget: int | None = None) -> DataFrame:
    """``(source, total, full, rest)``: whole blocks of each source, and tokens of one more block.

    A source without a token costs nothing and is taken once.
    """
    row = totals.filter("total > 0").agg(F.sum("total").alias("all")).first()
    whole = int(row["all"] or 0)
    if not whole:
        return totals.select("source", "total", F.lit(1).cast("long").alias("full"), F.lit(0).cast("long").alias("rest"))
    budget = whole if budget is None else budget
    if a == 1.0:
        # In whole numbers, as doubles may come out one below a source's own total.
        tokens = F.expr(f"cast(total as decimal(19, 0)) * cast({budget} as decimal(19, 0)) div {whole}")
    else:
        power = F.pow(F.col("total") / F.lit(float(whole)), F.lit(a))
        z = float(totals.filter("total > 0").agg(F.sum(_exact(power))).first()[0])
        tokens = F.floor(power / F.lit(z) * F.lit(float(budget))).cast("long")
    named = totals.withColumn("tokens", F.when(F.col("total") > 0, tokens))
    return named.select(
        "source", "total",
        F.coalesce(F.expr("tokens div total"), F.lit(1)).cast("long").alias("full"),
        F.coalesce(F.col("tokens") % F.col("total"), F.lit(0)).cast("long").alias("rest"),
    )


def _order(block: Column, seed: str) -> Column:
    """Where a document comes in the permutation of a block."""
    return F.md5(F.concat_ws("-", F.lit(seed), block.cast("string"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"))


def cut_points(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """``(source, full, last)``: the last document of the block that the rest of the budget opens.

    Documents are taken in the order of the block's permutation until the next one would pass the
    budget. The order is a hash, so its first three digits cut a source, even one of a third of all
    rows, into 4,096 even buckets: sums of buckets come first, and only the bucket in which the
    budget ends is put in order.
    """
    placed = rows.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = placed.filter("rest > 0").withColumn("order", _order(F.col("full"), seed))
    placed = placed.withColumn("bucket", F.substring("order", 1, 3))
    sums = placed.groupBy("source", "bucket").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("done", F.sum("tokens").over(upto))
    # The first bucket that passes the budget; the one before it if its first document does not fit.
    ends = sums.filter("done > rest").groupBy("source").agg(F.min("bucket").alias("bucket"))
    before = sums.groupBy("source").agg(F.max("bucket").alias("top"))
    ends = before.select(F.col("source").alias("s"), "top").join(
        ends.select(F.col("source").alias("t"), "bucket"), F.col("s").eqNullSafe(F.col("t")), "left"
    )
    ends = ends.select("s", F.coalesce("bucket", "top").alias("end"))
    base = sums.join(ends, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    base = base.filter("bucket <= end").groupBy("source").agg(
        F.max("end").alias("end"), F.sum(F.when(F.col("bucket") < F.col("end"), F.col("tokens")).otherwise(0)).alias("base")
    )
    base = base.withColumnRenamed("source", "s")
    inside = placed.join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("end")))
    own = Window.partitionBy("source").orderBy("order", "id", "k2").rowsBetween(Window.unboundedPreceding, 0)
    place = F.struct("order", F.col("id").isNotNull().alias("known"), "id", "k2")
    inside = inside.withColumn("upto", F.col("base") + F.sum("tokens").over(own)).filter("upto <= rest")
    inside = inside.groupBy("source").agg(F.max(place).alias("last")).withColumnRenamed("source", "s")
    end = F.struct(
        F.col("end").alias("order"), F.lit(False).alias("known"), F.lit(None).cast(rows.schema["id"].dataType).alias("id"),
        F.lit(None).cast("long").alias("k2"),
    )
    # No document of the last bucket fits: all of the buckets before it are taken.
    cuts = base.select(F.col("s").alias("source"), end.alias("none")).join(inside, F.col("source").eqNullSafe(F.col("s")), "left")
    return cuts.select("source", F.coalesce("last", "none").alias("last"))


def mixed_copies(
    df: DataFrame,
    budget: int | None = None,
    entropy: float | None = ENTROPY,
    repeats: float | None = REPEATS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[Packed, DataFrame]:
    """The frame of a ``Packed`` with ``source``, ``tokens``, ``block`` and ``order``, a row per copy."""
    packed = Packed(df, id_col, text_col)
    source = F.col(f"row.c{packed.names.index(source_col)}").cast("string")
    tokens = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    frame = packed.frame.withColumn("source", source)
    rows = materialise(frame.select("id", "k2", "source", tokens.alias("tokens")), "tokens")
    totals = materialise(source_totals(rows), "totals")
    plan = materialise(budgets(totals, exponent(totals, budget, entropy, repeats), budget), "budgets")
    cuts = cut_points(rows, plan, seed).withColumnRenamed("source", "t")
    plan = plan.withColumnRenamed("source", "s").join(cuts, F.col("s").eqNullSafe(F.col("t")), "left")
    plan = materialise(plan.select("s", "full", "last"), "plan")
    copies = frame.join(plan, F.col("source").eqNullSafe(F.col("s")))
    place = F.struct(_order(F.col("full"), seed).alias("order"), F.col("id").isNotNull().alias("known"), "id", "k2")
    blocks = F.col("full") + F.when(place <= F.col("last"), 1).otherwise(0)
    copies = copies.withColumn("blocks", blocks).filter("blocks > 0")
    copies = copies.select(
        "row", "id", "k1", "k2", "text", "source", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    )
    return packed, copies.withColumn("order", _order(F.col("block"), seed)).withColumn("tokens", tokens)


def mix(df: DataFrame, **settings) -> DataFrame:
    """``(id, source, tokens, block, order)``: one row per copy of a document in the mixture.

    The token share of each source is raised to an exponent which is bisected to meet ``entropy`` (a
    share of the highest possible) and ``repeats`` (a limit on how often a source is read); the
    normalised powers are the weights. ``budget`` tokens (all, if not given) are dealt out by them.
    A source is read in blocks, each a permutation of all of its documents by a hash; the last block
    ends before the document that would pass the budget. Tokens are runs without white space. Null
    texts have none, null sources are one source, documents without a token follow the blocks, and
    a source without any token is taken once. Repeated rows are copies of their own with the same
    place. Weights, cuts and copies are made by built-in functions; texts move only where the plan of
    the sources is too large to be broadcast.
    """
    return mixed_copies(df, **settings)[1].select("id", "source", "tokens", "block", "order")


def mixed_documents(df: DataFrame, **settings) -> DataFrame:
    """The mixture as rows of ``df``: the same columns, one row per copy."""
    packed, copies = mixed_copies(df, **settings)
    return packed.unpack(copies)
