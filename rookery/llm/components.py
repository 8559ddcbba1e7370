"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.rows import materialise


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (``a``, ``b``, longs); the least node names it.

    Each round joins every edge to the least neighbour of its ends (a count per key, then an
    equality join which AQE may split), is written to the shared folder, and shrinks every
    component towards a star. Nothing but a row count and a checksum reaches the driver. Edges of a
    node to itself and repeated edges change nothing; no edges give no rows.
    """
    stars = materialise(
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(most_rounds):
        both = stars.select("a", "b").union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        least = materialise(least, "least")
        large = (
            both.join(least, "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = materialise(large, "large")
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = (
            large.join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .filter("a != b")
            .distinct()
        )
        stars = materialise(small, "stars")
        state = stars.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        if seen == (state["n"], state["sum"]):
            break
        seen = (state["n"], state["sum"])
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    hubs = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        hubs.select("node", F.col("node").alias("component"))
    )
