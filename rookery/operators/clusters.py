"""Clustering of posts (batch) and of numeric points (online)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from rookery.functions.pairs import gap_finder, pair_counter, place_adder
from rookery.functions.vectors import is_complete, nearest_centre
from rookery.operators.bounds import spread
from rookery.operators.rollups import sample_rows

# Hashed features of post clustering; clusters, features and decay of the online form.
TEXT_FEATURES = 1_000
ONLINE_CLUSTERS = 5
ONLINE_DIMS = 2
ONLINE_DECAY = 1.0

# Up to this many dimensions the sums are plain columns.
_PLAIN_DIMS = 64

CENTRE_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("cluster", T.IntegerType(), False),
        T.StructField("centre", T.ArrayType(T.DoubleType(), False), False),
        T.StructField("weight", T.DoubleType(), False),
    ]
)


def _pairs(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_pairs``: neighbouring characters of the lower-cased text; a lone one stands alone."""
    lowered = F.lower(text_col)
    pairs = F.regexp_extract_all(lowered, F.lit(r"(?s)(?=(..))."), F.lit(1))
    alone = F.when(lowered == "", F.array().cast("array<string>")).otherwise(F.array(lowered))
    return df.withColumn("_pairs", F.when(F.length(lowered) < 2, alone).otherwise(pairs))


def featurize(
    df: DataFrame, text_col: str = "text", num_features: int = TEXT_FEATURES
) -> DataFrame:
    """Adds ``features``: hashed counts of pairs of neighbouring characters."""
    hashing = HashingTF(inputCol="_pairs", outputCol="features", numFeatures=num_features)
    return hashing.transform(_pairs(df, text_col)).drop("_pairs")


def cluster_posts(
    df: DataFrame, k: int, iterations: int, seed: int = 1, text_col: str = "text"
) -> KMeansModel:
    """K-means over text features.

    The features are kept, spilling to disk, since the trainer goes over them in every iteration.
    """
    features = featurize(spread(df.select(text_col)), text_col).select("features")
    features = features.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=k, maxIter=iterations, seed=seed, featuresCol="features").fit(features)
    finally:
        features.unpersist()


def assign_clusters(
    model: KMeansModel | Centres, df: DataFrame, text_col: str = "text"
) -> DataFrame:
    """``df`` with the integer ``cluster`` of each text; works on streams.

    ``model`` is that of ``cluster_posts``, or the centres of ``fit_text_centres``, which may come from
    a saved table. Centres place a null text in no cluster.
    """
    if isinstance(model, Centres):
        terms = text_terms(F.col(text_col), len(model.centres[0]))
        return spread(df).select(*df.columns, _nearest_by_terms(model, terms).alias("cluster"))
    placed = model.transform(featurize(spread(df), text_col))
    return placed.select(*df.columns, F.col("prediction").alias("cluster"))


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("posts"))


def cluster_examples(
    model: KMeansModel | Centres, df: DataFrame, id_col: str, sample: int = 100
) -> DataFrame:
    """The first ``sample`` posts, listed by cluster: one pass of the model over the sample."""
    return assign_clusters(model, sample_rows(df, sample, id_col)).orderBy("cluster", id_col)


def cluster_filter(model: KMeansModel | Centres, df: DataFrame, cluster: int) -> DataFrame:
    """Posts of one cluster; ``df`` may be a stream."""
    return assign_clusters(model, df).filter(F.col("cluster") == cluster)


@dataclass(frozen=True)
class Centres:
    """Cluster centres with their weights, as of a micro-batch."""

    centres: tuple[tuple[float, ...], ...]
    weights: tuple[float, ...]
    batch_id: int = -1

    @staticmethod
    def of(centres: Sequence[Sequence[float]], weights: Sequence[float] | None = None) -> Centres:
        rows = tuple(tuple(float(x) for x in c) for c in centres)
        return Centres(rows, tuple(float(w) for w in weights or [0.0] * len(rows)))

    @staticmethod
    def random(
        k: int = ONLINE_CLUSTERS, dims: int = ONLINE_DIMS, weight: float = 0.0, seed: int = 1
    ) -> Centres:
        return Centres.of(np.random.default_rng(seed).normal(size=(k, dims)), [weight] * k)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (self.batch_id, j, list(c), w)
            for j, (c, w) in enumerate(zip(self.centres, self.weights))
        ]
        return spark.createDataFrame(rows, CENTRE_SCHEMA)

    @staticmethod
    def from_df(df: DataFrame) -> Centres:
        """From a centre table, which has one row per cluster."""
        rows = sorted(df.collect(), key=lambda r: r.cluster)
        return Centres(
            tuple(tuple(r.centre) for r in rows), tuple(r.weight for r in rows), rows[0].batch_id
        )

    @staticmethod
    def from_model(model: KMeansModel) -> Centres:
        centres = [c.tolist() for c in model.clusterCenters()]
        return Centres.of(centres, [1.0] * len(centres))


def text_terms(text: Column, num_features: int = TEXT_FEATURES) -> Column:
    """The occupied places of a text's ``featurize`` vector: ``(at, n)`` pairs of 32-bit numbers, as binary."""
    return F.arrow_udf(pair_counter(num_features), "binary")(F.lower(text))


def _gaps(centres: Sequence[Sequence[float]], terms: Column, nearest: bool) -> Column:
    """The nearest centre of a text, or the squared distance to it."""
    squares = [math.fsum(x * x for x in c) for c in centres]
    table = np.array(centres, np.float64)
    return F.arrow_udf(gap_finder(table, squares, nearest), "int" if nearest else "double")(terms)


def _nearest_by_terms(centres: Centres, terms: Column) -> Column:
    """Index of the closest centre, the lowest of equally close ones."""
    return _gaps(centres.centres, terms, nearest=True)


def _uniform(id_col: str, seed: int, draw: int) -> Column:
    """A number between 0 and 1 that depends on the id, the seed and the draw alone."""
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}-{draw}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _drawn_centres(points: DataFrame, k: int, seed: int, dims: int) -> list[list[float]]:
    """Starting texts, each drawn by its squared distance from those before it.

    The least of ``-ln(u) / distance`` over all texts is such a draw, so each costs one aggregation
    without a shuffle of rows, and it does not depend on how the texts are partitioned. Fewer than
    ``k`` different texts give fewer centres.
    """
    drawn: list[list[float]] = []
    for draw in range(k):
        gap = _gaps(drawn, F.col("_terms"), nearest=False) if drawn else F.lit(1.0)
        race = F.when(gap > 0, -F.log(_uniform("id", seed, draw)) / gap)
        first = points.filter(race.isNotNull()).agg(F.min_by("_terms", F.struct(race, "id")).alias("terms")).first()
        if first["terms"] is None:
            break
        centre = [0.0] * dims
        for at, n in np.frombuffer(first["terms"], "<i4").reshape(-1, 2).tolist():
            centre[at] = float(n)
        drawn.append(centre)
    return drawn


def fit_text_centres(
    df: DataFrame,
    k: int,
    iterations: int,
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    num_features: int = TEXT_FEATURES,
) -> Centres:
    """K-means over text features; the result depends on the rows alone.

    The features of a text are made once and kept in eight bytes per occupied place. A step places
    every text and adds up its cluster where it lies, in arrays per task: no vector moves, and what
    reaches the driver are the sums, one row per cluster and feature. An empty cluster keeps its centre.
    Steps end when no centre moves. The weights are the sizes of the clusters. Null texts and ids are
    left out.
    """
    texts = spread(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).dropna()
    points = texts.select("id", text_terms(F.col("text"), num_features).alias("_terms"))
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        state = Centres.of(_drawn_centres(points, k, seed, num_features))
        for _ in range(iterations):
            moved = _moved_centres(points, state)
            if moved == state:
                break
            state = moved
        return state
    finally:
        points.unpersist()


def _moved_centres(points: DataFrame, state: Centres) -> Centres:
    """Each centre at the mean of the texts that are nearest to it."""
    if not state.centres:
        return state
    placed = points.select(_nearest_by_terms(state, F.col("_terms")).alias("cluster"), "_terms")
    # Place -1 counts the texts.
    shape = len(state.centres), len(state.centres[0])
    parts = placed.mapInArrow(place_adder(*shape), "cluster int, at int, n double")
    sums = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n")).collect()
    sizes = {row.cluster: row.n for row in sums if row["at"] == -1}
    centres = [[0.0] * len(c) if j in sizes else list(c) for j, c in enumerate(state.centres)]
    for row in sums:
        if row["at"] >= 0:
            centres[row.cluster][row["at"]] = row.n / sizes[row.cluster]
    return Centres.of(centres, [sizes.get(j, 0.0) for j in range(len(centres))])


def save_centres(centres: Centres, spark: SparkSession, path: str) -> None:
    centres.to_df(spark).coalesce(1).write.mode("overwrite").parquet(path)


def load_centres(spark: SparkSession, path: str) -> Centres:
    return Centres.from_df(spark.read.schema(CENTRE_SCHEMA).parquet(path))


def cluster_sums(points: DataFrame, centres: Centres) -> DataFrame:
    """``(cluster, n, sums)`` of a ``features`` column: one row per cluster that got a point.

    Points are summed where they lie, so a cluster that holds most of them costs no more. Features
    that are not whole (see ``unreadable_points``) are no points.
    """
    dims = len(centres.centres[0])
    placed = points.filter(is_complete(F.col("features"), dims)).select(
        "features", nearest_centre(F.col("features"), centres.centres).alias("cluster")
    )
    count = F.count(F.lit(1)).alias("n")
    if dims > _PLAIN_DIMS:
        totals = Summarizer.sum(F.col("vector"))
        return (
            placed.select("cluster", array_to_vector("features").alias("vector"))
            .groupBy("cluster")
            .agg(count, totals.alias("total"))
            .select("cluster", "n", vector_to_array("total").alias("sums"))
        )
    sums = [F.sum(F.get("features", F.lit(i))) for i in range(dims)]
    return placed.groupBy("cluster").agg(count, F.array(*sums).alias("sums"))


def unreadable_points(points: DataFrame, dims: int) -> DataFrame:
    """The rows which a model of ``dims`` features leaves out, for a count or a look at them."""
    return points.filter(~is_complete(F.col("features"), dims))


def merge_centres(
    state: Centres, sums: Sequence, decay: float = ONLINE_DECAY, unit: str = "batches"
) -> Centres:
    """Old centres, discounted by the decay, averaged with the sums of a batch.

    With ``unit="points"`` the decay applies once per point. A cluster whose weight is next to
    nothing beside the heaviest one takes half of that one's weight and a place right beside it.
    A batch without points only discounts the weights.
    """
    centres = np.array(state.centres)
    arrived = sum(row.n for row in sums)
    weights = np.array(state.weights) * (decay if unit == "batches" else decay**arrived)
    for row in sums:
        j = row.cluster
        weights[j] += row.n
        share = row.n / max(weights[j], 1e-16)
        centres[j] = (1.0 - share) * centres[j] + share / row.n * np.array(row.sums)
    heavy, light = int(weights.argmax()), int(weights.argmin())
    if weights[light] < 1e-8 * weights[heavy]:
        weights[heavy] = weights[light] = (weights[heavy] + weights[light]) / 2.0
        step = 1e-14 * np.maximum(np.abs(centres[heavy]), 1.0)
        centres[heavy], centres[light] = centres[heavy] + step, centres[heavy] - step
    return Centres(tuple(map(tuple, centres.tolist())), tuple(weights.tolist()), state.batch_id)


def kmeans_update(
    state: Centres, points: DataFrame, decay: float = ONLINE_DECAY, unit: str = "batches"
) -> Centres:
    """One online step. What reaches the driver is one row per cluster."""
    return merge_centres(state, cluster_sums(points, state).collect(), decay, unit)


def kmeans_predict(state: Centres, points: DataFrame) -> DataFrame:
    """Adds the ``cluster`` of each point's ``features``, beside any known id; null if unreadable."""
    return points.withColumn("cluster", nearest_centre(F.col("features"), state.centres))
