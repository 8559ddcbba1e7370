"""A text classifier retrained on every micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from rookery.operators.bounds import spread
from rookery.operators.classify import (
    FOLDS,
    SEED,
    fit_sentiment,
    hash_bucket,
    in_train,
    metrics,
    score,
    split_train_test,
    tune,
)
from rookery.streaming.batches import AVAILABLE_NOW, for_each_batch

RESULT_SCHEMA = (
    "batch_id bigint, status string, train bigint, test bigint, "
    "accuracy double, f1 double, tuned_f1 double"
)


def _enough_for_folds(train: DataFrame, id_col: str) -> bool:
    fold = hash_bucket(id_col, SEED + 1, FOLDS)
    cells = []
    for i in range(FOLDS):
        cells += [F.count_if(fold == i), F.count_distinct(F.when(fold != i, F.col("label"))) - 1]
    return all(train.agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)]).first())


def train_per_batch(
    labelled: DataFrame,
    path: str,
    checkpoint: str,
    id_col: str,
    with_tuning: bool = False,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Split, fit and evaluate each batch of ``(id, text, label)``; one result row per batch.

    A batch whose training part has fewer than two classes, or that has no test part, is
    recorded as skipped. With tuning, the grid is searched by folds of the batch's own training part;
    a batch that has an empty fold, or one without which fewer than two classes are left, is trained
    and recorded as untuned.
    """

    def fit_batch(batch: DataFrame, batch_id: int) -> None:
        batch = spread(batch.select(id_col, "text", "label"))
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sizes = batch.agg(
                F.count_if(in_train(id_col)).alias("train"),
                F.count_if(~in_train(id_col)).alias("test"),
                F.count_distinct(F.when(in_train(id_col), F.col("label"))).alias("classes"),
            ).first()
            row = [batch_id, "skipped", sizes["train"], sizes["test"], None, None, None]
            if sizes["classes"] >= 2 and sizes["test"]:
                train, test = split_train_test(batch, id_col)
                result = metrics(score(fit_sentiment(train), test)).first()
                row[1], row[4], row[5] = "trained", result["accuracy"], result["f1"]
                if with_tuning:
                    row[1] = "tuned" if _enough_for_folds(train, id_col) else "untuned"
                    row[6] = tune(train, test, id_col).tuned_metric if row[1] == "tuned" else None
            out = batch.sparkSession.createDataFrame([tuple(row)], RESULT_SCHEMA).coalesce(1)
            out.write.mode("overwrite").parquet(f"{path}/batch_{batch_id}")
        finally:
            batch.unpersist()

    return for_each_batch(labelled, fit_batch, checkpoint, trigger)
