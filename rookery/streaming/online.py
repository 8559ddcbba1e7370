"""Models trained batch by batch, with their state in a small table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rookery.operators.clusters import (
    CENTRE_SCHEMA,
    ONLINE_DECAY,
    Centres,
    kmeans_predict,
    kmeans_update,
)
from rookery.operators.regression import (
    WEIGHT_SCHEMA,
    LinearState,
    linreg_predict,
    linreg_update,
)
from rookery.streaming.batches import (
    AVAILABLE_NOW,
    BatchWriter,
    StateTable,
    for_each_batch,
)


class _Trainer:
    """Loads the state before a batch, updates it and saves it under the id of the batch."""

    def __init__(self, table: StateTable, initial, update):
        self.table, self.initial, self.update = table, initial, update
        self._last = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = self._last
        if state is None or state.batch_id != batch_id - 1:
            rows = self.table.newest(spark, before=batch_id)
            state = self.initial if rows is None else type(self.initial).from_df(rows)
        updated = self.update(state, batch)
        updated = type(updated)(**{**vars(updated), "batch_id": batch_id})
        self.table.save(updated.to_df(spark), batch_id)
        self._last = updated


def centre_table(path: str) -> StateTable:
    return StateTable(path, CENTRE_SCHEMA)


def weight_table(path: str) -> StateTable:
    return StateTable(path, WEIGHT_SCHEMA)


def train_kmeans(
    points: DataFrame,
    state_path: str,
    checkpoint: str,
    initial: Centres | None = None,
    decay: float = ONLINE_DECAY,
    unit: str = "batches",
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Online k-means over a stream with a ``features`` column."""
    trainer = _Trainer(
        centre_table(state_path),
        initial or Centres.random(),
        lambda state, batch: kmeans_update(state, batch, decay, unit),
    )
    return for_each_batch(points, trainer, checkpoint, trigger)


def train_linreg(
    points: DataFrame,
    state_path: str,
    checkpoint: str,
    initial: LinearState | None = None,
    trigger: dict = AVAILABLE_NOW,
    **options,
) -> StreamingQuery:
    """Online linear regression over a stream of ``(label, features)``."""
    trainer = _Trainer(
        weight_table(state_path),
        initial or LinearState.zeros(),
        lambda state, batch: linreg_update(state, batch, **options),
    )
    return for_each_batch(points, trainer, checkpoint, trigger)


def _predicting(table: StateTable, state_type, predict, initial):
    def with_newest(batch: DataFrame) -> DataFrame:
        rows = table.newest(batch.sparkSession)
        return predict(initial if rows is None else state_type.from_df(rows), batch)

    return with_newest


def predict_kmeans(
    points: DataFrame,
    state_path: str,
    base: str,
    prefix: str,
    checkpoint: str,
    initial: Centres | None = None,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Write each batch with the cluster by the newest centres, beside any known id."""
    predict = _predicting(
        centre_table(state_path), Centres, kmeans_predict, initial or Centres.random()
    )
    writer = BatchWriter(base, prefix, "parquet", transform=predict)
    return for_each_batch(points, writer, checkpoint, trigger)


def predict_linreg(
    points: DataFrame,
    state_path: str,
    base: str,
    prefix: str,
    checkpoint: str,
    initial: LinearState | None = None,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Write each batch with the prediction of the newest weights, beside the known label."""
    predict = _predicting(
        weight_table(state_path), LinearState, linreg_predict, initial or LinearState.zeros()
    )
    writer = BatchWriter(base, prefix, "parquet", transform=predict)
    return for_each_batch(points, writer, checkpoint, trigger)

