"""Micro-batch output, triggers, row budget and small state tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window
from pyspark.storagelevel import StorageLevel

from rookery.operators.rollups import preview

# Batch intervals in seconds and the row budget of the collectors.
BATCH_SECONDS = 1
PREVIEW_BATCH_SECONDS = 5
ROW_BUDGET = 1000

# Everything that is there now, in as many batches as the source is told to make, then stop.
AVAILABLE_NOW = {"availableNow": True}


def every(seconds: int = BATCH_SECONDS) -> dict:
    return {"processingTime": f"{seconds} seconds"}


def for_each_batch(
    stream: DataFrame,
    fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict = AVAILABLE_NOW,
    output_mode: str = "append",
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(fn)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
        .trigger(**trigger)
        .start()
    )


def drain(query: StreamingQuery) -> None:
    """Wait for a query with an ``AVAILABLE_NOW`` trigger."""
    query.awaitTermination()


def _read_if_there(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class RowBudgetReached(Exception):
    """Refuses a batch after the budget; the batch stays uncommitted for a later run."""


class BatchWriter:
    """Writes every non-empty batch to ``{base}/{prefix}_{batch_id}{suffix}``.

    A replayed batch overwrites its own folder. With a ``budget`` rows are counted while they are
    written, and the counts lie beside the output, so a restarted query goes on with the same
    total; once the total is above the budget, batches are refused.

    ``reuse`` keeps the batch while it is tested and written; use it when the stream is stateful
    or dear to compute. Without it the emptiness test reads one row.
    """

    def __init__(
        self,
        base: str,
        prefix: str,
        fmt: str = "text",
        suffix: str = "",
        files_per_batch: int | None = None,
        budget: int | None = None,
        transform: Callable[[DataFrame], DataFrame] | None = None,
        reuse: bool = False,
    ):
        self.base, self.prefix, self.suffix, self.fmt = base.rstrip("/"), prefix, suffix, fmt
        self.files_per_batch, self.budget = files_per_batch, budget
        self.transform, self.reuse = transform, reuse
        self.refused = False
        self._counts: dict[int, int] | None = None

    @property
    def counts_path(self) -> str:
        return f"{self.base}/{self.prefix}-counts"

    @property
    def batches_path(self) -> str:
        """A glob over all batch folders."""
        return f"{self.base}/{self.prefix}_*{self.suffix}"

    @property
    def total(self) -> int:
        return sum((self._counts or {}).values())

    def _check_budget(self, spark: SparkSession, batch_id: int) -> None:
        if self._counts is None:
            rows = _read_if_there(spark, self.counts_path, "n bigint, batch_id bigint")
            self._counts = {} if rows is None else {r.batch_id: r.n for r in rows.collect()}
        before = sum(n for b, n in self._counts.items() if b != batch_id)
        if before > self.budget:
            self.refused = True
            raise RowBudgetReached(f"{before} rows written, the budget is {self.budget}")

    def _record(self, spark: SparkSession, batch_id: int, n: int) -> None:
        one = spark.createDataFrame([(n,)], "n bigint").coalesce(1)
        one.write.mode("overwrite").parquet(f"{self.counts_path}/batch_id={batch_id}")
        self._counts[batch_id] = n

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.budget is not None:
            self._check_budget(spark, batch_id)
        if self.transform:
            batch = self.transform(batch)
        if self.reuse:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            out = batch.coalesce(self.files_per_batch) if self.files_per_batch else batch
            seen = Observation()
            if self.budget is not None:
                out = out.observe(seen, F.count(F.lit(1)).alias("n"))
            folder = f"{self.base}/{self.prefix}_{batch_id}{self.suffix}"
            out.write.mode("overwrite").format(self.fmt).save(folder)
            if self.budget is not None:
                self._record(spark, batch_id, seen.get["n"])
        finally:
            if self.reuse:
                batch.unpersist()


def write_batches(
    stream: DataFrame,
    writer: BatchWriter,
    checkpoint: str,
    trigger: dict = AVAILABLE_NOW,
    output_mode: str = "append",
) -> StreamingQuery:
    return for_each_batch(stream, writer, checkpoint, trigger, output_mode)


def run_until(
    stream: DataFrame,
    base: str,
    prefix: str,
    checkpoint: str,
    budget: int = ROW_BUDGET,
    trigger: dict = AVAILABLE_NOW,
    fmt: str = "text",
    poll_seconds: float = 0.1,
) -> int:
    """Collect batches until more than ``budget`` rows are written; returns the total.

    Batches are kept whole, so the total may pass the budget.
    """
    writer = BatchWriter(base, prefix, fmt, budget=budget)
    query = write_batches(stream, writer, checkpoint, trigger)
    try:
        while not query.awaitTermination(poll_seconds):
            if writer.total > budget:
                query.stop()
    except StreamingQueryException:
        if not writer.refused:
            raise
    return writer.total


def preview_batches(
    stream: DataFrame,
    n: int,
    order_by: Sequence[str],
    show: Callable[[int, list[Row]], None],
    checkpoint: str,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Hand the first ``n`` rows of each batch to ``show``."""

    def first_rows(batch: DataFrame, batch_id: int) -> None:
        show(batch_id, preview(batch, n, order_by).collect())

    return for_each_batch(stream, first_rows, checkpoint, trigger)


def write_previews(
    stream: DataFrame,
    n: int,
    order_by: Sequence[str],
    path: str,
    checkpoint: str,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Keep the first ``n`` rows of each batch, with their ``place``, in a table keyed by ``batch_id``.

    A replayed batch overwrites its own folder; ``read_previews`` reads the table.
    """

    def first_rows(batch: DataFrame, batch_id: int) -> None:
        first = preview(batch, n, order_by)
        # At most n rows, which one task numbers.
        place = F.row_number().over(Window.orderBy(*order_by))
        out = first.withColumn("place", place).coalesce(1)
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return for_each_batch(stream, first_rows, checkpoint, trigger)


def read_previews(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


BATCH_REPORT = "batch_id bigint, rows bigint, started timestamp"


def batch_report(query: StreamingQuery) -> DataFrame:
    """``(batch_id, rows, started)`` of the batches with rows that the query's progress still lists."""
    spark = SparkSession.active()
    rows = [
        (p["batchId"], p["numInputRows"], dt.datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")))
        for p in query.recentProgress
        if p["numInputRows"]
    ]
    return spark.createDataFrame(rows, BATCH_REPORT)


def run_batches(query: StreamingQuery, batches: int, poll_seconds: float = 0.1) -> DataFrame:
    """Let a query with a timed trigger do so many batches with rows, stop it, and report them."""
    while not query.awaitTermination(poll_seconds):
        if sum(bool(p["numInputRows"]) for p in query.recentProgress) >= batches:
            query.stop()
    return batch_report(query)


def waited(seconds: int) -> Column:
    """For rows of a report: whether no batch began before the first whole interval after the last one.

    A batch that takes longer than the interval is followed at once, and the one after that waits.
    """
    interval, started = 1000 * seconds, F.unix_millis("started")
    # A report has a row per batch that the progress lists, a hundred by default.
    last = F.lag(started).over(Window.orderBy("batch_id"))
    return F.coalesce(started >= (F.floor(last / interval) + 1) * interval, F.lit(True))


@contextmanager
def kept(batch: DataFrame) -> Iterator[DataFrame]:
    """The batch, computed once for all that read it, and released at the end whatever happens."""
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield batch
    finally:
        batch.unpersist(blocking=True)


def reads_kept_rows(df: DataFrame) -> bool:
    """Whether every leaf of a new plan of ``df`` is a kept relation, so nothing is computed again."""
    return _only_kept(df.select("*")._jdf.queryExecution().withCachedData())


def _only_kept(plan) -> bool:
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    if not children:
        return plan.nodeName() == "InMemoryRelation"
    return all(_only_kept(child) for child in children)


def count_and_write(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    measures: dict[str, Callable[[DataFrame], DataFrame]],
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Write each batch and, from the same kept rows, one table per measure, all keyed by ``batch_id``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as rows:
            for name, out in {"rows": rows, **{n: make(rows) for n, make in measures.items()}}.items():
                out.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")

    return for_each_batch(stream, write, checkpoint, trigger)


class StateTable:
    """State rows per micro-batch, in a ring of ``keep`` folders.

    The rows of a batch carry its id, so a replayed batch starts from the state before it and
    overwrites its own rows instead of applying twice. ``files`` bounds the files of one state.
    """

    def __init__(self, path: str, schema: T.StructType, keep: int = 16, files: int | None = 1):
        self.path, self.schema, self.keep, self.files = path.rstrip("/"), schema, keep, files

        self._last: tuple[int, int] | None = None

    def _locate(self, spark: SparkSession, before: int | None) -> tuple[int, int] | None:
        """``(batch_id, slot)`` of the newest state, or of the newest one before a batch."""
        if self._last and before is not None and self._last[0] < before:
            return self._last
        schema = T.StructType([*self.schema.fields, T.StructField("slot", T.IntegerType())])
        rows = _read_if_there(spark, self.path, schema)
        if rows is None:
            return None
        if before is not None:
            rows = rows.filter(F.col("batch_id") < before)
        last = rows.agg(F.max(F.struct("batch_id", "slot")).alias("m")).first()["m"]
        return None if last is None else (last["batch_id"], last["slot"])

    def save(self, state: DataFrame, batch_id: int) -> None:
        # The folder after that of the state before, so a state is never written over its source.
        found = self._locate(state.sparkSession, batch_id)
        slot = 0 if found is None else (found[1] + 1) % self.keep
        state = state.coalesce(self.files) if self.files else state
        state.write.mode("overwrite").parquet(f"{self.path}/slot={slot}")
        self._last = (batch_id, slot)

    def newest(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The rows of the newest batch, or of the newest one before batch ``before``."""
        found = self._locate(spark, before)
        if found is None:
            return None
        return spark.read.schema(self.schema).parquet(f"{self.path}/slot={found[1]}")
