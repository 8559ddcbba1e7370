"""Sentiment of a stream against word lists of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rookery.operators.sentiment import Lexicon, lexicon, lexicon_sentiment
from rookery.streaming.batches import AVAILABLE_NOW, BatchWriter, write_batches


def write_sentiment(
    posts: DataFrame,
    weights: DataFrame | Lexicon,
    base: str,
    prefix: str,
    checkpoint: str,
    id_col: str = "post_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Write each batch with ``score`` and ``sentiment`` to ``{base}/{prefix}_{batch_id}``.

    A batch is a table of its own, so its tokens meet a long list in the same hash join as in batch
    form, and no state is kept. The list is counted once, when the query starts. ``keep`` names the
    columns to write beside the two; texts that are not written are not shuffled.
    """
    words = weights if isinstance(weights, Lexicon) else lexicon(weights)

    def scored(batch: DataFrame) -> DataFrame:
        out = lexicon_sentiment(batch, words, id_col, text_col)
        return out if keep is None else out.select(*keep, "score", "sentiment")

    # The scores are read twice, by the test for an empty batch and by the write.
    writer = BatchWriter(base, prefix, "parquet", transform=scored, reuse=True)
    return write_batches(posts, writer, checkpoint, trigger)
