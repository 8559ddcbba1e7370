"""Bounded samples of labelled texts, and models fitted on them in one task."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.llm.rows import give_back

# About how many labelled rows a model is fitted on, and the longest text among them.
FIT_ROWS = 3_000
FIT_BYTES = 48_000


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    allowed: Column | None = None,
    rows: int = FIT_ROWS,
    most_bytes: int = FIT_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, text, label, order)`` of about ``rows`` labelled documents, chosen by a hash of the id.

    ``allowed`` is a condition on a column ``id``. The share is set by a count of the labels and is
    applied to both sides before the join, so the texts that move are those of the sample. Null ids
    and labels, texts over ``most_bytes`` and ids with two different labels are not in it. A text counts
    once under an id, and at most ``2 * rows`` are given, those first by a hash: an id that many rows
    carry fills no sample with copies, and a repeated task makes the same one.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
    marks = marks.filter("id is not null and label in (0, 1)")
    if allowed is not None:
        marks = marks.filter(allowed)
    share = min(1.0, rows / max(1, marks.count()))
    chosen = F.pmod(F.xxhash64(F.lit("sample"), F.col("id").cast("string")), F.lit(1 << 20)) < int(share * (1 << 20))
    marks = marks.filter(chosen).groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    marks = marks.filter("label = other").drop("other")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.filter(chosen & (F.octet_length("text") <= most_bytes))
    order = [F.xxhash64("id", F.lit("order")).alias("order"), F.xxhash64("text", "id").alias("own")]
    found = texts.join(marks, "id").select("id", "text", "label", *order).dropDuplicates(["id", "own"])
    return found.orderBy("order", "own").limit(2 * rows).drop("own")


def fitted(sample: DataFrame, fit: Callable[[list[bytes], list[int]], bytes]) -> bytes:
    """The model that ``fit`` makes of a ``labelled_sample``, in one task on its bounded number of rows.

    Rows come in a fixed order, so a repeated task makes the same model.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "text"], kind="stable")
        model = fit([t.encode() for t in pdf["text"]], pdf["label"].tolist())
        give_back()
        return pd.DataFrame({"model": [model]})

    found = sample.groupBy(F.lit(0).alias("all")).applyInPandas(run, "model binary").collect()
    return bytes(found[0]["model"]) if found else fit([], [])
