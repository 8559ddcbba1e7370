"""Removal of repeated lines, paragraphs and sentence runs by global digests of normalised units."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.rows import Packed, arrow_schema, lean, materialise, text_bytes
from rookery.llm.spans import cut, removed_bytes, removed_spans

# A unit that is shorter takes in the ones after it until it has so many words, at the end of a text
# the ones before it; a text that is shorter is one unit.
MIN_WORDS = 8
_CUTS = {
    "paragraph": re.compile(rb"\n[ \t\r]*\n\s*"),
    "line": re.compile(rb"\n\s*"),
    "sentence": re.compile(rb"(?<=[.!?])[ \t]+|\s*\n\s*"),
}


def units(text: bytes, unit: str, min_words: int) -> Iterator[tuple[bytes, int, int]]:
    """Digest, first and last byte + 1 of each unit; units may overlap where short ones are joined."""
    begins, ends, first = [], [], 0
    for gap in _CUTS[unit].finditer(text):
        begins.append(first)
        ends.append(gap.start())
        first = gap.end()
    begins.append(first)
    ends.append(len(text))
    words = [text[a:b].lower().split() for a, b in zip(begins, ends)]
    pieces = [piece for piece in zip(begins, ends, words) if piece[2]]
    reach = -1
    for i, (_, _, own) in enumerate(pieces):
        first = last = i
        if len(own) < min_words:
            own = list(own)
            while len(own) < min_words and last + 1 < len(pieces):
                last += 1
                own += pieces[last][2]
            if len(own) < min_words and reach == last:
                return  # The unit before has taken in all that is left.
            while len(own) < min_words and first:
                first -= 1
                own = pieces[first][2] + own
        reach = last
        yield xxhash.xxh3_128_digest(b" ".join(own)), pieces[first][0], pieces[last][1]


def unit_rows(packed: DataFrame, unit: str, min_words: int) -> DataFrame:
    """``(d1, d2, id, k1, k2, a, b)``, one row per unit of every text."""
    schema = f"d1 long, d2 long, id {packed.schema['id'].dataType.simpleString()}, k1 long, k2 long, a int, b int"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_bytes(batch.column("text"))
            rows, digests, begins, ends = [], [], [], []

            def made():
                d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                row = pa.array(np.array(rows, np.int64))
                spans = (pa.array(np.array(x, np.int32)) for x in (begins, ends))
                keys = (batch.column(c).take(row) for c in ("id", "k1", "k2"))
                cells = [pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), *keys, *spans]
                return pa.RecordBatch.from_arrays(cells, schema=arrow)

            for n, (first, last) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                for digest, a, b in units(raw[first:last].tobytes(), unit, min_words):
                    rows.append(n)
                    digests.append(digest)
                    begins.append(a)
                    ends.append(b)
                if len(rows) > 50_000:
                    yield made()
                    rows, digests, begins, ends = [], [], [], []
            if rows:
                yield made()

    return packed.select("id", "text", "k1", "k2").mapInArrow(lean(run), schema)


def later_spans(rows: DataFrame) -> DataFrame:
    """``(k1, k2, a, b)`` of every unit but the earliest of its digest: least id, then offset.

    Digests that occur once leave after a count of 8-byte keys; the counts and the earliest
    occurrence combine on each task before they are shuffled, so a line that a third of the corpus
    shares is one row per task there, and the join back to its places is one that AQE can split.
    """
    rows = materialise(rows, "units")
    twice = rows.groupBy("d1").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("d1")
    rows = materialise(rows.join(materialise(twice, "digests"), "d1", "left_semi"), "units")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "k1", "k2", "a")
    first = rows.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialise(first.filter("n > 1").drop("n"), "first")
    again = rows.join(first, ["d1", "d2"]).filter(place != F.col("first"))
    return materialise(again.select("k1", "k2", "a", "b"), "spans")


def _deduplicated(packed: Packed, unit: str, min_words: int) -> DataFrame:
    if unit not in _CUTS or min_words < 1:
        raise ValueError(f"unit is one of {sorted(_CUTS)}, min_words 1 or more")
    return cut(packed, later_spans(unit_rows(packed.frame, unit, min_words)))


def repeated_units(
    df: DataFrame,
    unit: str = "sentence",
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, spans, kept, n_bytes, n_removed, n_spans)`` for every row of ``df``.

    A unit is a line, a paragraph (cut at blank lines) or a sentence (a line cut after ``.!?``),
    compared in lower-case ASCII letters with white space as one blank. Units under ``min_words``
    words are compared together with the following ones, so that short lines which recur by chance
    stay; at the end of a text, where too little follows, together with the ones before. A text under
    ``min_words`` words is compared as a whole, so all of a later copy of a text goes. The earliest occurrence stays: least id (null last), then least offset. ``spans`` are byte
    offsets into the input text, ``kept`` are the other bytes, valid UTF-8 as cuts lie at blanks.
    Null and empty texts have no unit. Rows equal as a whole count as one place and keep the same.
    """
    return _deduplicated(Packed(df, id_col, text_col), unit, min_words).select(
        "id", "spans", "kept",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        removed_bytes().alias("n_removed"),
        removed_spans().alias("n_spans"),
    )


def without_repeated_units(
    df: DataFrame,
    unit: str = "sentence",
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``df`` with repeated units cut out of its texts; all rows and columns stay, null texts too."""
    packed = Packed(df, id_col, text_col)
    frame = _deduplicated(packed, unit, min_words)
    kept = F.when(F.col("spans").isNotNull(), F.decode("kept", "UTF-8")).otherwise(F.col("text"))
    return packed.unpack(frame, kept)
