"""Line-oriented inputs: text files, line streams, delimited records, numeric vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.functions.text import space_tokens
from rookery.functions.values import complete, inside, numbers, vector_entries


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_line_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Lines of the files that land in ``path``; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def _or_raise(value: Column, line: Column, what: str) -> Column:
    message = F.concat(F.lit(f"not a {what}: "), line)
    return F.when(value.isNull(), F.raise_error(message)).otherwise(value)


def parse_people(lines: DataFrame, strict: bool = False) -> DataFrame:
    """``name age`` lines as ``(name, age, malformed)``.

    Field 0 is the name and the trimmed field 1 the age. A line without a readable age is kept
    with ``malformed`` set; with ``strict`` it fails the query.
    """
    fields = space_tokens(F.col("value"))
    name = F.get(fields, F.lit(0))
    digits = F.btrim(F.get(fields, F.lit(1)), F.lit(" \t\r\n\x0b\x0c"))
    # A cast alone would also read '3.7'.
    age = F.when(digits.rlike(r"\A[+-]?[0-9]+\z"), digits.try_cast("int"))
    if strict:
        age = _or_raise(age, F.col("value"), "person")
    return lines.select(name.alias("name"), age.alias("age"), age.isNull().alias("malformed"))


def parse_vectors(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Vector lines as a ``features array<double>`` column; NULL when unreadable."""
    # Two steps, so that the line is taken apart once and only its entries are looked at twice.
    entries = lines.select("value", vector_entries(F.col("value")).alias("entries"))
    features = complete(F.col("entries"))
    if strict:
        features = _or_raise(features, F.col("value"), "vector")
    return entries.select(features.alias("features"))


def parse_labeled_points(lines: DataFrame, strict: bool = False) -> DataFrame:
    """``(1.0,[2.0,3.0])`` or plain ``1.0,2.0 3.0`` lines as ``(label, features)``.

    Both are NULL when the line is unreadable. The steps keep each part from being cut out again
    for every use of it.
    """
    trimmed = F.trim("value")
    tupled = trimmed.startswith("(") & trimmed.endswith(")")
    cut = lines.select("value", tupled.alias("tupled"), trimmed.alias("line"))
    body = F.when(F.col("tupled"), inside(F.col("line"))).otherwise(F.col("line"))
    cut = cut.select("value", "tupled", body.alias("body"))
    comma = F.locate(",", F.col("body"))
    cut = cut.select(
        "value",
        "tupled",
        F.when(comma > 0, F.substr("body", F.lit(1), comma - 1)).try_cast("double").alias("label"),
        F.trim(F.substr("body", comma + 1)).alias("rest"),
    )
    entries = F.when(F.col("tupled"), vector_entries(F.col("rest")))
    entries = entries.otherwise(numbers(F.col("rest"), " +"))
    points = cut.select("value", "label", entries.alias("entries"))
    points = points.select("value", "label", complete(F.col("entries")).alias("features"))
    readable = F.col("label").isNotNull() & F.col("features").isNotNull()
    features = F.when(readable, F.col("features"))
    if strict:
        features = _or_raise(features, F.col("value"), "labelled point")
    label = F.when(readable, F.col("label"))
    return points.select(label.alias("label"), features.alias("features"))
