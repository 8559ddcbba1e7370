"""Word lists and the word weights made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A list with one entry per line as ``(word, n)``: lower-cased, no blanks, repeats counted."""
    return count_entries(spark.read.text(path).select(F.col("value").alias("word")))


def count_entries(words: DataFrame) -> DataFrame:
    return (
        words.select(F.lower("word").alias("word"))
        .filter(F.col("word") != "")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def word_weights(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """``(word, weight)``: times in the positive list minus times in the negative list."""
    signed = positive.select("word", "n").unionByName(
        negative.select("word", (-F.col("n")).alias("n"))
    )
    return signed.groupBy("word").agg(F.sum("n").alias("weight")).filter("weight <> 0")
