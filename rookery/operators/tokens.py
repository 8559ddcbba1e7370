"""Tokens, hashtags and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.functions.text import hashtag_array, space_tokens, utf16_length


def explode_tokens(df: DataFrame, col: str = "text", out: str = "token") -> DataFrame:
    """One row per space-separated token, beside the other columns."""
    kept = [c for c in df.columns if c != col]
    return df.select(*kept, F.explode(space_tokens(F.col(col))).alias(out))


def min_token_length(df: DataFrame, n: int = 4, col: str = "token") -> DataFrame:
    """Tokens longer than ``n`` UTF-16 units."""
    # A text never has fewer units than characters, so most tokens are settled by the first test.
    return df.filter((F.length(col) > n) | (utf16_length(F.col(col)) > n))


def hashtags(df: DataFrame, col: str = "text", out: str = "tag") -> DataFrame:
    """One row per hashtag token, beside the other columns."""
    kept = [c for c in df.columns if c != col]
    return df.select(*kept, F.explode(hashtag_array(F.col(col))).alias(out))


def sort_by_count(counts: DataFrame, key: str, count: str = "count") -> DataFrame:
    """Descending by count; the key breaks ties."""
    return counts.orderBy(F.desc(count), key)


def count_words(df: DataFrame, col: str = "text", longer_than: int = 4) -> DataFrame:
    """``(word, count)`` of lower-cased tokens longer than ``longer_than``, unordered."""
    tokens = min_token_length(explode_tokens(df.select(col), col), longer_than)
    return tokens.groupBy(F.lower("token").alias("word")).agg(F.count(F.lit(1)).alias("count"))


def word_count(df: DataFrame, col: str = "text", longer_than: int = 4) -> DataFrame:
    """Word counts, most frequent first."""
    return sort_by_count(count_words(df, col, longer_than), "word")


def top_words(df: DataFrame, k: int = 10, col: str = "text") -> DataFrame:
    """The ``k`` most frequent words."""
    return sort_by_count(count_words(df, col), "word").limit(k)


def last_words(df: DataFrame, k: int = 20, col: str = "text") -> DataFrame:
    """The ``k`` greatest ``(word, count)`` pairs, i.e. the last words in binary order."""
    return count_words(df, col).orderBy(F.desc("word"), F.desc("count")).limit(k)


def pairs_as_text(pairs: DataFrame, key: str = "word", count: str = "count") -> DataFrame:
    """``(key,count)`` lines."""
    line = F.concat(F.lit("("), F.col(key), F.lit(","), F.col(count).cast("string"), F.lit(")"))
    return pairs.select(line.alias("value"))
