"""Counts, distinct rows and top-k reports over flattened posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _top_counts(df: DataFrame, key: str, out: str, limit: int) -> DataFrame:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return counts.orderBy(F.desc(out), F.asc_nulls_last(key)).limit(limit)


def lang_counts(flat: DataFrame, limit: int = 1000) -> DataFrame:
    """Posts per user language, largest first."""
    return _top_counts(flat, "UserLang", "Counts", limit)


def location_counts(flat: DataFrame, limit: int = 10) -> DataFrame:
    """Posts per user location, largest first; no location is a group of its own."""
    return _top_counts(flat, "UserLocation", "LoCount", limit)


def top_friends(flat: DataFrame, limit: int = 10) -> DataFrame:
    """Distinct users with the most friends."""
    users = flat.select("UserName", "UserFriendsCount", "UserLang").distinct()
    order = [F.desc("UserFriendsCount"), F.asc_nulls_last("UserName"), F.asc_nulls_last("UserLang")]
    return users.orderBy(*order).limit(limit)


def verified_users(flat: DataFrame) -> DataFrame:
    """Distinct pairs of user name and verification."""
    return flat.select("UserName", "UserVerification").distinct()


def posts_in_language(
    flat: DataFrame, lang: str = "en", limit: int = 10, order_by: str = "post_id"
) -> DataFrame:
    """The first posts written in one user language."""
    picked = flat.filter(F.col("UserLang") == lang).orderBy(order_by).limit(limit)
    return picked.select("UserLang", "UserName", "Text")


def texts_in_language(
    flat: DataFrame, lang: str = "en", limit: int = 10, order_by: str = "post_id"
) -> DataFrame:
    """The texts of the first posts written in one user language."""
    picked = flat.filter(F.col("UserLang") == lang).orderBy(order_by).limit(limit)
    return picked.select("Text")


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows of a total order."""
    return df.orderBy(*order_by).limit(n)


def sample_rows(df: DataFrame, n: int, id_col: str) -> DataFrame:
    """``n`` rows with the lowest ids."""
    return preview(df, n, [id_col])


def split_summary(df: DataFrame, is_train: Column) -> DataFrame:
    """Sizes of both parts of a split and their percentages, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_train).alias("train"),
        F.count_if(~is_train).alias("test"),
    )

    def share(part: str) -> Column:
        return F.when(F.col("total") > 0, F.col(part) * 100 / F.col("total").cast("double"))

    return counts.select(
        "total", "train", "test", share("train").alias("train_pct"), share("test").alias("test_pct")
    )
