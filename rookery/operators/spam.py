"""Spam verdict of flattened posts by seven rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.functions.text import hashtag_count, utf16_length
from rookery.functions.values import parse_ts

# Thresholds and phrases of the rules.
MORE_DAYS_THAN = 1
MORE_STATUSES_THAN = 50
RATIO_ABOVE = 0.01
DESCRIPTION_LONGER_THAN = 20
FEWER_HASHTAGS_THAN = 5
TEXT_LONGER_THAN = 20
FOLLOW_PHRASES = [
    "rt and follow",
    "rt & follow",
    "rt+follow",
    "follow and rt",
    "follow & rt",
    "follow+rt",
]

RULES = [
    "account_age_ok",
    "status_count_ok",
    "followers_ratio_ok",
    "description_ok",
    "hashtag_count_ok",
    "text_length_ok",
    "no_follow_phrase",
]

# The flat fields that the rules read.
INPUTS = ["UserCreated", "UserStatusCount", "UserFollowersRatio", "UserDescription", "Text", "TextLength"]


def _rules(as_of: Column) -> dict[str, Column]:
    age_millis = F.unix_millis(as_of) - F.unix_millis(parse_ts(F.col("UserCreated")))
    # Whole days, cut towards zero.
    age_days = (age_millis / F.lit(86_400_000)).cast("bigint")
    ratio = F.col("UserFollowersRatio")
    lowered = F.lower("Text")
    asks_to_follow = reduce(lambda a, b: a | b, [lowered.contains(p) for p in FOLLOW_PHRASES])
    return {
        "account_age_ok": age_days > MORE_DAYS_THAN,
        "status_count_ok": F.col("UserStatusCount") > MORE_STATUSES_THAN,
        # NaN sorts above every number here, so it has to be excluded by name.
        "followers_ratio_ok": ~F.isnan(ratio) & (ratio > F.lit(RATIO_ABOVE)),
        "description_ok": utf16_length(F.col("UserDescription")) > DESCRIPTION_LONGER_THAN,
        "hashtag_count_ok": hashtag_count(F.col("Text")) < FEWER_HASHTAGS_THAN,
        "text_length_ok": F.col("TextLength") > TEXT_LONGER_THAN,
        "no_follow_phrase": ~asks_to_follow,
    }


def spam_rules(flat: DataFrame, as_of: Column) -> DataFrame:
    """Adds one column per rule; a rule whose input is missing counts as failed."""
    rules = _rules(as_of)
    return flat.select(
        *flat.columns, *[F.coalesce(rules[r], F.lit(False)).alias(r) for r in RULES]
    )


def spam_verdict(flat: DataFrame, as_of: Column) -> DataFrame:
    """Adds the rule columns and ``Spam``: true unless all rules hold."""
    ruled = spam_rules(flat, as_of)
    holds_all = reduce(lambda a, b: a & b, [F.col(r) for r in RULES])
    return ruled.withColumn("Spam", ~holds_all)


def spam_counts(verdicts: DataFrame) -> DataFrame:
    """Posts per verdict, and how many of them pass each rule."""
    passed = [F.count_if(F.col(r)).alias(r) for r in RULES]
    return verdicts.groupBy("Spam").agg(F.count(F.lit(1)).alias("posts"), *passed)
