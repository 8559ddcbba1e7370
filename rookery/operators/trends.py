"""Sliding-window counts in batch form.

Windows are ``[start, start + window)`` in event time with starts on multiples of the slide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rookery.operators.bounds import top_per_group
from rookery.operators.tokens import hashtags

# Window and slide of trending hashtags, in seconds.
WINDOW_SECONDS = 300
SLIDE_SECONDS = 1

# Length of one stretch of time that is summed by one task, in windows.
_STRETCH_WINDOWS = 8


def check_window(window_s: int, slide_s: int) -> None:
    if slide_s <= 0 or window_s <= 0 or window_s % slide_s:
        raise ValueError("the window must be a positive multiple of the slide")


def slide_counts(keyed: DataFrame, key: str, slide_s: int, ts: str = "ts") -> DataFrame:
    """``(key, bucket, n)``: rows per key and slide, ``bucket`` in epoch seconds."""
    second = F.unix_timestamp(ts)
    bucket = second - F.pmod(second, F.lit(slide_s))
    return keyed.groupBy(key, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def sliding_counts(counts: DataFrame, key: str, window_s: int, slide_s: int) -> DataFrame:
    """``(window_start, window_end, key, count)`` of every window that holds a row.

    Each slide count is added when the first window reaches it and subtracted when the last one
    leaves it, so a busy key costs two rows per slide and not one per window. Time is cut into
    stretches to bound what one task sorts for one key; a count whose windows start in two
    stretches goes to both.
    """
    check_window(window_s, slide_s)
    stretch_s = window_s * _STRETCH_WINDOWS
    first = F.col("bucket") - (window_s - slide_s)

    def stretch(second):
        return F.floor(second / F.lit(stretch_s)).cast("bigint")

    placed = counts.select(
        key,
        "n",
        first.alias("first"),
        "bucket",
        F.explode(F.sequence(stretch(first), stretch(F.col("bucket")))).alias("stretch"),
    )
    joins = F.greatest(F.col("first"), F.col("stretch") * stretch_s)
    leaves = F.least(F.col("bucket") + slide_s, (F.col("stretch") + 1) * stretch_s)
    changes = placed.select(
        key,
        "stretch",
        F.inline(
            F.array(
                F.struct(joins.alias("at"), F.col("n").alias("change")),
                F.struct(leaves.alias("at"), (-F.col("n")).alias("change")),
            )
        ),
    )
    # The default frame takes in all changes of the same second.
    in_order = Window.partitionBy(key, "stretch").orderBy("at")
    running = changes.select(
        key,
        "at",
        F.sum("change").over(in_order).alias("count"),
        F.lead("at").over(in_order).alias("until"),
    ).filter((F.col("count") > 0) & (F.col("until") > F.col("at")))
    starts = F.sequence("at", F.col("until") - slide_s, F.lit(slide_s).cast("bigint"))
    return running.select(key, "count", F.explode(starts).alias("start")).select(
        F.timestamp_seconds("start").alias("window_start"),
        F.timestamp_seconds(F.col("start") + window_s).alias("window_end"),
        key,
        "count",
    )


def hashtag_window_counts(
    posts: DataFrame, window_s: int = WINDOW_SECONDS, slide_s: int = SLIDE_SECONDS
) -> DataFrame:
    """Posts per hashtag in every sliding window."""
    tags = hashtags(posts.select("ts", "text"))
    return sliding_counts(slide_counts(tags, "tag", slide_s), "tag", window_s, slide_s)


def top_hashtags_per_window(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent tags of each window, with their rank."""
    order = [F.desc("count"), F.asc("tag")]
    return top_per_group(counts, ["window_start", "window_end"], order, k, spread_by="tag")
