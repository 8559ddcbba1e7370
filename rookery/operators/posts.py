"""Projections and filters over posts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.functions.text import hashtag_string, mentions_terms, utf16_length
from rookery.functions.values import followers_ratio, format_ts

# Fixed value: names and order of the flattened post fields.
FLAT_FIELDS = [
    "UserID",
    "UserDescription",
    "UserScreenName",
    "UserFriendsCount",
    "UserFavouritesCount",
    "UserFollowersCount",
    "UserFollowersRatio",
    "GeoLatitude",
    "GeoLongitude",
    "UserLang",
    "UserLocation",
    "UserVerification",
    "UserName",
    "UserStatusCount",
    "UserCreated",
    "Text",
    "TextLength",
    "HashTags",
    "StatusCreatedAt",
]


def post_text(posts: DataFrame) -> DataFrame:
    return posts.select("text")


def flatten_posts(
    posts: DataFrame, keep: Sequence[str] = (), only: Sequence[str] = FLAT_FIELDS
) -> DataFrame:
    """The flat fields of each nested post named in ``only``, after the columns named in ``keep``."""
    text = F.col("text")
    fields = {
        "UserID": lambda: F.col("user.id"),
        "UserDescription": lambda: F.col("user.description"),
        "UserScreenName": lambda: F.col("user.screen_name"),
        "UserFriendsCount": lambda: F.col("user.friends_count"),
        "UserFavouritesCount": lambda: F.col("user.favourites_count"),
        "UserFollowersCount": lambda: F.col("user.followers_count"),
        "UserFollowersRatio": lambda: followers_ratio(
            F.col("user.followers_count"), F.col("user.friends_count")
        ),
        "GeoLatitude": lambda: F.col("geo.lat"),
        "GeoLongitude": lambda: F.col("geo.lon"),
        "UserLang": lambda: F.col("user.lang"),
        "UserLocation": lambda: F.col("user.location"),
        "UserVerification": lambda: F.col("user.verified"),
        "UserName": lambda: F.col("user.name"),
        "UserStatusCount": lambda: F.col("user.statuses_count"),
        "UserCreated": lambda: format_ts(F.col("user.created_at")),
        "Text": lambda: text,
        "TextLength": lambda: utf16_length(text),
        "HashTags": lambda: hashtag_string(text),
        "StatusCreatedAt": lambda: format_ts(F.col("ts")),
    }
    return posts.select(*keep, *[fields[name]().alias(name) for name in only])


def lang_filter(posts: DataFrame, lang: str = "en") -> DataFrame:
    return posts.filter(F.col("lang") == lang)


def track_filter(df: DataFrame, phrases: Sequence[str], col: str = "text") -> DataFrame:
    """Posts that mention all words of at least one phrase."""
    if not phrases:
        return df
    return df.filter(reduce(lambda a, b: a | b, [mentions_terms(F.col(col), p) for p in phrases]))


def label_rows(df: DataFrame, col: str = "name", prefix: str = "Name: ") -> DataFrame:
    """One text per row: the prefix and the column."""
    return df.select(F.concat(F.lit(prefix), F.col(col)).alias("label"))


def rows_as_map(df: DataFrame, cols: Sequence[str], out: str = "row") -> DataFrame:
    """The named columns of each row as one map of strings."""
    entries = [part for c in cols for part in (F.lit(c), F.col(c).cast("string"))]
    return df.select(F.create_map(*entries).alias(out))


def posts_to_json(flat: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Each flat post as one JSON text with a fixed set of fields."""
    cols = [c for c in flat.columns if c not in keep]
    body = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return flat.select(*keep, body.alias("value"))
