"""Scalar expressions for post fields and numeric text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date-time text format of flattened posts.
POST_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"

_SPARSE = r"\A\(\s*(\d+)\s*,\s*\[([^\[\]()]*)\]\s*,\s*\[([^\[\]()]*)\]\s*\)\z"


def followers_ratio(followers: Column, friends: Column) -> Column:
    """32-bit quotient widened to double, with the IEEE results for a zero divisor."""
    quotient = (followers.cast("float") / F.nullif(friends, F.lit(0)).cast("float")).cast("float")
    return (
        F.when((friends == 0) & (followers == 0), F.lit(float("nan")))
        .when((friends == 0) & (followers > 0), F.lit(float("inf")))
        .when((friends == 0) & (followers < 0), F.lit(float("-inf")))
        .otherwise(quotient.cast("double"))
    )


def format_ts(ts: Column) -> Column:
    return F.date_format(ts, POST_TIME_FORMAT)


def parse_ts(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(POST_TIME_FORMAT))


def numbers(body: Column, separator: str) -> Column:
    """Doubles of a separated list; an entry that is no number is NULL."""
    # The cast trims each entry.
    parsed = F.split(body, separator).try_cast("array<double>")
    return F.when(F.trim(body) == "", F.array().cast("array<double>")).otherwise(parsed)


def complete(values: Column) -> Column:
    """The array if it has no NULL entry, else NULL."""
    return F.when(F.forall(values, lambda v: v.isNotNull()), values)


def inside(text: Column) -> Column:
    """The text without its first and last character."""
    return F.substr(text, F.lit(2), F.length(text) - 2)


def _dense(text: Column) -> Column:
    return F.when(text.startswith("[") & text.endswith("]"), numbers(inside(text), ","))


def _sparse(text: Column) -> Column:
    size = F.regexp_extract(text, _SPARSE, 1).try_cast("int")
    positions = complete(numbers(F.regexp_extract(text, _SPARSE, 2), ","))
    values = complete(numbers(F.regexp_extract(text, _SPARSE, 3), ","))
    filled = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.coalesce(
            F.get(values, (F.array_position(positions, i.cast("double")) - 1).cast("int")),
            F.lit(0.0),
        ),
    )
    return F.when((size > 0) & (F.size(positions) == F.size(values)), filled)


def vector_entries(text: Column) -> Column:
    """``[1.0,2.0]`` or the sparse ``(size,[positions],[values])`` as ``array<double>``.

    NULL for other texts; a dense entry that is no number is a NULL entry, see ``complete``.
    """
    text = F.trim(text)
    return F.when(text.startswith("("), _sparse(text)).otherwise(_dense(text))
