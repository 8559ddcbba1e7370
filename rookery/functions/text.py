"""Text expressions.

Tokens are what a JVM ``split(" ")`` yields: single spaces separate, trailing empty tokens are
dropped, an empty text is one empty token and an all-space text has none.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token that starts with '#'; a lone '#' qualifies, punctuation is kept.
HASHTAG = r"(?<![^ ])#[^ ]*+"
# A token made of letters and digits only. \z, because $ would also match before a line break.
CLEAN_TOKEN = r"\A[a-zA-Z0-9]+\z"


def space_tokens(text: Column) -> Column:
    """Array of space-separated tokens."""
    trimmed = F.rtrim(text)
    only_spaces = (text != "") & (trimmed == "")
    return F.when(only_spaces, F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units. Texts with one byte per character skip the encoding."""
    return (
        F.when(F.octet_length(text) == F.length(text), F.length(text))
        .otherwise(F.shiftright(F.octet_length(F.encode(text, "UTF-16LE")), 1))
    )


def hashtag_array(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(HASHTAG), F.lit(0))


def hashtag_string(text: Column) -> Column:
    """Hashtags of a text joined by one space, empty when there are none."""
    return F.array_join(hashtag_array(text), " ")


def hashtag_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(HASHTAG))


def only_words(text: Column) -> Column:
    """Drop every token that is not wholly ``[a-zA-Z0-9]+`` and join the rest by one space."""
    return F.array_join(F.filter(F.split(text, " "), lambda t: t.rlike(CLEAN_TOKEN)), " ")


def string_or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def mentions_terms(text: Column, phrase: str) -> Column:
    """Whether every term of ``phrase`` occurs in ``text`` as a whole word, in any order and case."""
    terms = re.findall(r"[^\W_]+", phrase.lower())
    if not terms:
        raise ValueError(f"no word in track phrase {phrase!r}")
    lowered = F.lower(text)
    matched = F.lit(True)
    for term in dict.fromkeys(terms):
        word = rf"(?<![\p{{L}}\p{{N}}]){term}(?![\p{{L}}\p{{N}}])"
        matched = matched & lowered.contains(term) & lowered.rlike(word)
    return matched
