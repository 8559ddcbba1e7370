import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rookery.functions import text as tx
from rookery.operators import tokens

# Everything the traps need: spaces, line breaks, '#', accents, a character outside the BMP.
PIECES = ["", " ", "  ", "a", "foo", "#", "#tag", "#Tag!", "x#y", "foo\n", "é", "a👉b", "A1", "it's"]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


def jvm_split(text):
    """What a JVM split on one space returns."""
    if text == "":
        return [""]
    parts = text.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def one_column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")


def evaluate(spark, values, column):
    rows = one_column(spark, values).select("i", column.alias("v")).collect()
    return [r.v for r in sorted(rows, key=lambda r: r.i)]


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXTS, min_size=30, max_size=60))
def test_text_functions_match_plain_python(spark, texts):
    split = [jvm_split(t) for t in texts]
    assert evaluate(spark, texts, tx.space_tokens(F.col("text"))) == split
    assert evaluate(spark, texts, tx.utf16_length(F.col("text"))) == [
        len(t.encode("utf-16-le")) // 2 for t in texts
    ]
    assert evaluate(spark, texts, tx.only_words(F.col("text"))) == [
        " ".join(w for w in s if re.fullmatch("[a-zA-Z0-9]+", w)) for s in split
    ]
    tags = [[w for w in s if w.startswith("#")] for s in split]
    assert evaluate(spark, texts, tx.hashtag_array(F.col("text"))) == tags
    assert evaluate(spark, texts, tx.hashtag_string(F.col("text"))) == [" ".join(t) for t in tags]
    assert evaluate(spark, texts, tx.hashtag_count(F.col("text"))) == [len(t) for t in tags]


def test_tokens_of_blank_texts(spark):
    assert evaluate(spark, ["", "   ", " a  b  "], tx.space_tokens(F.col("text"))) == [
        [""], [], ["", "a", "", "b"],
    ]


def test_only_words_drops_a_token_that_ends_in_a_line_break(spark):
    assert evaluate(spark, ["foo\n bar", "foo\n"], tx.only_words(F.col("text"))) == ["bar", ""]


def test_length_counts_utf16_units(spark):
    assert evaluate(spark, ["a👉b", "é", None], tx.utf16_length(F.col("text"))) == [4, 1, None]


def test_word_count_keeps_words_longer_than_four_units(spark):
    df = one_column(spark, ["Hello hello four x👉yz 👉👉👉", "hello world world", ""])
    got = [(r.word, r["count"]) for r in tokens.word_count(df).collect()]
    assert got == [("hello", 3), ("world", 2), ("x👉yz", 1), ("👉👉👉", 1)]


def test_top_words_by_count_and_by_word(spark):
    df = one_column(spark, ["apple apple berry", "cherry cherry cherry"])
    assert [r.word for r in tokens.top_words(df, 2).collect()] == ["cherry", "apple"]
    assert [r.word for r in tokens.last_words(df, 2).collect()] == ["cherry", "berry"]


def test_pairs_as_text(spark):
    df = spark.createDataFrame([("apple", 2)], "word string, count bigint")
    assert tokens.pairs_as_text(df).first().value == "(apple,2)"


@pytest.mark.parametrize(
    "text, phrase, expected",
    [
        ("All THE things", "the things", True),
        ("things of the past", "the things", True),
        ("nothing here", "thing", False),
        ("a thing.", "thing", True),
        ("#thing", "thing", True),
        ("élan vital", "lan", False),
        ("", "thing", False),
    ],
)
def test_track_phrases_match_whole_words_in_any_order(spark, text, phrase, expected):
    assert evaluate(spark, [text], tx.mentions_terms(F.col("text"), phrase)) == [expected]


def test_track_phrase_without_a_word_is_refused():
    with pytest.raises(ValueError):
        tx.mentions_terms(F.lit("x"), " - ")
