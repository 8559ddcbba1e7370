import re

import pytest
from pyspark.sql import functions as F

from rookery.operators import bounds, sentiment, tokens
from rookery.sources.lexicon import count_entries, word_weights
from rookery.streaming.batches import drain
from rookery.streaming.sentiment import write_sentiment

TEXTS = [
    (1, "a Good day"),
    (2, "good! good"),
    (3, "bad bad good"),
    (4, "nothing  here "),
    (5, ""),
    (6, "good\nbad"),
    (7, "twice"),
]


def weights(spark):
    def entries(*words):
        return count_entries(spark.createDataFrame([(w,) for w in words], "word string"))

    return word_weights(entries("Good", "twice", "twice", "", "even"), entries("bad", "even"))


def posts(spark):
    return spark.createDataFrame(TEXTS, "post_id long, text string")


EXPECTED = {1: (1, "1"), 2: (1, "1"), 3: (-1, "0"), 4: (0, "2"), 5: (0, "2"), 6: (0, "2"), 7: (2, "1")}


@pytest.mark.parametrize(
    "lowered, plan",
    [
        ({}, "LocalTableScan|Project"),
        ({"INLINE_WORDS": 0}, "BroadcastHashJoin \\[word"),
        ({"INLINE_BYTES": 3}, "BroadcastHashJoin \\[word"),
        ({"INLINE_WORDS": 0, "BROADCAST_ROWS": 0}, "_salt"),
        ({"INLINE_WORDS": 0, "BROADCAST_BYTES": 3}, "_salt"),
    ],
    ids=["in the plan", "too many words", "too many bytes", "too many rows", "too large"],
)
def test_scores_on_every_route(spark, monkeypatch, lowered, plan):
    for name, bound in lowered.items():
        monkeypatch.setattr(bounds if name.startswith("BROADCAST") else sentiment, name, bound)
    scored = sentiment.lexicon_sentiment(posts(spark), weights(spark))
    assert {r.post_id: (r.score, r.sentiment) for r in scored.collect()} == EXPECTED
    assert re.search(plan, scored._jdf.queryExecution().toString())
    # Posts delivered twice, posts without an id or a text, and words listed twice.
    odd = [(1, "good good"), (1, "bad"), (None, "good"), (None, None), (1, "bad")]
    twice = spark.createDataFrame([("good", 1), ("bad", -1), ("bad", -1)], "word string, weight long")
    got = sentiment.lexicon_sentiment(spark.createDataFrame(odd, "post_id long, text string"), twice)
    assert sorted(r.score for r in got.collect()) == [-2, -2, 0, 1, 2]


def test_frequent_words_of_a_long_list_are_not_shuffled(spark, monkeypatch):
    """Only tokens of rare words meet the list by a shuffle, and listed words of any length count."""
    monkeypatch.setattr(sentiment, "INLINE_WORDS", 0)
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(bounds, "BROADCAST_BYTES", 30)
    long = "g" * 11
    listed = [("a", 1), ("b", -2), ("c", 5), ("d", 7), (long, 100)]
    rows = [(i, f"a a the the the {'b' if i % 2 else 'c'} x{i} {long if i < 20 else ''}") for i in range(40)]
    rows += [(40, "D d unlisted"), (40, "D d unlisted"), (41, None)]
    df = spark.createDataFrame(rows, "post_id long, text string")
    joined = []
    monkeypatch.setattr(sentiment, "word_join", lambda t, *a, **k: joined.append((t, k["hot"])) or bounds.word_join(t, *a, **k))
    got = sentiment.lexicon_sentiment(df, spark.createDataFrame(listed, "word string, weight long"))
    want = {i: 2 + (-2 if i % 2 else 5) + (100 if i < 20 else 0) for i in range(40)} | {40: 14, 41: 0}
    assert {r.post_id: r.score for r in got.collect()} == want and got.count() == 43
    (rare, hot), = joined
    words = [r.word for r in rare.collect()]
    # "the" and "a" are common, the blank is too or one of the steps is full; the long word is hot.
    assert words.count("the") == words.count("a") == 0 and words.count(long) == 20 and words.count("d") == 4
    assert long in hot


def test_short_lists_need_no_shuffle(spark):
    plan = sentiment.lexicon_sentiment(posts(spark), weights(spark))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("rows", [200_000, 1], ids=["broadcast", "salted"])
@pytest.mark.parametrize("inline", [20_000, 0])
def test_lists_of_any_length_on_streams(spark, tmp_path, monkeypatch, rows, inline):
    monkeypatch.setattr(sentiment, "INLINE_WORDS", inline)
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", rows)
    # Two batches, the same posts in both.
    for _ in range(2):
        posts(spark).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("post_id long, text string").option("maxFilesPerTrigger", 1)
    stream = stream.parquet(f"{tmp_path}/in")
    drain(write_sentiment(stream, weights(spark), f"{tmp_path}/out", "b", f"{tmp_path}/c", keep=["post_id"]))
    for batch in (0, 1):
        out = spark.read.parquet(f"{tmp_path}/out/b_{batch}")
        assert out.columns == ["post_id", "score", "sentiment"]
        assert {r.post_id: (r.score, r.sentiment) for r in out.collect()} == EXPECTED and out.count() == len(EXPECTED)


def test_long_lists_are_refused_where_a_stream_has_no_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sentiment, "INLINE_WORDS", 0)
    posts(spark).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("post_id long, text string").parquet(f"{tmp_path}/in")
    with pytest.raises(ValueError, match="write_sentiment"):
        sentiment.lexicon_sentiment(stream, weights(spark))


def test_long_lists_are_joined_by_word_and_summed_before_the_shuffle(spark, monkeypatch):
    """The list is on no row of posts: it meets tokens only, and hits are summed below the exchange."""
    monkeypatch.setattr(sentiment, "INLINE_WORDS", 0)
    scored = sentiment.lexicon_sentiment(posts(spark), weights(spark)).drop("text")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "map<" not in plan
    # From the top down: the final sum, its shuffle, the partial sum, the join on the word.
    assert re.search(r"functions=\[sum\(weight.*Exchange hashpartitioning\(_k1.*partial_sum\(weight.*BroadcastHashJoin \[word", plan, re.S)


def test_posts_without_an_id_column(spark, monkeypatch):
    monkeypatch.setattr(sentiment, "INLINE_WORDS", 0)
    odd = spark.createDataFrame([("good good",), ("good good",), ("bad",), (None,), ("",)], "text string")
    got = sentiment.lexicon_sentiment(odd, sentiment.lexicon(weights(spark)))
    assert sorted((r.text, r.score) for r in got.filter("text is not null").collect()) == [("", 0), ("bad", -1), ("good good", 2), ("good good", 2)]
    assert got.filter("text is null").first().score == 0


def test_counts_and_labels(spark):
    scored = sentiment.lexicon_sentiment(posts(spark), weights(spark))
    counts = {r.sentiment: r.posts for r in sentiment.sentiment_counts(scored).collect()}
    assert counts == {"1": 3, "0": 1, "2": 3}
    labelled = sentiment.labelled_text(posts(spark), weights(spark))
    got = {r.post_id: (r.text, r.label) for r in labelled.collect()}
    assert got[2] == ("good", 1.0) and got[3] == ("bad bad good", 0.0) and got[6] == ("", 2.0)


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_stop_words_in_any_case_and_listed_twice(spark, monkeypatch, broadcast):
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", broadcast)
    words = tokens.explode_tokens(
        spark.createDataFrame([(1, "The end of THE day")], "id long, text string"), out="word"
    )
    stop = spark.createDataFrame([("the",), ("the",), ("Of",)], "word string")
    kept = sentiment.remove_stop_words(words, stop, "id")
    assert sorted(r.word for r in kept.collect()) == ["day", "end"]


def test_salted_join_spreads_one_hot_word(spark, monkeypatch):
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", 0)
    # A third of all rows hold one word.
    rows = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), "id")).alias("word"),
    )
    listed = spark.createDataFrame([("hot", 1), ("w1", 5)], "word string, weight long")
    joined = bounds.word_join(rows, listed, spread_by="id")
    assert joined.count() == 1001
    plan = joined._jdf.queryExecution().toString()
    assert "_salt" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    # Only the hot word is repeated in the list and dealt out.
    assert bounds.hot_words(rows, "word", 16) == ["hot"]
    assert bounds.hot_words(rows.filter("word <> 'hot'"), "word", 16) == []
    assert bounds.hot_words(rows.limit(0), "word", 16) == []
    assert "IN (hot)" in plan or "= hot" in plan


def test_large_lists_join_every_word_once(spark, monkeypatch):
    words = spark.range(2000).select("id", F.concat(F.lit("w"), F.col("id") % 50).alias("word"))
    words = words.unionByName(spark.range(900).select("id", F.lit(None).cast("string").alias("word")))
    words = words.unionByName(spark.range(900).select("id", F.lit("hot").alias("word")))
    listed = spark.range(0, 50, 2).select(F.concat(F.lit("w"), "id").alias("word"))
    listed = listed.unionByName(spark.createDataFrame([("hot",), ("absent",)], "word string"))
    want = {how: sorted(map(str, bounds.word_join(words, listed, "id", how).collect())) for how in ("inner", "left_anti")}
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", 0)
    for how, rows in want.items():
        assert sorted(map(str, bounds.word_join(words, listed, "id", how).collect())) == rows and rows
