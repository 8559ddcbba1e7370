"""Lexicon sentiment of posts."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.functions.text import only_words
from rookery.operators import bounds
from rookery.operators.bounds import WordListSize, word_join, word_list_size
from rookery.operators.sinks import write_parquet
from rookery.session import scratch_dir

# Weights up to this size travel inside the plan.
INLINE_WORDS = 20_000
INLINE_BYTES = 1 << 20

# The label texts.
POSITIVE, NEGATIVE, NEUTRAL = "1", "0", "2"


def sentiment_label(score: Column) -> Column:
    return F.when(score > 0, POSITIVE).when(score < 0, NEGATIVE).otherwise(NEUTRAL)


def _inline_weights(weights: DataFrame) -> tuple[Column, int]:
    """A short word table as an array of small maps, addressed by the hash of a word."""
    rows = weights.select("word", "weight", F.xxhash64("word").alias("hash")).collect()
    slots = max(len(rows), 1)
    maps: list[dict[str, int]] = [{} for _ in range(slots)]
    for row in rows:
        maps[row.hash % slots][row.word] = row.weight
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,bigint>>"), slots


def _inline_score(text: Column, maps: Column, slots: int) -> Column:
    def add(total: Column, word: Column) -> Column:
        slot = F.pmod(F.xxhash64(word), F.lit(slots)).cast("int")
        return total + F.coalesce(F.try_element_at(F.get(maps, slot), word), F.lit(0))

    # Empty tokens are not listed, so they need no care here.
    return F.aggregate(F.split(F.lower(text), " "), F.lit(0).cast("bigint"), add)


@dataclass(frozen=True)
class Lexicon:
    """A word table with one row per word, and how large it is."""

    weights: DataFrame
    size: WordListSize

    @property
    def inline(self) -> bool:
        return self.size.within(INLINE_WORDS, INLINE_BYTES)


def lexicon(weights: DataFrame) -> Lexicon:
    """``(word, weight)`` with the weights of a word listed twice added up; counts the list."""
    weights = weights.groupBy("word").agg(F.sum("weight").cast("bigint").alias("weight"))
    return Lexicon(weights, word_list_size(weights))


def _common_words(tokens: DataFrame, words: Lexicon) -> tuple[DataFrame, list[str]]:
    """``(word, weight, _listed)`` of the most frequent words of the tokens, listed or not, written out.

    As many as may be broadcast, by rows and by bytes: longer words are not taken. The least count of
    the common words comes from a histogram of counts, so no list is sorted. Words that are not
    listed have no weight and ``_listed`` false, so their tokens need no join either. Beside them the
    hot ones of all other words (see ``bounds.hot_words``).
    """
    spark, rows = tokens.sparkSession, bounds.BROADCAST_ROWS
    longest = bounds.BROADCAST_BYTES // max(rows, 1)
    path = scratch_dir(spark, "common-words")

    def written(df: DataFrame, name: str) -> DataFrame:
        write_parquet(df, f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    counts = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # Counts of up to a hundred stand alone, others by their size: few steps whatever the tokens.
    step = F.when(F.col("n") <= 100, F.col("n")).otherwise(F.floor(F.log2("n") * 16) + 100)
    step = F.when(F.octet_length("word") <= longest, step).otherwise(0)
    counts = written(counts.withColumn("step", step), "counts")
    steps = counts.groupBy("step").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).collect()
    taken, rest, least = 0, sum(r.tokens for r in steps), None
    for r in sorted(steps, reverse=True):
        taken += r.words
        if not r.step or taken > rows:
            break
        rest, least = rest - r.tokens, r.step
    is_common = F.lit(False) if least is None else F.col("step") >= least
    common = counts.filter(is_common).select("word").join(words.weights.select("word", "weight"), "word", "left")
    common = written(common.withColumn("_listed", F.col("weight").isNotNull()), "common")
    hot = counts.filter(~is_common).filter(F.col("n") * (4 * bounds.salts(tokens)) > rest)
    return common, [r.word for r in hot.select("word").collect()]


def _hit_scores(keyed: DataFrame, words: Lexicon, text_col: str) -> DataFrame:
    """``(_k1, _k2, score)`` of the rows with at least one listed word.

    Tokens meet the list in a hash join on the word. Each task sums the hits of a row key before
    anything is shuffled, so what moves is one short row per post. Rows that share a key are
    repeats of each other: their sum is divided by their number, which the first tokens count.
    """
    lowered = keyed.select("_k1", "_k2", F.lower(text_col).alias("text")).filter("text is not null")
    tokens = lowered.select("_k1", "_k2", F.posexplode(F.split("text", " ")).alias("_at", "word"))
    if words.size.within(bounds.BROADCAST_ROWS, bounds.BROADCAST_BYTES):
        hits = tokens.join(F.broadcast(words.weights), "word", "left")
    else:
        # Most tokens are repeats of some words, which meet their weights where they lie.
        common, hot = _common_words(tokens, words)
        met = tokens.join(F.broadcast(common), "word", "left")
        rare = met.filter("_listed is null").select("_k1", "_k2", "word")
        # Rare tokens that are not listed go out in the join.
        hits = word_join(rare, words.weights, spread_by="_k1", size=words.size, hot=hot)
        hits = hits.select("_k1", "_k2", F.lit(1).alias("_at"), "weight").unionByName(
            met.filter("weight is not null or _at = 0").select("_k1", "_k2", "_at", "weight")
        )
    sums = hits.groupBy("_k1", "_k2").agg(F.sum("weight").alias("total"), F.count_if(F.col("_at") == 0).alias("rows"))
    return sums.filter("total is not null").select("_k1", "_k2", F.expr("total div rows").alias("score"))


def _with_hit_score(posts: DataFrame, words: Lexicon, id_col: str, text_col: str) -> DataFrame:
    """Adds ``score`` by a join on two hashes of id and text."""
    key = [F.col(id_col), F.col(text_col)] if id_col in posts.columns else [F.col(text_col)]
    keyed = posts.withColumns({"_k1": F.xxhash64(*key), "_k2": F.xxhash64(F.lit("post"), *key)})
    scored = keyed.join(_hit_scores(keyed, words, text_col), ["_k1", "_k2"], "left")
    return scored.drop("_k1", "_k2").fillna(0, ["score"])


def lexicon_sentiment(
    posts: DataFrame, weights: DataFrame | Lexicon, id_col: str = "post_id", text_col: str = "text"
) -> DataFrame:
    """Adds ``score`` and ``sentiment`` to each row of ``posts``, whatever the length of the list.

    ``weights`` holds ``(word, weight)``; weights of a word listed twice add up. The score is the sum
    of the weights of the lower-cased space tokens of the raw text, 0 for a null text. A short list
    travels in the plan and scoring is a projection, on streams too. For a longer one the tokens are
    joined to the list: broadcast up to a bound. Beyond it the frequent words of the texts are
    broadcast, and the tokens of all others go to the list by salted hash joins. The text itself moves
    only if it is asked for beside the score. Streams take long lists batch by batch
    (``streaming.sentiment``). The word table is read more than once; write it out first when it is
    costly to make, or pass the ``lexicon`` of it to score many frames.
    """
    words = weights if isinstance(weights, Lexicon) else lexicon(weights)
    if words.inline:
        score = _inline_score(F.col(text_col), *_inline_weights(words.weights))
        scored = posts.withColumn("score", F.coalesce(score, F.lit(0)))
    elif posts.isStreaming:
        raise ValueError(f"{words.size.rows} words: score a stream by streaming.sentiment.write_sentiment")
    else:
        scored = _with_hit_score(posts, words, id_col, text_col)
    return scored.withColumn("sentiment", sentiment_label(F.col("score")))


def sentiment_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("sentiment").agg(F.count(F.lit(1)).alias("posts"))


def labelled_text(
    posts: DataFrame, weights: DataFrame, id_col: str = "post_id", text_col: str = "text"
) -> DataFrame:
    """``(id, text, label)``: the cleaned text beside the numeric label of the raw text."""
    scored = lexicon_sentiment(posts.select(id_col, text_col), weights, id_col, text_col)
    return scored.select(
        id_col,
        only_words(F.col(text_col)).alias("text"),
        F.col("sentiment").cast("double").alias("label"),
    )


def remove_stop_words(
    tokens: DataFrame, words: DataFrame, id_col: str, key: str = "word"
) -> DataFrame:
    """Token rows whose word is not listed, whatever its case."""
    listed = words.select(F.lower(key).alias("_listed")).distinct()
    keyed = tokens.withColumn("_listed", F.lower(key))
    return word_join(keyed, listed, id_col, "left_anti", "_listed").drop("_listed")
