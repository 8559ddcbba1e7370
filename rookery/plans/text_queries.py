"""Tokens, cleaning, word counts, sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.functions.text import hashtag_string, only_words, utf16_length
from rookery.operators import sentiment, sinks, tokens
from rookery.plans import inputs
from rookery.plans.registry import query
from rookery.session import scratch_dir
from rookery.sources.lexicon import read_lexicon, word_weights
from rookery.sources.lines import read_lines
from rookery.sources.tables import table
from rookery.streaming.batches import drain
from rookery.streaming.sentiment import write_sentiment

_WORDS_SQL = """
words AS (
  SELECT lower(t) AS word, count(*) AS count
  FROM (SELECT unnest(string_split(line, ' ')) AS t
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
  WHERE length(t) > 4 GROUP BY 1)"""


@query(
    "tokens",
    """SELECT doc_id, unnest(string_split(rtrim(text, ' '), ' ')) AS token
       FROM documents WHERE text = '' OR rtrim(text, ' ') <> ''""",
)
def _(spark, sf_dir):
    return tokens.explode_tokens(inputs.documents(spark, sf_dir).select("doc_id", "text"))


@query("word_count", f"WITH {_WORDS_SQL} SELECT word, count FROM words")
def word_count(spark, sf_dir):
    return tokens.word_count(inputs.text_lines(spark, sf_dir))


@query("top_words", f"WITH {_WORDS_SQL} SELECT word, count FROM words ORDER BY 2 DESC, 1 LIMIT 10")
def _(spark, sf_dir):
    return tokens.top_words(inputs.text_lines(spark, sf_dir), 10)


@query(
    "top_words_by_key",
    f"WITH {_WORDS_SQL} SELECT word, count FROM words ORDER BY 1 DESC, 2 DESC LIMIT 20",
)
def _(spark, sf_dir):
    return tokens.last_words(inputs.text_lines(spark, sf_dir), 20)


@query(
    "pairs_as_text",
    f"WITH {_WORDS_SQL} SELECT '(' || word || ',' || count || ')' AS value FROM words",
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "pairs")
    sinks.write_pairs_text(tokens.word_count(inputs.text_lines(spark, sf_dir)), path)
    return read_lines(spark, path)


@query(
    "hashtag_rows",
    f"""WITH {inputs.POST_TEXTS_SQL}
        SELECT post_id, tag FROM
          (SELECT post_id, unnest(string_split(text, ' ')) AS tag FROM post_texts)
        WHERE starts_with(tag, '#')""",
)
def _(spark, sf_dir):
    return tokens.hashtags(inputs.post_texts(spark, sf_dir).select("post_id", "text"))


@query(
    "hashtag_string",
    f"""WITH {inputs.POST_TEXTS_SQL}
        SELECT post_id,
               array_to_string(list_filter(string_split(text, ' '),
                                           lambda t: starts_with(t, '#')), ' ') AS tags
        FROM post_texts""",
)
def _(spark, sf_dir):
    texts = inputs.post_texts(spark, sf_dir)
    return texts.select("post_id", hashtag_string(F.col("text")).alias("tags"))


_ONLY_WORDS_SQL = """array_to_string(list_filter(string_split(text, ' '),
                     lambda t: regexp_full_match(t, '[a-zA-Z0-9]+')), ' ')"""


@query("only_words", f"SELECT doc_id, {_ONLY_WORDS_SQL} AS words FROM documents")
def _(spark, sf_dir):
    documents = inputs.documents(spark, sf_dir)
    return documents.select("doc_id", only_words(F.col("text")).alias("words"))


@query("text_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def _(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", utf16_length(F.col("text")).alias("n"))


@query(
    "lexicon_load",
    """SELECT word, CAST(sum(n) AS BIGINT) AS weight FROM (
         SELECT unnest(string_split_regex(lower(text), '\\s+')) AS word,
                CASE role WHEN 'user' THEN 1 ELSE -1 END AS n
         FROM conversations WHERE role IN ('user', 'assistant'))
       WHERE word <> '' GROUP BY word HAVING sum(n) <> 0""",
)
def _(spark, sf_dir):
    lists = []
    for role in ("user", "assistant"):
        path = scratch_dir(spark, f"words-{role}")
        sinks.write_lines(inputs.turn_words(spark, sf_dir, role), path)
        lists.append(read_lexicon(spark, path))
    return word_weights(*lists)


def _scores_sql(weights: str) -> str:
    return f"""{inputs.POST_TEXTS_SQL}, {weights},
hits AS (
  SELECT post_id, sum(weight) AS score
  FROM (SELECT post_id, unnest(string_split(lower(text), ' ')) AS word FROM post_texts)
  JOIN weights USING (word) GROUP BY post_id),
scored AS (
  SELECT post_id, text, CAST(coalesce(score, 0) AS BIGINT) AS score,
         CASE WHEN score > 0 THEN '1' WHEN score < 0 THEN '0' ELSE '2' END AS sentiment
  FROM post_texts LEFT JOIN hits USING (post_id))"""


_SHORT_SQL = _scores_sql(inputs.SHORT_WEIGHTS_SQL)


@query("lexicon_sentiment", f"WITH {_SHORT_SQL} SELECT post_id, score, sentiment FROM scored")
def _(spark, sf_dir):
    texts = inputs.post_texts(spark, sf_dir).select("post_id", "text")
    return sentiment.lexicon_sentiment(texts, inputs.short_weights(spark)).drop("text")


@query(
    "lexicon_sentiment_label_counts",
    f"WITH {_SHORT_SQL} SELECT sentiment, count(*) AS posts FROM scored GROUP BY sentiment",
)
def _(spark, sf_dir):
    texts = inputs.post_texts(spark, sf_dir).select("post_id", "text")
    return sentiment.sentiment_counts(
        sentiment.lexicon_sentiment(texts, inputs.short_weights(spark))
    )


@query(
    "stream_lexicon_sentiment",
    f"""WITH {_scores_sql(inputs.LONG_WEIGHTS_SQL)}
        SELECT post_id, score, sentiment FROM scored""",
)
def _(spark, sf_dir):
    """Scores of a stream of posts against the long lists."""
    base = scratch_dir(spark, "sentiment")
    stream, weights = inputs.post_text_stream(spark, sf_dir), inputs.long_weights(spark, sf_dir)
    drain(write_sentiment(stream, weights, f"{base}/out", "batch", f"{base}/c", keep=["post_id"]))
    return spark.read.parquet(f"{base}/out/batch_*")


@query(
    "lexicon_sentiment_long_lists",
    f"""WITH {_scores_sql(inputs.LONG_WEIGHTS_SQL)}
        SELECT post_id, score, sentiment FROM scored""",
)
def _(spark, sf_dir):
    texts = inputs.post_texts(spark, sf_dir).select("post_id", "text")
    return sentiment.lexicon_sentiment(texts, inputs.long_weights(spark, sf_dir)).drop("text")


LABELLED_TEXT_SQL = f"""{_SHORT_SQL},
labelled AS (
  SELECT post_id, {_ONLY_WORDS_SQL} AS text, CAST(sentiment AS DOUBLE) AS label FROM scored)"""


@query(
    "labelled_text",
    f"WITH {LABELLED_TEXT_SQL} SELECT post_id, text, label FROM labelled",
)
def _(spark, sf_dir):
    return sentiment.labelled_text(inputs.post_texts(spark, sf_dir), inputs.short_weights(spark))


_STOP_SQL = ", ".join(f"'{w}'" for w in inputs.STOP_WORDS)


@query(
    "stop_words_anti",
    f"""SELECT doc_id, count(*) AS kept, array_to_string(list_sort(list(word)), ' ') AS kept_words
        FROM (SELECT doc_id, unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents
              WHERE text = '' OR rtrim(text, ' ') <> '')
        WHERE lower(word) NOT IN ({_STOP_SQL}) GROUP BY doc_id""",
)
def _(spark, sf_dir):
    words = tokens.explode_tokens(
        inputs.documents(spark, sf_dir).select("doc_id", "text"), out="word"
    )
    kept = sentiment.remove_stop_words(words, inputs.word_list(spark, inputs.STOP_WORDS), "doc_id")
    listed = F.array_join(F.sort_array(F.collect_list("word")), " ")
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept"), listed.alias("kept_words"))
