"""The SQL beside a query has to notice an operator that is broken on purpose."""

from contextlib import nullcontext

import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import connect, differences, duck_rows, spark_rows
from rookery.operators import classify, clusters, sentiment
from rookery.plans import stream_queries
from rookery.streaming import batches, trends
from rookery.streaming.batches import BatchWriter, write_batches


def _other_buckets(df, *_, **__):
    return HashingTF(inputCol="filtered", outputCol="rawFeatures", numFeatures=19_999).transform(df)


def _other_pairs(df, text_col="text", num_features=clusters.TEXT_FEATURES):
    pairs = clusters._pairs(df, text_col).withColumn("_pairs", F.transform("_pairs", F.reverse))
    return HashingTF(inputCol="_pairs", outputCol="features", numFeatures=num_features).transform(pairs)


def _other_words(tokens, words, id_col, key="word"):
    """As many rows as should stay, with another word in them."""
    kept = _remove_stop_words(tokens, words, id_col, key)
    return kept.withColumn(key, F.lit("other"))


def _other_filtered(df, text_col="text", stop_words=None):
    return _ml_words(df, text_col, stop_words).withColumn("filtered", F.reverse("filtered"))


def _no_budget(stream, base, prefix, checkpoint, budget, fmt):
    write_batches(stream, BatchWriter(base, prefix, fmt), checkpoint).awaitTermination()


def _other_penalty(train, **options):
    return _fit_logistic(train, **{**options, "penalty": 3.0})


_remove_stop_words, _ml_words = sentiment.remove_stop_words, classify.ml_words
_fit_logistic = classify.fit_logistic

BROKEN = {
    "ml_hashing_tf": (classify, "hashed_counts", _other_buckets),
    "text_features": (clusters, "featurize", _other_pairs),
    "stop_words_anti": (sentiment, "remove_stop_words", _other_words),
    "ml_stopwords": (classify, "ml_words", _other_filtered),
    "ml_stopwords_custom": (classify, "ml_words", _other_filtered),
    "stream_row_budget": (stream_queries, "run_until", _no_budget),
    "lr_predictions": (classify, "fit_logistic", _other_penalty),
    "kmeans_clusters": (clusters, "_moved_centres", lambda points, state: state),
    "stream_reuse": (batches, "kept", nullcontext),
    "stream_hashtag_window_chain": (trends, "hop_seconds", lambda window_s, slide_s: 100 * slide_s),
}


@pytest.mark.parametrize("name", list(BROKEN))
def test_a_broken_operator_is_noticed(spark, sf_dir, monkeypatch, name):
    if name == "stream_row_budget":
        sf_dir = "/root/testdata/sf0.01"  # the smallest table keeps to the budget
    monkeypatch.setattr(*BROKEN[name])
    got = spark_rows(entry.queries()[name](spark, sf_dir))
    assert differences(got, duck_rows(connect(sf_dir), entry.oracle_sql()[name]))
