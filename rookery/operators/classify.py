"""Text classification: split, features, Naive Bayes or logistic regression, evaluation, tuning."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

# Split share and seed, feature count, tuning grid and folds.
TRAIN_PERCENT = 60
SEED = 12345
NUM_FEATURES = 20_000
MIN_DOC_FREQ = 0
GRID_FEATURES = [1_000, 10_000, 100_000]
GRID_DOC_FREQ = [0, 10, 100]
FOLDS = 2


def hash_bucket(id_col: str, seed: int, buckets: int) -> Column:
    """A bucket that depends only on the id and the seed, so it survives any repartitioning."""
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def in_train(id_col: str, percent: int = TRAIN_PERCENT, seed: int = SEED) -> Column:
    return hash_bucket(id_col, seed, 100) < percent


def split_train_test(
    df: DataFrame, id_col: str, percent: int = TRAIN_PERCENT, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    train = in_train(id_col, percent, seed)
    return df.filter(train), df.filter(~train)


def _word_stages(text_col: str, stop_words: Sequence[str] | None) -> list:
    remover = StopWordsRemover(inputCol="words", outputCol="filtered", caseSensitive=False)
    if stop_words is not None:
        remover.setStopWords(list(stop_words))
    return [Tokenizer(inputCol=text_col, outputCol="words"), remover]


def ml_words(
    df: DataFrame, text_col: str = "text", stop_words: Sequence[str] | None = None
) -> DataFrame:
    """Adds ``words`` (lower-cased, split on whitespace) and ``filtered`` (without stop words)."""
    for stage in _word_stages(text_col, stop_words):
        df = stage.transform(df)
    return df


def hashed_counts(df: DataFrame, num_features: int = NUM_FEATURES) -> DataFrame:
    """Adds ``rawFeatures``: hashed term frequencies of ``filtered``."""
    return HashingTF(
        inputCol="filtered", outputCol="rawFeatures", numFeatures=num_features
    ).transform(df)


def weigh_counts(df: DataFrame, min_doc_freq: int = MIN_DOC_FREQ) -> DataFrame:
    """Adds ``features``: the hashed counts times the inverse document frequency."""
    idf = IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=min_doc_freq)
    return idf.fit(df).transform(df)


def term_idf(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """``(term, df, idf)`` of every unhashed term, with ``idf = ln((N + 1) / (df + 1))``."""
    words = Tokenizer(inputCol="_t", outputCol="words").transform(
        df.select(id_col, F.col(text_col).alias("_t"))
    )
    # Distinct inside each text, so the count needs no distinct over the whole table.
    terms = words.select(F.explode(F.array_distinct("words")).alias("term"))
    doc_freq = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = df.agg(F.count(F.lit(1)).alias("n_docs")).first()["n_docs"]
    return doc_freq.select(
        "term", "df", F.log((F.lit(total) + 1) / (F.col("df") + 1)).alias("idf")
    )


def sentiment_stages(
    num_features: int = NUM_FEATURES,
    min_doc_freq: int = MIN_DOC_FREQ,
    classifier=None,
    text_col: str = "text",
    stop_words: Sequence[str] | None = None,
) -> list:
    """Tokenise, drop stop words, hash, weigh, classify."""
    return [
        *_word_stages(text_col, stop_words),
        HashingTF(inputCol="filtered", outputCol="rawFeatures", numFeatures=num_features),
        IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=min_doc_freq),
        classifier or NaiveBayes(),
    ]


def fit_sentiment(train: DataFrame, **options) -> PipelineModel:
    """Fit on columns ``text`` and ``label``.

    Words are made and hashed once: the document frequencies and the classifier read the kept counts,
    however often they pass over them. The model holds all five stages.
    """
    tokenizer, remover, hashing, idf, classifier = sentiment_stages(**options)
    counts = train
    for stage in (tokenizer, remover, hashing):
        counts = stage.transform(counts)
    counts = counts.select("label", "rawFeatures").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = Pipeline(stages=[idf, classifier]).fit(counts)
    finally:
        counts.unpersist()
    return PipelineModel([tokenizer, remover, hashing, *fitted.stages])


def fit_logistic(
    train: DataFrame, iterations: int = 100, penalty: float = 0.0, tolerance: float = 1e-6, **options
) -> PipelineModel:
    """The same features under logistic regression of at most so many steps.

    With a ``penalty`` on the squared weights of the scaled features there is one best fit, whatever
    the steps towards it; without one, classes that can be told apart have none.
    """
    classifier = LogisticRegression(maxIter=iterations, regParam=penalty, tol=tolerance)
    return fit_sentiment(train, classifier=classifier, **options)


def score(model: PipelineModel, test: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return model.transform(test).select(*keep, "text", "probability", "label", "prediction")


def evaluate(predictions: DataFrame, metric: str = "f1") -> float:
    return MulticlassClassificationEvaluator(metricName=metric).evaluate(predictions)


def area_under_roc(predictions: DataFrame) -> float:
    return BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(predictions)


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def metrics(predictions: DataFrame) -> DataFrame:
    """Accuracy, weighted precision, weighted recall and F1, from the confusion matrix.

    One pass over the predictions; everything after it is a handful of rows.
    """
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")

    def part(of, actual, hit, guessed):
        return F.struct(
            F.col(of).alias("class"), actual.alias("actual"), hit.alias("hit"),
            guessed.alias("guessed"),
        )

    # A cell counts for the class it is in and for the class it was taken for.
    n = F.col("n")
    parts = F.array(part("label", n, right, none), part("prediction", none, none, n))
    joined = confusion_matrix(predictions).select(F.inline(parts)).groupBy("class").agg(
        F.sum("actual").alias("actual"), F.sum("hit").alias("hit"), F.sum("guessed").alias("guessed")
    )
    actual, hit, guessed = (F.col(c).cast("double") for c in ("actual", "hit", "guessed"))
    precision = F.when(guessed > 0, hit / F.nullif(guessed, F.lit(0.0))).otherwise(0.0)
    recall = F.when(actual > 0, hit / F.nullif(actual, F.lit(0.0))).otherwise(0.0)
    f1 = F.when(hit > 0, 2 * hit / (actual + guessed)).otherwise(0.0)
    total = F.sum("actual")
    return joined.agg(
        F.sum("actual").alias("n"),
        (F.sum("hit") / total).alias("accuracy"),
        (F.sum(precision * actual) / total).alias("weighted_precision"),
        (F.sum(recall * actual) / total).alias("weighted_recall"),
        (F.sum(f1 * actual) / total).alias("f1"),
    )


@dataclass
class Tuned:
    """The best model of a grid search, its settings and the scores around it."""

    model: PipelineModel
    num_features: int
    min_doc_freq: int
    base_metric: float
    tuned_metric: float
    grid: list[tuple[int, int, float]]

    @property
    def improvement_pct(self) -> float:
        if self.base_metric == 0:
            return 0.0
        return (self.tuned_metric - self.base_metric) * 100 / self.base_metric


def tune(
    train: DataFrame,
    test: DataFrame,
    id_col: str,
    features: Sequence[int] = tuple(GRID_FEATURES),
    doc_freqs: Sequence[int] = tuple(GRID_DOC_FREQ),
    folds: int = FOLDS,
    metric: str = "f1",
    parallelism: int = 4,
) -> Tuned:
    """Grid search with cross-validation, compared with the untuned model on ``test``.

    Words do not depend on the grid, so they are made once and kept for all fits. They are hashed once
    for each number of features: folds, document frequencies and classifiers read the kept counts.
    Folds come from the id hash, which makes the search repeatable.
    """
    words = ml_words(train).select(
        "filtered", "label", hash_bucket(id_col, SEED + 1, folds).alias("fold")
    )
    words = words.persist(StorageLevel.MEMORY_AND_DISK)
    test_words = ml_words(test).select("filtered", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        evaluator = MulticlassClassificationEvaluator(metricName=metric)
        idf = IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=MIN_DOC_FREQ)
        stages = Pipeline(stages=[idf, NaiveBayes()])
        scores, best, model = [], None, None
        for size in features:
            with _kept_counts(words, size) as counts:
                search = CrossValidator(
                    estimator=stages,
                    estimatorParamMaps=ParamGridBuilder().addGrid(idf.minDocFreq, list(doc_freqs)).build(),
                    evaluator=evaluator,
                    numFolds=folds,
                    foldCol="fold",
                    parallelism=parallelism,
                ).fit(counts)
            own = [(size, doc_freq, float(value)) for doc_freq, value in zip(doc_freqs, search.avgMetrics)]
            scores += own
            first = max(own, key=lambda s: s[2])
            if best is None or first[2] > best[2]:
                hashing = HashingTF(inputCol="filtered", outputCol="rawFeatures", numFeatures=size)
                best, model = first, PipelineModel([hashing, *search.bestModel.stages])
        with _kept_counts(words, NUM_FEATURES) as counts:
            fitted = stages.fit(counts)
        base = evaluator.evaluate(fitted.transform(hashed_counts(test_words)))
        tuned = evaluator.evaluate(model.transform(test_words))
        return Tuned(model, best[0], best[1], base, tuned, scores)
    finally:
        words.unpersist()
        test_words.unpersist()


@contextmanager
def _kept_counts(words: DataFrame, num_features: int) -> Iterator[DataFrame]:
    """Hashed counts of ``filtered`` words in place of them, kept while fits pass over them."""
    counts = hashed_counts(words, num_features).drop("filtered").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield counts
    finally:
        counts.unpersist()
