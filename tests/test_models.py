import math

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.mllib.clustering import StreamingKMeansModel
from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD
from pyspark.sql import functions as F

from rookery.operators import classify, clusters, regression
from rookery.operators.clusters import Centres
from rookery.operators.regression import LinearState
from rookery.plans import inputs
from rookery.session import scratch_dir
from rookery.streaming.batches import BatchWriter, drain, write_batches


def points(spark, rows):
    return spark.createDataFrame([([float(x) for x in r],) for r in rows], "features array<double>")


def random_points(seed, n=200, d=2):
    return np.random.default_rng(seed).normal(size=(n, d)).tolist()


@pytest.mark.parametrize("decay, unit", [(1.0, "batches"), (0.5, "batches"), (0.99, "points")])
def test_kmeans_steps_match_mllib(spark, decay, unit):
    start = np.random.default_rng(3).normal(size=(5, 2)).tolist()
    ours = Centres.of(start)
    theirs = StreamingKMeansModel(start, [0.0] * 5)
    for seed in range(3):
        batch = random_points(seed)
        ours = clusters.kmeans_update(ours, points(spark, batch), decay, unit)
        theirs = theirs.update(spark.sparkContext.parallelize(batch), decay, unit)
        np.testing.assert_allclose(ours.centres, [list(c) for c in theirs.centers], rtol=1e-9)
        np.testing.assert_allclose(ours.weights, list(theirs.clusterWeights), rtol=1e-9)


def test_an_empty_cluster_is_placed_beside_the_heaviest(spark):
    start = Centres.of([[0.0, 0.0], [100.0, 100.0]])
    ours = clusters.kmeans_update(start, points(spark, [[1, 1], [3, 3]]))
    theirs = StreamingKMeansModel([list(c) for c in start.centres], [0.0, 0.0]).update(
        spark.sparkContext.parallelize([[1.0, 1.0], [3.0, 3.0]]), 1.0, "batches"
    )
    assert ours.weights == (1.0, 1.0) == tuple(theirs.clusterWeights)
    np.testing.assert_array_equal(ours.centres, [list(c) for c in theirs.centers])
    assert ours.centres[0] != ours.centres[1]


def test_an_empty_batch_only_discounts(spark):
    start = Centres.of([[0.0], [5.0]], [4.0, 2.0])
    after = clusters.kmeans_update(start, points(spark, []), decay=0.5)
    assert (after.centres, after.weights) == (start.centres, (2.0, 1.0))


@pytest.mark.parametrize("d", [2, 70])
def test_cluster_sums_in_few_and_many_dimensions(spark, d):
    batch = random_points(1, 50, d)
    start = Centres.of(random_points(2, 3, d))
    sums = {r.cluster: (r.n, list(r.sums)) for r in clusters.cluster_sums(points(spark, batch), start).collect()}
    nearest = [
        int(np.argmin([np.sum((np.array(p) - np.array(c)) ** 2) for c in start.centres])) for p in batch
    ]
    for j, (n, total) in sums.items():
        mine = [p for p, k in zip(batch, nearest) if k == j]
        assert n == len(mine)
        np.testing.assert_allclose(total, np.sum(mine, axis=0), rtol=1e-9)
    assert sum(n for n, _ in sums.values()) == 50


def test_distance_ties_go_to_the_lowest_cluster(spark):
    state = Centres.of([[0.0], [2.0], [0.0]])
    got = clusters.kmeans_predict(state, points(spark, [[1], [0], [9]])).collect()
    assert [r.cluster for r in got] == [0, 0, 1]


def test_centres_round_trip(spark):
    path = scratch_dir(spark, "centres")
    state = Centres.of([[1.5, -2.0], [0.1, 1e-14]], [3.0, 0.0])
    clusters.save_centres(state, spark, path)
    assert clusters.load_centres(spark, path) == state


def labelled(spark, rows):
    return spark.createDataFrame(
        [(float(y), [float(v) for v in x]) for y, x in rows], "label double, features array<double>"
    )


@pytest.mark.parametrize("d", [1, 3])
def test_regression_steps_match_mllib(spark, d):
    rng = np.random.default_rng(5)
    ours = LinearState.zeros(d)
    for _ in range(2):
        x = rng.uniform(-1, 1, size=(100, d))
        y = x @ np.arange(1, d + 1) + 0.3
        rows = list(zip(y.tolist(), x.tolist()))
        theirs = LinearRegressionWithSGD.train(
            spark.sparkContext.parallelize([LabeledPoint(a, b) for a, b in rows]),
            iterations=50, step=0.1, initialWeights=list(ours.weights), intercept=True,
            regType=None, convergenceTol=0.001,
        )
        ours = regression.linreg_update(ours, labelled(spark, rows))
        np.testing.assert_allclose(ours.weights, theirs.weights.toArray(), rtol=1e-7)
        assert math.isclose(ours.intercept, theirs.intercept, rel_tol=1e-7)


def test_an_empty_batch_leaves_the_weights(spark):
    state = LinearState((0.5,), 0.25)
    assert regression.linreg_update(state, labelled(spark, [])) == state


def test_carried_intercept(spark):
    batch = labelled(spark, [(1, [0]), (1, [0])])
    fresh = regression.linreg_update(LinearState((0.0,), 0.0), batch)
    carried = regression.linreg_update(LinearState((0.0,), 0.0), batch, carry_intercept=True)
    assert fresh.intercept == 1.0 and 0.5 < carried.intercept < 1.0


def test_linreg_predict(spark):
    got = regression.linreg_predict(LinearState((2.0,), 1.0), labelled(spark, [(5, [3])])).first()
    assert (got.label, got.prediction) == (5.0, 7.0)


def test_scaling_and_back(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (8.0, 7.0)], "a double, b double")
    scaling = regression.fit_scaling(df, ["a", "b"])
    scaled = regression.scale(df, scaling)
    rows = scaled.collect()
    assert [r.a for r in rows] == [-0.75, -0.25, 1.0] and [r.b for r in rows] == [0.0] * 3
    assert [tuple(r) for r in regression.unscale(scaled, scaling).collect()] == [
        (1.0, 7.0), (3.0, 7.0), (8.0, 7.0),
    ]


def test_split_does_not_depend_on_partitions(spark):
    ids = spark.range(1000).withColumnRenamed("id", "doc_id")
    train, test = classify.split_train_test(ids, "doc_id")
    again, _ = classify.split_train_test(ids.repartition(7), "doc_id")
    kept = {r.doc_id for r in train.collect()}
    assert kept == {r.doc_id for r in again.collect()}
    assert len(kept) == 578 and test.count() == 422


def test_tokenizer_keeps_empty_words_and_drops_listed_ones(spark):
    df = spark.createDataFrame([("The  Big\ndog",)], "text string")
    row = classify.ml_words(df).first()
    assert row.words == ["the", "", "big", "dog"] and row.filtered == ["", "big", "dog"]
    assert classify.ml_words(df, stop_words=["dog"]).first().filtered == ["the", "", "big"]


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    train, test = classify.split_train_test(inputs.labelled_documents(spark, sf_dir), "doc_id")
    return classify.score(classify.fit_sentiment(train), test).cache()


def test_metrics_match_the_evaluator(scored):
    got = classify.metrics(scored).first()
    assert got.n == scored.count()
    for name, theirs in {
        "accuracy": "accuracy", "f1": "f1", "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
    }.items():
        value = MulticlassClassificationEvaluator(metricName=theirs).evaluate(scored)
        assert math.isclose(got[name], value, rel_tol=1e-9), name
    assert math.isclose(classify.evaluate(scored), got.f1, rel_tol=1e-9)


def test_probabilities_add_up(scored):
    assert all(math.isclose(sum(r.probability), 1.0, rel_tol=1e-9) for r in scored.collect())


def test_logistic_regression_and_roc(spark, sf_dir):
    train, test = classify.split_train_test(inputs.labelled_documents(spark, sf_dir), "doc_id")
    model = classify.fit_logistic(train)
    assert 0.0 <= classify.area_under_roc(model.transform(test)) <= 1.0


def test_penalised_logistic_regression_has_no_slope_left(spark, sf_dir):
    """At the fitted weights the gradient of mean log-loss and penalty is next to nothing."""
    train, _ = classify.split_train_test(inputs.labelled_documents(spark, sf_dir), "doc_id")
    model = classify.fit_logistic(train, iterations=500, penalty=1.0, tolerance=1e-12)
    rows = model.transform(train).select("features", "label", "probability").collect()
    x = np.array([r.features.toArray() for r in rows])
    gap = np.array([r.probability[1] - r.label for r in rows])
    weights, spread = model.stages[-1].coefficients.toArray(), x.std(0, ddof=1)
    slope = x.T @ gap / len(rows) + 1.0 * weights * spread**2
    assert np.abs(slope[spread > 0] / spread[spread > 0]).max() < 1e-6
    assert abs(gap.mean()) < 1e-6 and np.abs(weights).max() > 0


def test_tuning_picks_the_best_setting(spark, sf_dir):
    train, test = classify.split_train_test(inputs.labelled_documents(spark, sf_dir), "doc_id")
    tuned = classify.tune(train, test, "doc_id", features=[100, 1000], doc_freqs=[0, 5])
    assert len(tuned.grid) == 4
    best = max(m for _, _, m in tuned.grid)
    assert (tuned.num_features, tuned.min_doc_freq, best) in tuned.grid
    assert math.isclose(
        tuned.improvement_pct, (tuned.tuned_metric - tuned.base_metric) * 100 / tuned.base_metric
    )


def test_tuning_hashes_words_once_for_each_number_of_features(spark, sf_dir, monkeypatch):
    """Fits read kept counts, and the best model still takes words."""
    train, test = classify.split_train_test(inputs.labelled_documents(spark, sf_dir), "doc_id")
    seen, made = [], classify.CrossValidator

    class Seen(made):
        def _fit(self, dataset):
            seen.append((sorted(dataset.columns), dataset.storageLevel.useMemory))
            return super()._fit(dataset)

    monkeypatch.setattr(classify, "CrossValidator", Seen)
    tuned = classify.tune(train, test, "doc_id", features=[100, 1000], doc_freqs=[0, 5])
    assert seen == [(["fold", "label", "rawFeatures"], True)] * 2
    again = classify.evaluate(tuned.model.transform(classify.ml_words(test)))
    assert again == tuned.tuned_metric


def test_post_clusters(spark):
    texts = ["aaaa aaaa", "aaa aaaaa", "zzzz zzzz", "zz zzzzzz"] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    model = clusters.cluster_posts(df, k=2, iterations=5)
    assigned = clusters.assign_clusters(model, df)
    groups = {}
    for r in assigned.collect():
        groups.setdefault(r.text[0], set()).add(r.cluster)
    assert len(groups["a"]) == len(groups["z"]) == 1 and groups["a"] != groups["z"]
    assert sorted(r.posts for r in clusters.cluster_sizes(assigned).collect()) == [10, 10]
    examples = clusters.cluster_examples(model, df, "id", sample=4).collect()
    assert sorted(r.id for r in examples) == [0, 1, 2, 3]
    assert [r.cluster for r in examples] == sorted(r.cluster for r in examples)
    chosen = min(groups["a"])
    assert clusters.cluster_filter(model, df, chosen).filter(F.col("text").startswith("z")).count() == 0
    assert len(clusters.Centres.from_model(model).centres) == 2

    base = scratch_dir(spark, "cluster-filter")
    df.write.parquet(f"{base}/in")
    landed = spark.readStream.schema(df.schema).parquet(f"{base}/in")
    stream = clusters.cluster_filter(model, landed, chosen)
    drain(write_batches(stream, BatchWriter(f"{base}/out", "b", "parquet"), f"{base}/checkpoint"))
    assert {r.text[0] for r in spark.read.parquet(f"{base}/out/b_*").collect()} == {"a"}


def vectors_of(df):
    rows = clusters.featurize(df).select("id", "features").collect()
    return {r.id: r.features.toArray() for r in rows}


def lloyd(points, centres, steps):
    """Steps by hand; ties go to the lowest centre, empty clusters stay where they are."""
    centres = [np.array(c) for c in centres]
    for _ in range(steps):
        place = {i: int(np.argmin([((x - c) ** 2).sum() for c in centres])) for i, x in points.items()}
        own = [[points[i] for i in points if place[i] == j] for j in range(len(centres))]
        centres = [np.mean(x, 0) if x else c for x, c in zip(own, centres)]
    return centres, {i: int(np.argmin([((x - c) ** 2).sum() for c in centres])) for i, x in points.items()}


@pytest.fixture(scope="module")
def prose(spark):
    rng = np.random.default_rng(8)
    words = [["sun", "sunny", "sand"], ["rain", "grey", "drain"], ["code", "node", "mode"]]
    texts = [" ".join(rng.choice(words[i % 3], rng.integers(1, 12))) for i in range(90)]
    texts += ["", "x", texts[0], texts[0]]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")


def test_text_centres_are_those_of_steps_by_hand(spark, prose):
    points = vectors_of(prose)
    start = clusters.fit_text_centres(prose, 3, 0, seed=4, id_col="id")
    # Starts are three different texts.
    assert all(any((np.array(c) == x).all() for x in points.values()) for c in start.centres)
    assert len(set(start.centres)) == 3
    for steps in (1, 4):
        got = clusters.fit_text_centres(prose, 3, steps, seed=4, id_col="id")
        centres, place = lloyd(points, start.centres, steps)
        np.testing.assert_allclose(got.centres, centres, rtol=1e-12)
        placed = clusters.assign_clusters(got, prose).collect()
        assert {r.id: r.cluster for r in placed} == place


def test_text_centres_are_a_fixed_point_that_costs_less_than_the_start(spark, prose):
    """Each text is nearest to its own centre, each centre the mean of its texts."""
    points = vectors_of(prose)
    cost = lambda centres: sum(min(((x - np.array(c)) ** 2).sum() for c in centres) for x in points.values())
    start, got = (clusters.fit_text_centres(prose, 3, n, seed=4, id_col="id") for n in (0, 50))
    again, _ = lloyd(points, got.centres, 1)
    np.testing.assert_allclose(again, got.centres, rtol=1e-12)
    assert cost(got.centres) < cost(start.centres)
    sizes = clusters.cluster_sizes(clusters.assign_clusters(got, prose)).collect()
    assert {r.cluster: float(r.posts) for r in sizes} == dict(enumerate(got.weights))


def test_text_centres_do_not_depend_on_partitions_and_go_through_a_table(spark, prose):
    one = clusters.fit_text_centres(prose.coalesce(1), 4, 5, id_col="id")
    many = clusters.fit_text_centres(prose.repartition(7, "text"), 4, 5, id_col="id")
    assert one == many
    path = scratch_dir(spark, "text-centres")
    clusters.save_centres(one, spark, path)
    assert clusters.load_centres(spark, path) == one
    assert clusters.fit_text_centres(prose, 4, 5, seed=2, id_col="id") != one


def test_fewer_different_texts_than_centres(spark):
    rows = [(1, "aa"), (2, "aa"), (3, "bb"), (4, None), (None, "cc")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = clusters.fit_text_centres(df, 5, 3, id_col="id")
    assert sorted(got.weights) == [1.0, 2.0]
    assert clusters.assign_clusters(got, df.filter("text is not null")).count() == 4


def test_features_count_pairs(spark):
    df = spark.createDataFrame([("abab",), ("x",), ("",)], "text string")
    vectors = [r.features for r in clusters.featurize(df).collect()]
    assert [sum(v.values) for v in vectors] == [3.0, 1.0, 0.0]
    assert sorted(vectors[0].values) == [1.0, 2.0]


@pytest.mark.parametrize("dims", [1000, 7, 1 << 20])
def test_terms_are_the_features_of_any_text(spark, dims):
    texts = ["abab", "x", "", "é", "Été çà œuvre", "\U0001f600\U0001f600a", "a\nb\r\n\t ", "ÀÉ" * 3000, "的一是不了", "\0\0a", "İI"]
    df = spark.createDataFrame([(t,) for t in [*texts, *texts[::-1], "z" * 70_000]], "text string").coalesce(1)
    both = clusters.featurize(df, num_features=dims).withColumn("terms", clusters.text_terms(F.col("text"), dims))
    for r in both.collect():
        terms = np.frombuffer(r.terms, "<i4").reshape(-1, 2)
        assert terms[:, 0].tolist() == r.features.indices.tolist() and terms[:, 1].tolist() == r.features.values.tolist()
    none = spark.createDataFrame([(None,), ("a",)], "text string").select(clusters.text_terms(F.col("text")).alias("t"))
    assert [r.t is None for r in none.collect()] == [True, False]


def test_features_are_made_once_and_kept_small(spark, prose):
    """A step reads kept binary terms: no text, no pairs of strings, no vectors."""
    seen = []
    moved = clusters._moved_centres

    def looked(points, state):
        seen.append((dict(points.dtypes), points.storageLevel.useMemory))
        return moved(points, state)

    clusters._moved_centres = looked
    try:
        clusters.fit_text_centres(prose, 3, 1, id_col="id")
    finally:
        clusters._moved_centres = moved
    assert seen == [({"id": "bigint", "_terms": "binary"}, True)]


@pytest.mark.parametrize("dims", [2, 70, 300])
def test_unreadable_features_are_no_points(spark, dims):
    whole = [[float(i)] * dims for i in (10, 12)]
    bad = [None, [], [1.0], [1.0] * (dims + 1), [None] * dims, [float("nan")] * dims]
    schema = "label double, features array<double>"
    points = lambda rows: spark.createDataFrame([(1.0, r) for r in rows], schema)
    start = clusters.Centres.of([[10.0] * dims], [1.0])
    clean = clusters.kmeans_update(start, points(whole))
    assert clusters.kmeans_update(start, points(whole + bad)) == clean
    assert clusters.kmeans_update(start, points(bad)) == start
    assert clusters.unreadable_points(points(whole + bad), dims).count() == len(bad)
    placed = clusters.kmeans_predict(start, points(bad + whole)).collect()
    assert [r.cluster for r in placed] == [None] * len(bad) + [0, 0]


def test_unreadable_points_leave_the_line_alone(spark):
    schema = "label double, features array<double>"
    good = [(1.0, [2.0]), (3.0, [1.0])]
    bad = [(None, [1.0]), (1.0, None), (1.0, []), (1.0, [None]), (float("nan"), [1.0]), (1.0, [1.0, 2.0])]
    start = regression.LinearState.zeros()
    clean = regression.linreg_update(start, spark.createDataFrame(good, schema))
    assert regression.linreg_update(start, spark.createDataFrame(good + bad, schema)) == clean
    assert regression.linreg_update(start, spark.createDataFrame(bad, schema)) == start
    predicted = regression.linreg_predict(clean, spark.createDataFrame(bad[1:4], schema))
    assert all(r.prediction is None for r in predicted.collect())
