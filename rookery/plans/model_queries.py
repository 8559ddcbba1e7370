"""Classification, clustering, regression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rookery.operators import classify, clusters, regression
from rookery.operators.rollups import split_summary
from rookery.operators.sentiment import labelled_text
from rookery.operators.sinks import write_lines
from rookery.plans import inputs
from rookery.plans.classify_sql import METRICS, hashed_terms, hashes, logistic, naive_bayes, text_clusters, weighted_terms
from rookery.plans.registry import query
from rookery.plans.text_queries import LABELLED_TEXT_SQL
from rookery.session import scratch_dir
from rookery.sources.lines import parse_labeled_points, parse_vectors, read_line_stream
from rookery.sources.tables import table
from rookery.streaming import online
from rookery.streaming.batches import drain
from rookery.streaming.classify import RESULT_SCHEMA, train_per_batch

_TRAIN_SQL = "CAST(('0x' || substr(md5(doc_id || '-12345'), 1, 8)) AS BIGINT) % 100 < 60"


@query("train_test_split", f"SELECT doc_id, {_TRAIN_SQL} AS train FROM documents")
def _(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", classify.in_train("doc_id").alias("train"))


@query(
    "split_summary",
    f"""SELECT total, train, total - train AS test,
               round(100.0 * train / total, 6) AS train_pct,
               round(100.0 * (total - train) / total, 6) AS test_pct
        FROM (SELECT count(*) AS total, count(*) FILTER (WHERE {_TRAIN_SQL}) AS train
              FROM documents)""",
)
def _(spark, sf_dir):
    summary = split_summary(table(spark, sf_dir, "documents"), classify.in_train("doc_id"))
    return summary.withColumns(
        {c: F.round(c, 6) for c in ("train_pct", "test_pct")}
    )


_ML_TOKENS = "string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s')"


@query(
    "ml_tokens",
    f"""SELECT doc_id, CAST(len({_ML_TOKENS}) AS INTEGER) AS n,
               array_to_string({_ML_TOKENS}, ' ') AS words
        FROM documents""",
)
def _(spark, sf_dir):
    documents = inputs.documents(spark, sf_dir).select("doc_id", "text")
    words = classify.ml_words(documents)
    joined = F.array_join("words", " ")
    return words.select("doc_id", F.size("words").alias("n"), joined.alias("words"))


def _default_stop_words() -> list[str] | None:
    """The English list that Spark holds; None without a session to ask."""
    if SparkSession.getActiveSession() is None:
        return None
    return StopWordsRemover.loadDefaultStopWords("english")


def _kept_sql(select: str, tables: str) -> Callable[[], str | None]:
    """SQL with the default stop words, which Spark itself holds."""

    def make() -> str | None:
        listed = _default_stop_words()
        if listed is None:
            return None
        words = ", ".join("'" + w.lower().replace("'", "''") + "'" for w in listed)
        kept = f"list_filter({_ML_TOKENS}, lambda w: w NOT IN ({words}))"
        return f"SELECT doc_id, {select.format(kept=kept)} FROM {tables}"

    return make


@query(
    "ml_stopwords",
    _kept_sql(
        f"""CAST(len({_ML_TOKENS}) AS INTEGER) AS words, CAST(len({{kept}}) AS INTEGER) AS kept,
            array_to_string({{kept}}, ' ') AS kept_words""",
        "documents",
    ),
)
def _(spark, sf_dir):
    documents = inputs.documents(spark, sf_dir).select("doc_id", "text")
    words = classify.ml_words(documents)
    return words.select(
        "doc_id",
        F.size("words").alias("words"),
        F.size("filtered").alias("kept"),
        F.array_join("filtered", " ").alias("kept_words"),
    )


_STOP_SQL = ", ".join(f"'{w}'" for w in inputs.STOP_WORDS)


@query(
    "ml_stopwords_custom",
    f"""SELECT doc_id, CAST(len(kept) AS INTEGER) AS kept, array_to_string(kept, ' ') AS kept_words FROM (
          SELECT doc_id, list_filter({_ML_TOKENS}, lambda w: w NOT IN ({_STOP_SQL})) AS kept FROM documents)""",
)
def _(spark, sf_dir):
    documents = inputs.documents(spark, sf_dir).select("doc_id", "text")
    words = classify.ml_words(documents, stop_words=inputs.STOP_WORDS)
    return words.select(
        "doc_id", F.size("filtered").alias("kept"), F.array_join("filtered", " ").alias("kept_words")
    )


# --- the classifier and its SQL --------------------------------------------------------------

_DOCS_SQL = f"""
docs AS (
  SELECT doc_id AS id, quality::DOUBLE AS label, text, {_TRAIN_SQL} AS train,
         CAST(('0x' || substr(md5(doc_id || '-12346'), 1, 8)) AS BIGINT) % 2 AS fold
  FROM documents JOIN labels USING (doc_id))"""
_BASE, _TEXT = classify.NUM_FEATURES, clusters.TEXT_FEATURES


def _hashed_sql(
    select: str, docs: str = _DOCS_SQL, chain: str = "", recursive: bool = False
) -> Callable[[], str | None]:
    """SQL over the hashed terms of ``docs``; the stop words come from Spark."""

    def make() -> str | None:
        listed, first = _default_stop_words(), "WITH RECURSIVE" if recursive else "WITH"
        return listed and f"{first} {docs}, {hashed_terms(listed)}{chain} {select}"

    return make


_BUCKETS = f""",
tf AS (SELECT id, ((h % {_BASE}) + {_BASE}) % {_BASE} AS bucket, count(*) AS n
       FROM words JOIN hashes USING (term) GROUP BY ALL),
idf AS (SELECT bucket, ln(((SELECT count(*) FROM docs) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY bucket)"""
_ONE_FIT = f""",
uses AS (SELECT 0 AS fit, id, train FROM docs), {naive_bayes(f"SELECT 0 AS fit, {_BASE} AS features, 0 AS min_df")},
{METRICS}"""
_SETTINGS = ", ".join(
    f"({i}, {f}, {d})"
    for i, (f, d) in enumerate((f, d) for f in classify.GRID_FEATURES for d in classify.GRID_DOC_FREQ)
)
# Fit 3i + 2 is setting i on all training rows, 3i and 3i + 1 leave one fold of them out; -1 is untuned.
_GRID_FITS = f""",
settings AS (SELECT * FROM (VALUES {_SETTINGS}) t(setting, features, min_df)),
uses AS (
  SELECT 3 * setting + r AS fit, id, CASE WHEN r = 2 THEN train ELSE fold <> r END AS train
  FROM docs, settings, range(3) p(r) WHERE train OR r = 2
  UNION ALL SELECT -1, id, train FROM docs),
{naive_bayes(f"""SELECT 3 * setting + r AS fit, features, min_df FROM settings, range(3) p(r)
                 UNION ALL SELECT -1, {_BASE}, 0""")},
{METRICS},
searched AS (
  SELECT setting, features, min_df, sum(f1) / 2 AS f1 FROM settings JOIN rated ON fit // 3 = setting AND fit % 3 < 2
  WHERE fit >= 0 GROUP BY ALL),
best_one AS (SELECT setting FROM searched ORDER BY round(f1, 9) DESC, setting LIMIT 1),
gain AS (SELECT (t.f1 - b.f1) * 100 / b.f1 AS pct FROM rated t, rated b, best_one
         WHERE t.fit = 3 * best_one.setting + 2 AND b.fit = -1)"""


def _hashed(spark, sf_dir):
    return classify.hashed_counts(classify.ml_words(inputs.labelled_documents(spark, sf_dir)))


def _values(vector: str) -> Column:
    """The stored values of a sparse vector."""
    return F.unwrap_udt(F.col(vector))["values"]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


@query(
    "ml_hashing_tf",
    _hashed_sql("SELECT id AS doc_id, bucket::INTEGER AS bucket, n::DOUBLE AS n FROM tf", chain=_BUCKETS),
)
def _(spark, sf_dir):
    """Per document and occupied bucket: its count."""
    return _buckets(_hashed(spark, sf_dir), "rawFeatures")


@query(
    "ml_idf",
    _hashed_sql(
        """SELECT id AS doc_id, count(bucket)::INTEGER AS buckets, round(coalesce(sum(n * idf), 0), 6) AS weight
           FROM docs LEFT JOIN tf USING (id) LEFT JOIN idf USING (bucket) GROUP BY id""",
        chain=_BUCKETS,
    ),
)
def _(spark, sf_dir):
    """Per document: occupied buckets and their summed weight."""
    values = _values("features")
    weighed = classify.weigh_counts(_hashed(spark, sf_dir))
    return weighed.select(
        "doc_id", F.size(values).alias("buckets"), F.round(_total(values), 6).alias("weight")
    )


@query(
    "term_idf",
    f"""SELECT term, count(*) AS df,
               round(ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1)), 6) AS idf
        FROM (SELECT DISTINCT doc_id, unnest({_ML_TOKENS}) AS term FROM documents) GROUP BY term""",
)
def _(spark, sf_dir):
    terms = classify.term_idf(inputs.documents(spark, sf_dir), "doc_id")
    return terms.withColumn("idf", F.round("idf", 6))


def _predictions(spark, sf_dir, fit=classify.fit_sentiment):
    train, test = classify.split_train_test(inputs.labelled_documents(spark, sf_dir), "doc_id")
    return classify.score(fit(train), test, keep=["doc_id"])


@query(
    "nb_predictions",
    _hashed_sql(
        "SELECT id AS doc_id, label, prediction, round(probability, 6) AS probability FROM guesses", chain=_ONE_FIT
    ),
)
def _(spark, sf_dir):
    return _predictions(spark, sf_dir).select(
        "doc_id",
        "label",
        "prediction",
        F.round(F.array_max(vector_to_array("probability")), 6).alias("probability"),
    )


_RATES = ("accuracy", "weighted_precision", "weighted_recall", "f1")


@query(
    "nb_metrics",
    _hashed_sql(f"SELECT n, {', '.join(f'round({c}, 6) AS {c}' for c in _RATES)} FROM rated", chain=_ONE_FIT),
)
def _(spark, sf_dir):
    rates = classify.metrics(_predictions(spark, sf_dir))
    return rates.withColumns({c: F.round(c, 6) for c in _RATES})


@query(
    "confusion_matrix",
    _hashed_sql("SELECT label, prediction, n FROM cells", chain=_ONE_FIT),
)
def _(spark, sf_dir):
    return classify.confusion_matrix(_predictions(spark, sf_dir))


@query(
    "nb_tuning",
    _hashed_sql(
        """SELECT features::INTEGER AS features, min_df::INTEGER AS min_doc_freq, round(f1, 6) AS f1,
                  setting = (SELECT setting FROM best_one) AS best,
                  (SELECT round(pct, 6) + 0.0 FROM gain) AS improvement_pct
           FROM searched""",
        chain=_GRID_FITS,
    ),
)
def _(spark, sf_dir):
    """One row per setting of the grid, with the best one's gain over the untuned model."""
    train, test = classify.split_train_test(inputs.labelled_documents(spark, sf_dir), "doc_id")
    tuned = classify.tune(train, test, "doc_id")
    rows = [
        (f, d, round(m, 6), (f, d) == (tuned.num_features, tuned.min_doc_freq), round(tuned.improvement_pct, 6) + 0.0)
        for f, d, m in tuned.grid
    ]
    return spark.createDataFrame(
        rows, "features int, min_doc_freq int, f1 double, best boolean, improvement_pct double"
    )


_POST_DOCS_SQL = f"""{LABELLED_TEXT_SQL},
docs AS (
  SELECT post_id AS id, label, text, {_TRAIN_SQL.replace("doc_id", "post_id")} AS train, 0 AS fold FROM labelled)"""


@query(
    "nb_stream",
    _hashed_sql(
        """SELECT 0::BIGINT AS batch_id, 'trained' AS status,
                  (SELECT count(*) FROM docs WHERE train) AS train, (SELECT count(*) FROM docs WHERE NOT train) AS test,
                  round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, NULL::DOUBLE AS tuned_f1
           FROM rated""",
        docs=_POST_DOCS_SQL,
        chain=_ONE_FIT,
    ),
)
def _(spark, sf_dir):
    base = scratch_dir(spark, "nb")
    labelled = labelled_text(inputs.post_text_stream(spark, sf_dir), inputs.short_weights(spark))
    drain(train_per_batch(labelled, f"{base}/out", f"{base}/checkpoint", "post_id"))
    rows = spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out/batch_*")
    return rows.withColumns({c: F.round(c, 6) for c in ("accuracy", "f1")})


@query(
    "nb_stream_tuned",
    _hashed_sql(
        """SELECT 0::BIGINT AS batch_id, 'tuned' AS status,
                  (SELECT count(*) FROM docs WHERE train) AS train, (SELECT count(*) FROM docs WHERE NOT train) AS test,
                  round(b.accuracy, 6) AS accuracy, round(b.f1, 6) AS f1, round(t.f1, 6) AS tuned_f1
           FROM rated b, rated t, best_one WHERE b.fit = -1 AND t.fit = 3 * best_one.setting + 2""",
        docs=_POST_DOCS_SQL.replace(
            "0 AS fold", "CAST(('0x' || substr(md5(post_id || '-12346'), 1, 8)) AS BIGINT) % 2 AS fold"
        ),
        chain=_GRID_FITS,
    ),
)
def _(spark, sf_dir):
    """The classifier of a batch, tuned by folds of that batch."""
    base = scratch_dir(spark, "nb")
    labelled = labelled_text(inputs.post_text_stream(spark, sf_dir), inputs.short_weights(spark))
    drain(train_per_batch(labelled, f"{base}/out", f"{base}/checkpoint", "post_id", with_tuning=True))
    rows = spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out/batch_*")
    return rows.withColumns({c: F.round(c, 6) for c in ("accuracy", "f1", "tuned_f1")})


# With a penalty the best fit is unique, so SQL finds it by steps of its own.
_PENALTY = 1.0
_LOGISTIC = f""", {weighted_terms(_BASE)}, {logistic(_PENALTY, 2000)}"""


def _logistic_scored(spark, sf_dir):
    train, test = classify.split_train_test(inputs.labelled_documents(spark, sf_dir), "doc_id")
    model = classify.fit_logistic(train, iterations=500, penalty=_PENALTY, tolerance=1e-10)
    return model.transform(test).select("doc_id", "label", "prediction", "rawPrediction", "probability")


@query(
    "lr_predictions",
    _hashed_sql(
        "SELECT id AS doc_id, label, prediction, round(probability, 3) AS probability FROM guesses",
        chain=_LOGISTIC,
        recursive=True,
    ),
)
def _(spark, sf_dir):
    of_one = F.get(vector_to_array("probability"), F.lit(1))
    return _logistic_scored(spark, sf_dir).select(
        "doc_id", "label", "prediction", F.round(of_one, 3).alias("probability")
    )


@query(
    "lr_metrics",
    _hashed_sql(
        """SELECT label, prediction, count(*) AS n, (SELECT round(area, 9) FROM curve) AS area_under_roc
           FROM guesses GROUP BY label, prediction""",
        chain=f"""{_LOGISTIC},
        ranked AS (SELECT label, rank() OVER w + (count(*) OVER (PARTITION BY round(score, 9)) - 1) / 2.0 AS r
                   FROM guesses WINDOW w AS (ORDER BY round(score, 9))),
        curve AS (
          SELECT ((sum(r) FILTER (WHERE label = 1))::DOUBLE - p * (p + 1) / 2) / (p * (count(*) - p)) AS area
          FROM ranked, (SELECT count(*)::DOUBLE AS p FROM ranked WHERE label = 1) GROUP BY p)""",
        recursive=True,
    ),
)
def _(spark, sf_dir):
    """The cells of the confusion matrix, each beside the area under the ROC curve."""
    # Scored once, for the cells and for the curve.
    path = scratch_dir(spark, "lr")
    _logistic_scored(spark, sf_dir).select("label", "prediction", "rawPrediction").write.parquet(path)
    predictions = spark.read.parquet(path)
    area = classify.area_under_roc(predictions)
    cells = classify.confusion_matrix(predictions).withColumn("area_under_roc", F.lit(round(area, 9)))
    return cells.orderBy("label", "prediction")


# --- post clusters ---------------------------------------------------------------------------


def _buckets(df, vector: str):
    """``(doc_id, bucket, n)``, one row per occupied bucket of a sparse vector."""
    pairs = F.arrays_zip(F.unwrap_udt(vector)["indices"].alias("bucket"), _values(vector).alias("n"))
    return df.select("doc_id", F.inline(pairs).alias("bucket", "n"))


def _pairs_sql(lowered: str = "SELECT doc_id AS id, lower(text) AS t FROM documents") -> str:
    return f"""lowered AS ({lowered}),
        words AS (
          SELECT id, substr(t, CAST(i AS BIGINT), 2) AS term FROM
            (SELECT id, t, unnest(range(1, greatest(length(t), 2))) AS i FROM lowered WHERE t <> '')),
        {hashes()}"""


@query(
    "text_features",
    f"""WITH {_pairs_sql()}
        SELECT id AS doc_id, CAST(((h % {_TEXT}) + {_TEXT}) % {_TEXT} AS INTEGER) AS bucket,
               CAST(count(*) AS DOUBLE) AS n
        FROM words JOIN hashes USING (term) GROUP BY ALL""",
)
def _(spark, sf_dir):
    """Per document and occupied bucket: its count of pairs of characters."""
    documents = inputs.documents(spark, sf_dir).select("doc_id", "text")
    return _buckets(clusters.featurize(documents), "features")


_CLUSTERS, _STEPS, _DRAW = 5, 10, 1
_KMEANS_SQL = text_clusters(_TEXT, _CLUSTERS, _STEPS, _DRAW)
_IDS_SQL = "ids AS (SELECT doc_id AS id FROM documents WHERE text IS NOT NULL)"
_PLACED_SQL = f"WITH {_pairs_sql()}, {_IDS_SQL}, asked AS (SELECT id FROM ids), {_KMEANS_SQL}"
# Posts stand beside the documents under negative ids and take no part in the training.
_POSTS_PLACED_SQL = f"""WITH {inputs.POST_TEXTS_SQL}, {_pairs_sql(
    "SELECT doc_id AS id, lower(text) AS t FROM documents UNION ALL SELECT -1 - post_id, lower(text) FROM post_texts"
)}, {_IDS_SQL}, asked AS (SELECT id FROM lowered), {_KMEANS_SQL}"""


def _post_clusters(spark, sf_dir):
    """Trained centres, read back from the table they are saved in, and the documents."""
    documents = inputs.documents(spark, sf_dir).select("doc_id", "text")
    path = scratch_dir(spark, "post-centres")
    centres = clusters.fit_text_centres(documents, _CLUSTERS, _STEPS, _DRAW)
    clusters.save_centres(centres, spark, path)
    return clusters.load_centres(spark, path), documents


@query("kmeans_clusters", f"{_PLACED_SQL} SELECT id AS doc_id, cluster FROM placed")
def _(spark, sf_dir):
    model, documents = _post_clusters(spark, sf_dir)
    return clusters.assign_clusters(model, documents).drop("text")


@query(
    "cluster_examples",
    f"""{_PLACED_SQL}
        SELECT doc_id, text, cluster FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 100)
        JOIN placed ON doc_id = id""",
)
def _(spark, sf_dir):
    model, documents = _post_clusters(spark, sf_dir)
    return clusters.cluster_examples(model, documents, "doc_id", 100)


@query(
    "cluster_sizes",
    f"{_PLACED_SQL} SELECT cluster, count(*) AS posts FROM placed GROUP BY cluster",
)
def _(spark, sf_dir):
    return clusters.cluster_sizes(clusters.assign_clusters(*_post_clusters(spark, sf_dir)))


@query(
    "cluster_filter",
    f"""{_POSTS_PLACED_SQL}
        SELECT post_id, text, cluster FROM post_texts JOIN placed ON id = -1 - post_id
        WHERE cluster = (SELECT cluster FROM placed WHERE id >= 0 ORDER BY id LIMIT 1)""",
)
def _(spark, sf_dir):
    """Streamed posts of the cluster that the first document falls into."""
    from rookery.plans.stream_queries import _written

    model, documents = _post_clusters(spark, sf_dir)
    chosen = clusters.assign_clusters(model, documents.orderBy("doc_id").limit(1)).first()
    stream = inputs.post_text_stream(spark, sf_dir).select("post_id", "text")

    def chosen_posts(batch):
        return clusters.cluster_filter(model, batch, chosen["cluster"])

    return _written(spark, stream, transform=chosen_posts, reuse=True)


# --- online k-means --------------------------------------------------------------------------


def _distance(centre: str) -> str:
    return f"(x0 - {centre}.c0) * (x0 - {centre}.c0) + (x1 - {centre}.c1) * (x1 - {centre}.c1)"


def _step_sql(old: str, new: str, where: str) -> str:
    """One update of the centre table ``old`` by the points that satisfy ``where``."""
    return f"""
{new}_sums AS (
  SELECT cluster, count(*) AS n, sum(x0) AS s0, sum(x1) AS s1 FROM (
    SELECT x0, x1, arg_min(c.cluster, struct_pack(d := {_distance("c")}, j := c.cluster)) AS cluster
    FROM (SELECT row_number() OVER () AS r, * FROM points WHERE {where}) p, {old} c
    GROUP BY r, x0, x1)
  GROUP BY cluster),
{new} AS (
  SELECT c.cluster, CASE WHEN n IS NULL THEN c0 ELSE (c0 * weight + s0) / (weight + n) END AS c0,
         CASE WHEN n IS NULL THEN c1 ELSE (c1 * weight + s1) / (weight + n) END AS c1,
         weight + coalesce(n, 0) AS weight
  FROM {old} c LEFT JOIN {new}_sums USING (cluster))"""


_START_SQL = "start_centres AS (SELECT * FROM (VALUES {}) t(cluster, c0, c1, weight))".format(
    ", ".join(f"({j}, {a}, {b}, 0.0)" for j, (a, b) in enumerate(inputs.START_CENTRES))
)
_CENTRES_OUT = """SELECT CAST(cluster AS INTEGER) AS cluster, round(CAST(c0 AS DOUBLE), 6) AS c0,
       round(CAST(c1 AS DOUBLE), 6) AS c1, CAST(weight AS DOUBLE) AS weight FROM"""
_ONE_STEP = f"""WITH {inputs.CLUSTER_POINTS_SQL}, {_START_SQL},
{_step_sql("start_centres", "after1", "true")}"""


def _centres_out(rows):
    return rows.select(
        "cluster",
        F.round(F.get("centre", F.lit(0)), 6).alias("c0"),
        F.round(F.get("centre", F.lit(1)), 6).alias("c1"),
        "weight",
    )


def _updated_centres(spark, sf_dir):
    start = clusters.Centres.of(inputs.START_CENTRES)
    return clusters.kmeans_update(start, inputs.cluster_points(spark, sf_dir))


@query("kmeans_update", f"{_ONE_STEP} {_CENTRES_OUT} after1")
def _(spark, sf_dir):
    return _centres_out(_updated_centres(spark, sf_dir).to_df(spark))


@query("centres_roundtrip", f"{_ONE_STEP} {_CENTRES_OUT} after1")
def _(spark, sf_dir):
    path = scratch_dir(spark, "centres")
    clusters.save_centres(_updated_centres(spark, sf_dir), spark, path)
    return _centres_out(clusters.load_centres(spark, path).to_df(spark))


@query(
    "kmeans_predict",
    f"""WITH {inputs.CLUSTER_POINTS_SQL}, {_START_SQL}
        SELECT id, x0, x1, CAST(arg_min(c.cluster, struct_pack(d := {_distance("c")}, j := c.cluster))
                                AS INTEGER) AS cluster
        FROM (SELECT row_number() OVER () AS r, * FROM points) p, start_centres c
        GROUP BY r, id, x0, x1""",
)
def _(spark, sf_dir):
    state = clusters.Centres.of(inputs.START_CENTRES)
    placed = clusters.kmeans_predict(state, inputs.cluster_points(spark, sf_dir))
    return placed.select(
        "id",
        F.get("features", F.lit(0)).alias("x0"),
        F.get("features", F.lit(1)).alias("x1"),
        "cluster",
    )


def _two_landings(spark, sf_dir, folder, to_lines, run):
    """Land the shipped and then the open items as lines; ``run`` after each landing."""
    items = table(spark, sf_dir, "lineitem")
    for part in (F.col("l_linestatus") == "F", F.col("l_linestatus") != "F"):
        to_lines(items.filter(part)).write.mode("append").text(folder)
        run()


@query(
    "kmeans_stream",
    f"""WITH {inputs.CLUSTER_POINTS_SQL}, {_START_SQL},
        {_step_sql("start_centres", "after1", "status = 'F'")},
        {_step_sql("after1", "after2", "status <> 'F'")} {_CENTRES_OUT} after2""",
)
def _(spark, sf_dir):
    """Centres after two landings of vector lines, the second one read by a restarted query."""
    base = scratch_dir(spark, "kmeans")

    def run():
        points = parse_vectors(read_line_stream(spark, f"{base}/in"))
        drain(
            online.train_kmeans(
                points,
                f"{base}/state",
                f"{base}/checkpoint",
                clusters.Centres.of(inputs.START_CENTRES),
            )
        )

    _two_landings(spark, sf_dir, f"{base}/in", inputs.vector_lines, run)
    return _centres_out(online.centre_table(f"{base}/state").newest(spark))


def _with_bad_lines(lines, every: int):
    """Lines and, for about one in ``every``, an unreadable one beside it."""
    picked = lines.filter(F.pmod(F.xxhash64("value"), F.lit(every)) == 0)
    bad = F.array(*[F.lit(x) for x in ("garbage", "[]", "[1.0]", "", "(3.0,[])", "(x,[1.0,2.0])")])
    broken = picked.select(F.get(bad, F.pmod(F.xxhash64("value", F.lit(1)), F.lit(6)).cast("int")).alias("value"))
    return lines.unionByName(broken)


@query(
    "kmeans_stream_dirty",
    f"""WITH {inputs.CLUSTER_POINTS_SQL}, {_START_SQL},
        {_step_sql("start_centres", "after1", "status = 'F'")},
        {_step_sql("after1", "after2", "status <> 'F'")} {_CENTRES_OUT} after2""",
)
def _(spark, sf_dir):
    """The centres of ``kmeans_stream`` although unreadable lines land among the others."""
    base = scratch_dir(spark, "kmeans")

    def run():
        points = parse_vectors(read_line_stream(spark, f"{base}/in"))
        start = clusters.Centres.of(inputs.START_CENTRES)
        drain(online.train_kmeans(points, f"{base}/state", f"{base}/checkpoint", start))

    dirty = lambda items: _with_bad_lines(inputs.vector_lines(items), 50)
    _two_landings(spark, sf_dir, f"{base}/in", dirty, run)
    return _centres_out(online.centre_table(f"{base}/state").newest(spark))


@query(
    "kmeans_predict_stream",
    f"""{_ONE_STEP}
        SELECT id, cluster, count(*) AS n FROM (
          SELECT id, CAST(arg_min(c.cluster, struct_pack(d := {_distance("c")}, j := c.cluster))
                          AS INTEGER) AS cluster
          FROM (SELECT row_number() OVER () AS r, * FROM points) p, after1 c GROUP BY r, id, x0, x1)
        GROUP BY id, cluster""",
)
def _(spark, sf_dir):
    """Known ids beside the clusters by the centres trained before."""
    base = scratch_dir(spark, "kmeans-predict")
    items = table(spark, sf_dir, "lineitem")
    write_lines(inputs.vector_lines(items), f"{base}/train")
    write_lines(inputs.labeled_point_lines(items), f"{base}/test")
    train = parse_vectors(read_line_stream(spark, f"{base}/train"))
    start = clusters.Centres.of(inputs.START_CENTRES)
    drain(online.train_kmeans(train, f"{base}/state", f"{base}/c1", start))
    test = parse_labeled_points(read_line_stream(spark, f"{base}/test")).select(
        F.col("label").cast("int").alias("id"), "features"
    )
    drain(online.predict_kmeans(test, f"{base}/state", f"{base}/out", "batch", f"{base}/c2"))
    return spark.read.parquet(f"{base}/out/batch_*").groupBy("id", "cluster").agg(
        F.count(F.lit(1)).alias("n")
    )


# --- online regression -----------------------------------------------------------------------


def _descent_sql(name: str, start: str, where: str) -> str:
    """Fifty gradient steps from ``(w, b)`` of ``start`` on the sums of the chosen points."""
    return f"""
{name}_sums AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(y) AS sy,
                       sum(x * x) AS sxx, sum(x * y) AS sxy FROM points WHERE {where}),
{name}_path AS (
  SELECT 0 AS i, w, CAST(1.0 AS DOUBLE) AS b, false AS done FROM {start}
  UNION ALL
  SELECT i, w2, b2,
         sqrt((w2 - w) * (w2 - w) + (b2 - b) * (b2 - b)) < 0.001 * greatest(sqrt(w2 * w2 + b2 * b2), 1.0)
  FROM (SELECT i + 1 AS i, w, b,
               w - 0.1 / sqrt(i + 1) * (sxx * w + sx * b - sxy) / n AS w2,
               b - 0.1 / sqrt(i + 1) * (sx * w + n * b - sy) / n AS b2
        FROM {name}_path, {name}_sums WHERE i < 50 AND NOT done)),
{name} AS (SELECT w, b FROM {name}_path ORDER BY i DESC LIMIT 1)"""


_ZERO = "zero AS (SELECT CAST(0.0 AS DOUBLE) AS w, CAST(0.0 AS DOUBLE) AS b)"


def _weights_out(rows):
    return rows.select(
        F.round(F.get("weights", F.lit(0)), 6).alias("w"), F.round("intercept", 6).alias("b")
    )


@query(
    "linreg_sufficient_stats",
    f"""WITH {inputs.REGRESSION_POINTS_SQL}
        SELECT count(*) AS n, round(sum(y), 4) + 0.0 AS s_y, round(sum(x), 4) + 0.0 AS s_x0,
               round(sum(x * y), 4) AS s_xy0, round(sum(x * x), 4) AS s_xx0_0 FROM points""",
)
def _(spark, sf_dir):
    stats = regression.sufficient_stats(inputs.regression_points(spark, sf_dir))
    # Adding zero turns a rounded -0.0 into 0.0.
    return stats.withColumns(
        {c: F.round(c, 4) + F.lit(0.0) for c in stats.columns if c != "n"}
    )


@query(
    "linreg_update",
    f"""WITH RECURSIVE {inputs.REGRESSION_POINTS_SQL}, {_ZERO}, {_descent_sql("done1", "zero", "true")}
        SELECT round(w, 6) AS w, round(b, 6) AS b FROM done1""",
)
def _(spark, sf_dir):
    points = inputs.regression_points(spark, sf_dir)
    updated = regression.linreg_update(regression.LinearState.zeros(), points)
    return _weights_out(updated.to_df(spark))


@query(
    "linreg_stream",
    f"""WITH RECURSIVE {inputs.REGRESSION_POINTS_SQL}, {_ZERO},
        {_descent_sql("done1", "zero", "status = 'F'")},
        {_descent_sql("done2", "done1", "status <> 'F'")}
        SELECT round(w, 6) AS w, round(b, 6) AS b FROM done2""",
)
def _(spark, sf_dir):
    """Weights after two landings of labelled-point lines."""
    return _trained_linreg(spark, sf_dir, lambda lines: lines)


@query(
    "linreg_stream_dirty",
    f"""WITH RECURSIVE {inputs.REGRESSION_POINTS_SQL}, {_ZERO},
        {_descent_sql("done1", "zero", "status = 'F'")},
        {_descent_sql("done2", "done1", "status <> 'F'")}
        SELECT round(w, 6) AS w, round(b, 6) AS b FROM done2""",
)
def _(spark, sf_dir):
    """The weights of ``linreg_stream`` although unreadable lines land among the others."""
    return _trained_linreg(spark, sf_dir, lambda lines: _with_bad_lines(lines, 50))


def _trained_linreg(spark, sf_dir, landed):
    base = scratch_dir(spark, "linreg")
    points = inputs.regression_points(spark, sf_dir)
    for part in (F.col("status") == "F", F.col("status") != "F"):
        line = F.concat(
            F.lit("("),
            F.col("label").cast("string"),
            F.lit(",["),
            F.col("features")[0].cast("string"),
            F.lit("])"),
        )
        lines = points.filter(part).select(line.alias("value"))
        landed(lines).write.mode("append").text(f"{base}/in")
        stream = parse_labeled_points(read_line_stream(spark, f"{base}/in"))
        drain(online.train_linreg(stream, f"{base}/state", f"{base}/checkpoint"))
    return _weights_out(online.weight_table(f"{base}/state").newest(spark))


@query(
    "linreg_predict",
    f"""WITH {inputs.REGRESSION_POINTS_SQL}
        SELECT round(y, 6) + 0.0 AS label, round(x * 0.75 + 0.25, 6) + 0.0 AS prediction
        FROM points""",
)
def _(spark, sf_dir):
    state = regression.LinearState((0.75,), 0.25)
    predicted = regression.linreg_predict(state, inputs.regression_points(spark, sf_dir))
    return predicted.select(
        (F.round("label", 6) + F.lit(0.0)).alias("label"),
        (F.round("prediction", 6) + F.lit(0.0)).alias("prediction"),
    )


@query(
    "standardise",
    f"""WITH {inputs.REGRESSION_POINTS_SQL}
        SELECT status, round(y, 6) + 0.0 AS label, round(x, 6) + 0.0 AS feature FROM points""",
)
def _(spark, sf_dir):
    return inputs.regression_points(spark, sf_dir).select(
        "status",
        (F.round("label", 6) + F.lit(0.0)).alias("label"),
        (F.round(F.get("features", F.lit(0)), 6) + F.lit(0.0)).alias("feature"),
    )
