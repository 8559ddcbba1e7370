"""Inputs of the registered queries, derived from the given tables.

``*_SQL`` constants hold the same derivations as DuckDB common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.operators.bounds import spread
from rookery.operators.posts import FLAT_FIELDS, flatten_posts
from rookery.operators.regression import standardise
from rookery.operators.sinks import write_parquet
from rookery.session import scratch_dir
from rookery.sources.lexicon import count_entries, word_weights
from rookery.sources.tables import replay_table, table

AS_OF = "2024-01-02 00:00:00"
TRACK_PHRASES = ["thing", "that the"]
STOP_WORDS = ["the", "and", "of", "on", "with", "by"]
POSITIVE_WORDS = ["thing", "thble", "inoran", "nicht"]
NEGATIVE_WORDS = ["ononst", "hehely", "erble", "attion"]
START_CENTRES = [(5.0, 1.0), (15.0, 3.0), (25.0, 5.0), (35.0, 7.0), (45.0, 9.0)]


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


# --- posts -----------------------------------------------------------------------------------


def post_texts_from(documents: DataFrame, *keep: str | Column) -> DataFrame:
    """``(post_id, ts, lang, text)``: a document with a hashtag or phrase head on three of four.

    A plain projection, so it also works on a replayed table.
    """
    doc = F.col("doc_id")
    kind = doc % 4
    tags = F.concat(
        F.lit("#"), F.col("lang"), F.lit(" #t"), (doc % 7).cast("string"), F.lit(" "), F.col("text")
    )
    text = (
        F.when(kind == 1, tags)
        .when(kind == 2, F.concat(F.lit("#a #b #c #d #e "), F.col("text")))
        .when(kind == 3, F.concat(F.lit("RT & follow "), F.col("text")))
        .otherwise(F.col("text"))
    )
    start = F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return documents.select(
        doc.alias("post_id"),
        F.timestamp_seconds(start + (doc * 137) % 7200).alias("ts"),
        "lang",
        text.alias("text"),
        *keep,
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, dealt out to all cores when their file is small."""
    return spread(table(spark, sf_dir, "documents"))


def post_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_texts_from(documents(spark, sf_dir))


def post_text_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_texts_from(replay_table(spark, sf_dir, "documents"))


def posts(spark: SparkSession, sf_dir: str, located: bool = True) -> DataFrame:
    """Nested posts, three per user.

    A projection, but for the 25 nations that name the locations; they are null unless ``located``.
    """
    docs = documents(spark, sf_dir)
    texts = post_texts_from(docs, "source", F.expr("doc_id div 3").alias("u"))
    place = F.lit(None).cast("string")
    if located:
        nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        texts = texts.join(nations, (F.col("u") % 25) == F.col("n_nationkey"), "left")
        place = F.when(F.col("u") % 11 != 0, F.col("n_name"))
    u = F.col("u")
    geo = F.struct(
        (F.col("post_id") % 180 - 90).cast("double").alias("lat"),
        (F.col("post_id") % 360 - 180).cast("double").alias("lon"),
    )
    noon = F.unix_timestamp(F.lit("2023-12-31 12:00:00").cast("timestamp"))
    user = F.struct(
        u.alias("id"),
        F.concat(F.lit("User "), u.cast("string")).alias("name"),
        F.concat(F.lit("u"), u.cast("string")).alias("screen_name"),
        F.when(u % 5 == 1, F.lit("short"))
        .when(u % 5 != 0, F.concat(F.col("source"), F.lit(" writer of long standing")))
        .alias("description"),
        F.col("lang").alias("lang"),
        place.alias("location"),
        (u % 3 == 0).alias("verified"),
        ((u % 8) * 50).cast("int").alias("friends_count"),
        ((u * 7) % 13).cast("int").alias("followers_count"),
        ((u * 31) % 500).cast("int").alias("favourites_count"),
        ((u * 17) % 120).cast("int").alias("statuses_count"),
        F.timestamp_seconds(noon - (u % 6) * 43200).alias("created_at"),
    )
    return texts.select(
        "post_id",
        "ts",
        "lang",
        "text",
        F.when(F.col("post_id") % 10 == 0, geo).alias("geo"),
        user.alias("user"),
    )


def posts_flat(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """The flat fields asked for, or all; nations are read for the location alone."""
    fields = fields or tuple(FLAT_FIELDS)
    nested = posts(spark, sf_dir, located="UserLocation" in fields)
    return flatten_posts(nested, keep=["post_id"], only=fields)


POST_TEXTS_SQL = """
post_texts AS (
  SELECT doc_id AS post_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds((doc_id * 137) % 7200) AS ts,
         lang,
         CASE doc_id % 4
           WHEN 1 THEN '#' || lang || ' #t' || (doc_id % 7) || ' ' || text
           WHEN 2 THEN '#a #b #c #d #e ' || text
           WHEN 3 THEN 'RT & follow ' || text
           ELSE text END AS text,
         source
  FROM documents)"""

POSTS_SQL = (
    POST_TEXTS_SQL
    + """,
posts AS (
  SELECT p.post_id, p.ts, p.lang, p.text, p.u, 'User ' || p.u AS name,
         'u' || p.u AS screen_name,
         CASE WHEN p.u % 5 = 1 THEN 'short'
              WHEN p.u % 5 <> 0 THEN p.source || ' writer of long standing' END
           AS description,
         CASE WHEN p.u % 11 <> 0 THEN n.n_name END AS location,
         p.u % 3 = 0 AS verified,
         CAST((p.u % 8) * 50 AS INTEGER) AS friends,
         CAST((p.u * 7) % 13 AS INTEGER) AS followers,
         CAST((p.u * 31) % 500 AS INTEGER) AS favourites,
         CAST((p.u * 17) % 120 AS INTEGER) AS statuses,
         TIMESTAMP '2023-12-31 12:00:00' - to_hours((p.u % 6) * 12) AS created_at,
         CASE WHEN p.post_id % 10 = 0 THEN CAST(p.post_id % 180 - 90 AS DOUBLE) END AS lat,
         CASE WHEN p.post_id % 10 = 0 THEN CAST(p.post_id % 360 - 180 AS DOUBLE) END AS lon
  FROM (SELECT *, post_id // 3 AS u FROM post_texts) p
  LEFT JOIN nation n ON n.n_nationkey = p.u % 25)"""
)

FLAT_SQL = (
    POSTS_SQL
    + """,
posts_flat AS (
  SELECT post_id, u AS "UserID", description AS "UserDescription",
         screen_name AS "UserScreenName", friends AS "UserFriendsCount",
         favourites AS "UserFavouritesCount", followers AS "UserFollowersCount",
         CASE WHEN friends = 0 AND followers = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN friends = 0 THEN CAST('Infinity' AS DOUBLE)
              ELSE CAST(CAST(followers AS FLOAT) / CAST(friends AS FLOAT) AS DOUBLE) END
           AS "UserFollowersRatio",
         lat AS "GeoLatitude", lon AS "GeoLongitude", lang AS "UserLang",
         location AS "UserLocation", verified AS "UserVerification", name AS "UserName",
         statuses AS "UserStatusCount",
         strftime(created_at, '%Y-%m-%dT%H:%M:%S.000+0000') AS "UserCreated",
         text AS "Text", CAST(length(text) AS INTEGER) AS "TextLength",
         array_to_string(list_filter(string_split(text, ' '), lambda t: starts_with(t, '#')), ' ')
           AS "HashTags",
         strftime(ts, '%Y-%m-%dT%H:%M:%S.000+0000') AS "StatusCreatedAt"
  FROM posts)"""
)


# --- word lists ------------------------------------------------------------------------------


def word_list(spark: SparkSession, words: list[str]) -> DataFrame:
    listed = spark.range(1).select(F.explode(F.lit(words)).alias("word"))
    return count_entries(listed)


def short_weights(spark: SparkSession) -> DataFrame:
    """Weights of the two short lists."""
    return word_weights(word_list(spark, POSITIVE_WORDS), word_list(spark, NEGATIVE_WORDS))


def turn_words(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    """The words one role uses in conversations, one per row with repeats: a long list."""
    turns = table(spark, sf_dir, "conversations").filter(F.col("role") == role)
    return turns.select(F.explode(F.split("text", r"\s+")).alias("word"))


def long_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of the two long lists, written out because scoring reads them more than once."""
    path = scratch_dir(spark, "weights")
    weights = word_weights(
        count_entries(turn_words(spark, sf_dir, "user")),
        count_entries(turn_words(spark, sf_dir, "assistant")),
    )
    write_parquet(weights, path)
    return spark.read.schema(weights.schema).parquet(path)


def _values(words: list[str]) -> str:
    return ", ".join(f"('{w}')" for w in words)


SHORT_WEIGHTS_SQL = f"""
weights AS (
  SELECT word, sum(n) AS weight FROM (
    SELECT word, 1 AS n FROM (VALUES {_values(POSITIVE_WORDS)}) p(word)
    UNION ALL SELECT word, -1 FROM (VALUES {_values(NEGATIVE_WORDS)}) q(word)) GROUP BY word)"""

LONG_WEIGHTS_SQL = """
weights AS (
  SELECT word, sum(n) AS weight FROM (
    SELECT unnest(string_split_regex(lower(text), '\\s+')) AS word,
           CASE role WHEN 'user' THEN 1 ELSE -1 END AS n
    FROM conversations WHERE role IN ('user', 'assistant'))
  WHERE word <> '' GROUP BY word)"""


# --- lines -----------------------------------------------------------------------------------


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all documents, column ``text``."""
    return documents(spark, sf_dir).select(F.explode(F.split("text", "\n")).alias("text"))


def people_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = (F.col("c_custkey") % 60).cast("string")
    line = F.concat("c_name", F.lit(" "), age)
    return table(spark, sf_dir, "customer").select(line.alias("value"))


PEOPLE_SQL = """
people AS (SELECT c_name AS name, CAST(c_custkey % 60 AS INTEGER) AS age FROM customer)"""


def _whole(col: Column) -> Column:
    return F.concat(F.round(col).cast("int").cast("string"), F.lit(".0"))


def vector_line() -> Column:
    return F.concat(
        F.lit("["),
        _whole(F.col("l_quantity")),
        F.lit(","),
        _whole(F.col("l_discount") * 100),
        F.lit("]"),
    )


def vector_lines(items: DataFrame) -> DataFrame:
    """``[quantity,discount percent]`` lines."""
    return items.select(vector_line().alias("value"))


def labeled_point_lines(items: DataFrame) -> DataFrame:
    """``(line number,[quantity,discount percent])`` lines."""
    line = F.concat(
        F.lit("("), _whole(F.col("l_linenumber")), F.lit(","), vector_line(), F.lit(")")
    )
    return items.select(line.alias("value"))


def cluster_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, features)`` with two dimensions; the id is the line number."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("id"),
        F.array("l_quantity", F.round(F.col("l_discount") * 100)).alias("features"),
    )


CLUSTER_POINTS_SQL = """
points AS (SELECT l_linenumber AS id, l_linestatus AS status, l_quantity AS x0,
                  round(l_discount * 100) AS x1 FROM lineitem)"""


def regression_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(status, label, features)``: scaled price by scaled quantity."""
    items = table(spark, sf_dir, "lineitem")
    scaled = standardise(
        items.select("l_linestatus", "l_extendedprice", "l_quantity"),
        ["l_extendedprice", "l_quantity"],
    )
    return scaled.select(
        F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").alias("label"),
        F.array("l_quantity").alias("features"),
    )


REGRESSION_POINTS_SQL = """
moments AS (
  SELECT avg(l_extendedprice) AS my, avg(l_quantity) AS mx,
         greatest(max(l_extendedprice) - avg(l_extendedprice),
                  avg(l_extendedprice) - min(l_extendedprice)) AS ry,
         greatest(max(l_quantity) - avg(l_quantity),
                  avg(l_quantity) - min(l_quantity)) AS rx
  FROM lineitem),
points AS (SELECT l_linestatus AS status, (l_extendedprice - my) / ry AS y,
                  (l_quantity - mx) / rx AS x FROM lineitem, moments)"""


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, value)``: one log line per event, every fiftieth unreadable."""
    event, user = F.col("event_id"), F.col("user_id")
    status = F.when(F.col("event_type") == "error", F.lit("500")).otherwise(F.lit("200"))
    size = F.when(event % 10 == 1, F.lit("-")).otherwise((event % 5000).cast("string"))
    line = F.concat(
        F.lit("10.0."),
        (user % 256).cast("string"),
        F.lit("."),
        (event % 256).cast("string"),
        F.lit(" - u"),
        user.cast("string"),
        F.lit(" ["),
        F.date_format(F.col("ts").cast("timestamp"), "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' +0000] "GET /'),
        F.col("event_type"),
        F.lit(' HTTP/1.1" '),
        status,
        F.lit(" "),
        size,
        F.lit(' "-" "agent"'),
    )
    line = F.when(event % 50 == 0, F.lit("malformed")).otherwise(line)
    return table(spark, sf_dir, "events").select("event_id", line.alias("value"))


# --- labelled documents ----------------------------------------------------------------------


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text, label)`` of the documents with a quality mark."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    return documents(spark, sf_dir).select("doc_id", "text").join(labels, "doc_id")
