"""Projections, filters, roll-ups and spam rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.functions.text import string_or_empty
from rookery.functions.values import followers_ratio, format_ts, parse_ts
from rookery.operators import posts as post_ops
from rookery.operators import rollups, spam
from rookery.operators.posts import FLAT_FIELDS
from rookery.operators.sinks import register_view, write_parquet
from rookery.plans import inputs
from rookery.plans.registry import query
from rookery.session import scratch_dir
from rookery.sources.lines import parse_people
from rookery.sources.tables import table

_FLAT = inputs.FLAT_SQL


@query("post_text", f"WITH {inputs.POST_TEXTS_SQL} SELECT text FROM post_texts")
def _(spark, sf_dir):
    return post_ops.post_text(inputs.post_texts(spark, sf_dir))


@query("flatten_posts", f"WITH {_FLAT} SELECT * FROM posts_flat")
def _(spark, sf_dir):
    return inputs.posts_flat(spark, sf_dir)


@query(
    "followers_ratio",
    """SELECT c_custkey, CASE WHEN b = 0 AND a = 0 THEN CAST('NaN' AS DOUBLE)
                              WHEN b = 0 THEN CAST('Infinity' AS DOUBLE)
                              ELSE CAST(CAST(a AS FLOAT) / CAST(b AS FLOAT) AS DOUBLE) END AS ratio
       FROM (SELECT c_custkey, CAST((c_custkey * 7) % 13 AS INTEGER) AS a,
                    CAST((c_custkey % 8) * 50 AS INTEGER) AS b FROM customer)""",
)
def _(spark, sf_dir):
    key = F.col("c_custkey")
    ratio = followers_ratio(((key * 7) % 13).cast("int"), ((key % 8) * 50).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", ratio.alias("ratio"))


@query(
    "format_timestamp",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') ||
              lpad(CAST(date_part('microsecond', ts) % 1000000 // 1000 AS VARCHAR), 3, '0') ||
              '+0000' AS at
       FROM events""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", format_ts(F.col("ts").cast("timestamp")).alias("at"))


@query(
    "parse_timestamp",
    "SELECT event_id, CAST(epoch_us(ts) // 1000 + 4 * 3600000 AS BIGINT) AS millis FROM events",
)
def _(spark, sf_dir):
    # The text says four hours behind UTC, so the instant is four hours later.
    text = F.concat(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-0400")
    )
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.unix_millis(parse_ts(text)).alias("millis"))


@query(
    "nested_project",
    f"WITH {inputs.POSTS_SQL} SELECT lang, name, text FROM posts ORDER BY post_id LIMIT 1000",
)
def _(spark, sf_dir):
    return (
        inputs.posts(spark, sf_dir, located=False)
        .select("post_id", "user.lang", "user.name", "text")
        .orderBy("post_id")
        .limit(1000)
        .drop("post_id")
    )


@query(
    "range_filter",
    f"WITH {inputs.PEOPLE_SQL} SELECT name, age FROM people WHERE age >= 30 AND age <= 40",
)
def _(spark, sf_dir):
    people = parse_people(inputs.people_lines(spark, sf_dir))
    return people.filter(F.col("age").between(30, 40)).select("name", "age")


@query("equality_filter", f"WITH {inputs.PEOPLE_SQL} SELECT name, age FROM people WHERE age = 31")
def _(spark, sf_dir):
    view = register_view(parse_people(inputs.people_lines(spark, sf_dir)), "people")
    return view.sparkSession.sql("SELECT name, age FROM people WHERE age = 31")


@query(
    "lang_filter",
    f"WITH {inputs.POST_TEXTS_SQL} SELECT post_id, text FROM post_texts WHERE lang = 'en'",
)
def _(spark, sf_dir):
    return post_ops.lang_filter(inputs.post_texts(spark, sf_dir), "en").select("post_id", "text")


_TRACK_TOKENS = "string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')"
_TRACK_SQL = " OR ".join(
    "(" + " AND ".join(f"list_contains({_TRACK_TOKENS}, '{t}')" for t in p.split()) + ")"
    for p in inputs.TRACK_PHRASES
)


@query(
    "track_filter",
    f"WITH {inputs.POST_TEXTS_SQL} SELECT post_id FROM post_texts WHERE {_TRACK_SQL}",
)
def _(spark, sf_dir):
    texts = inputs.post_texts(spark, sf_dir)
    return post_ops.track_filter(texts, inputs.TRACK_PHRASES).select("post_id")


@query(
    "row_label",
    f"WITH {inputs.PEOPLE_SQL} SELECT 'Name: ' || name AS label FROM people WHERE age BETWEEN 30 AND 40",
)
def _(spark, sf_dir):
    people = parse_people(inputs.people_lines(spark, sf_dir))
    return post_ops.label_rows(people.filter(F.col("age").between(30, 40)))


@query(
    "row_as_map",
    f"""WITH {inputs.PEOPLE_SQL}
        SELECT name, CAST(age AS VARCHAR) AS age, CAST(2 AS INTEGER) AS entries
        FROM people WHERE age BETWEEN 30 AND 40""",
)
def _(spark, sf_dir):
    people = parse_people(inputs.people_lines(spark, sf_dir))
    rows = post_ops.rows_as_map(people.filter(F.col("age").between(30, 40)), ["name", "age"])
    return rows.select(
        F.col("row")["name"].alias("name"),
        F.col("row")["age"].alias("age"),
        F.size("row").alias("entries"),
    )


@query(
    "string_or_empty",
    f"WITH {inputs.POSTS_SQL} SELECT post_id, coalesce(location, '') AS location FROM posts",
)
def _(spark, sf_dir):
    location = string_or_empty(F.col("user.location"))
    return inputs.posts(spark, sf_dir).select("post_id", location.alias("location"))


@query("view_project", "SELECT text, CAST(quality AS DOUBLE) AS label FROM documents JOIN labels USING (doc_id)")
def _(spark, sf_dir):
    view = register_view(inputs.labelled_documents(spark, sf_dir), "labelled_texts")
    return view.sparkSession.sql("SELECT text, label FROM labelled_texts")


# --- outputs ---------------------------------------------------------------------------------

_JSON_FIELDS = [f for f in FLAT_FIELDS if f != "UserFollowersRatio"]


@query(
    "parquet_roundtrip",
    f'WITH {_FLAT} SELECT post_id, "UserName", "UserLang" FROM posts_flat',
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "users")
    write_parquet(inputs.posts_flat(spark, sf_dir, "UserName", "UserLang"), path, ["post_id", "UserName", "UserLang"])
    return spark.read.parquet(path)


@query(
    "preview_top_n",
    f"WITH {inputs.POST_TEXTS_SQL} SELECT post_id, text FROM post_texts ORDER BY post_id LIMIT 10",
)
def _(spark, sf_dir):
    return rollups.preview(inputs.post_texts(spark, sf_dir).select("post_id", "text"), 10, ["post_id"])


@query("sample_rows", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100")
def _(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rollups.sample_rows(documents, 100, "doc_id")


# --- roll-ups --------------------------------------------------------------------------------


@query(
    "lang_counts",
    f"""WITH {_FLAT} SELECT "UserLang", count(*) AS "Counts" FROM posts_flat
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1000""",
)
def _(spark, sf_dir):
    return rollups.lang_counts(inputs.posts_flat(spark, sf_dir, "UserLang"), 1000)


@query(
    "location_counts",
    f"""WITH {_FLAT} SELECT "UserLocation", count(*) AS "LoCount" FROM posts_flat
        GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10""",
)
def _(spark, sf_dir):
    return rollups.location_counts(inputs.posts_flat(spark, sf_dir, "UserLocation"), 10)


@query(
    "top_friends",
    f"""WITH {_FLAT} SELECT "UserName", "UserFriendsCount", "UserLang" FROM posts_flat
        GROUP BY ALL ORDER BY 2 DESC, 1 NULLS LAST, 3 NULLS LAST LIMIT 10""",
)
def _(spark, sf_dir):
    return rollups.top_friends(inputs.posts_flat(spark, sf_dir, "UserName", "UserFriendsCount", "UserLang"), 10)


@query(
    "verified_users",
    f'WITH {_FLAT} SELECT DISTINCT "UserName", "UserVerification" FROM posts_flat',
)
def _(spark, sf_dir):
    return rollups.verified_users(inputs.posts_flat(spark, sf_dir, "UserName", "UserVerification"))


@query(
    "en_posts",
    f"""WITH {_FLAT} SELECT "UserLang", "UserName", "Text" FROM posts_flat
        WHERE "UserLang" = 'en' ORDER BY post_id LIMIT 10""",
)
def _(spark, sf_dir):
    return rollups.posts_in_language(inputs.posts_flat(spark, sf_dir, "UserLang", "UserName", "Text"), "en", 10)


@query(
    "en_texts",
    f"""WITH {_FLAT} SELECT "Text" FROM posts_flat
        WHERE "UserLang" = 'en' ORDER BY post_id LIMIT 10""",
)
def _(spark, sf_dir):
    return rollups.texts_in_language(inputs.posts_flat(spark, sf_dir, "UserLang", "Text"), "en", 10)


# --- spam ------------------------------------------------------------------------------------

_LOW = 'lower("Text")'
_RULE_SQL = {
    "account_age_ok": f"""date_diff('second', strptime("UserCreated", '%Y-%m-%dT%H:%M:%S.000+0000'),
                          TIMESTAMP '{inputs.AS_OF}') // 86400 > 1""",
    "status_count_ok": '"UserStatusCount" > 50',
    "followers_ratio_ok": 'NOT isnan("UserFollowersRatio") AND "UserFollowersRatio" > CAST(0.01 AS DOUBLE)',
    "description_ok": 'length("UserDescription") > 20',
    "hashtag_count_ok": """len(list_filter(string_split("Text", ' '), lambda t: starts_with(t, '#'))) < 5""",
    "text_length_ok": '"TextLength" > 20',
    "no_follow_phrase": "NOT (" + " OR ".join(f"contains({_LOW}, '{p}')" for p in spam.FOLLOW_PHRASES) + ")",
}
_RULES_SQL = ", ".join(f"coalesce({sql}, false) AS {name}" for name, sql in _RULE_SQL.items())
_ALL_HOLD = " AND ".join(_RULE_SQL)
VERDICT_SQL = f"""{_FLAT},
ruled AS (SELECT *, {_RULES_SQL} FROM posts_flat),
verdicts AS (SELECT *, NOT ({_ALL_HOLD}) AS "Spam" FROM ruled)"""


def _register_rule(rule: str, key: str) -> None:
    @query(key, f"WITH {VERDICT_SQL} SELECT post_id, {rule} FROM verdicts")
    def _(spark, sf_dir):
        ruled = spam.spam_rules(inputs.posts_flat(spark, sf_dir, *spam.INPUTS), inputs.as_of())
        return ruled.select("post_id", rule)


for _rule, _key in zip(
    spam.RULES,
    [
        "spam_account_age",
        "spam_status_count",
        "spam_followers_ratio",
        "spam_description",
        "spam_hashtag_count",
        "spam_text_length",
        "spam_follow_phrases",
    ],
):
    _register_rule(_rule, _key)


@query("spam_verdict", f'WITH {VERDICT_SQL} SELECT post_id, {", ".join(spam.RULES)}, "Spam" FROM verdicts')
def _(spark, sf_dir):
    verdicts = spam.spam_verdict(inputs.posts_flat(spark, sf_dir, *spam.INPUTS), inputs.as_of())
    return verdicts.select("post_id", *spam.RULES, "Spam")


@query(
    "spam_counts",
    f"""WITH {VERDICT_SQL} SELECT "Spam", count(*) AS posts,
        {", ".join(f"count(*) FILTER (WHERE {r}) AS {r}" for r in spam.RULES)}
        FROM verdicts GROUP BY "Spam" """,
)
def _(spark, sf_dir):
    return spam.spam_counts(spam.spam_verdict(inputs.posts_flat(spark, sf_dir, *spam.INPUTS), inputs.as_of()))


@query(
    "post_json_fields",
    f"""WITH {VERDICT_SQL} SELECT post_id, {", ".join(f'"{f}"' for f in _JSON_FIELDS)}, "Spam"
        FROM verdicts""",
)
def _(spark, sf_dir):
    """The JSON of each post read back, without the ratio: JSON has no infinity."""
    verdicts = spam.spam_verdict(inputs.posts_flat(spark, sf_dir), inputs.as_of())
    flat = verdicts.select("post_id", *_JSON_FIELDS, "Spam")
    schema = flat.drop("post_id").schema
    body = post_ops.posts_to_json(flat, keep=["post_id"])
    return body.select("post_id", F.from_json("value", schema).alias("p")).select("post_id", "p.*")


def _json_value(field: str) -> str:
    """The JSON text of one flat field; JSON has no number for NaN and infinity."""
    name = f'"{field}"'
    if field == "UserFollowersRatio":
        return f"""CASE WHEN isnan({name}) THEN '"NaN"' WHEN isinf({name}) THEN '"Infinity"'
                   ELSE CAST({name} AS VARCHAR) END"""
    return f"coalesce(CAST(to_json({name}) AS VARCHAR), 'null')"


_JSON_SQL = " || ',' || ".join(
    f"""'"{field}":' || {_json_value(field)}""" for field in [*FLAT_FIELDS, "Spam"]
)


@query(
    "post_json",
    f"""WITH {VERDICT_SQL} SELECT post_id, '{{' || {_JSON_SQL} || '}}' AS value FROM verdicts""",
)
def _(spark, sf_dir):
    verdicts = spam.spam_verdict(inputs.posts_flat(spark, sf_dir), inputs.as_of())
    return post_ops.posts_to_json(
        verdicts.select("post_id", *FLAT_FIELDS, "Spam"), keep=["post_id"]
    )
