import datetime as dt
import json

from pyspark.sql import functions as F

from rookery.operators import posts as post_ops
from rookery.operators import rollups, spam
from rookery.sources.posts import POST_SCHEMA

NOON = dt.datetime(2024, 1, 10, 12)


def post(post_id=1, text="a text that is long enough to pass", **user):
    fields = {
        "id": 1,
        "name": "Ann",
        "screen_name": "ann",
        "description": "a description that is long enough",
        "lang": "en",
        "location": "Here",
        "verified": True,
        "friends_count": 10,
        "followers_count": 10,
        "favourites_count": 3,
        "statuses_count": 51,
        "created_at": NOON - dt.timedelta(days=400),
    } | user
    return (post_id, NOON, "en", text, None, tuple(fields.values()))


def flat(spark, *rows):
    posts = spark.createDataFrame(list(rows), POST_SCHEMA)
    return post_ops.flatten_posts(posts, keep=["post_id"])


def failed(spark, row):
    """Names of the rules the post breaks."""
    ruled = spam.spam_verdict(flat(spark, row), F.lit(NOON)).first()
    broken = {r for r in spam.RULES if not ruled[r]}
    assert ruled.Spam == bool(broken)
    return broken


def test_flat_fields_in_order_and_missing_geo(spark):
    row = flat(spark, post(text="see #a and #B! 👉"))
    assert row.columns == ["post_id", *post_ops.FLAT_FIELDS]
    got = row.first()
    assert (got.GeoLatitude, got.GeoLongitude) == (None, None)
    assert (got.TextLength, got.HashTags) == (17, "#a #B!")
    assert got.StatusCreatedAt == "2024-01-10T12:00:00.000+0000"


def test_a_good_post_is_not_spam(spark):
    assert failed(spark, post()) == set()


def test_account_age_needs_two_full_days(spark):
    almost = NOON - dt.timedelta(days=2) + dt.timedelta(milliseconds=1)
    assert failed(spark, post(created_at=almost)) == {"account_age_ok"}
    assert failed(spark, post(created_at=NOON - dt.timedelta(days=2))) == set()
    assert failed(spark, post(created_at=None)) == {"account_age_ok"}


def test_statuses(spark):
    assert failed(spark, post(statuses_count=50)) == {"status_count_ok"}


def test_ratio(spark):
    rule = {"followers_ratio_ok"}
    assert failed(spark, post(followers_count=0, friends_count=0)) == rule
    assert failed(spark, post(followers_count=5, friends_count=0)) == set()
    assert failed(spark, post(followers_count=2, friends_count=200)) == rule
    assert failed(spark, post(followers_count=3, friends_count=200)) == set()


def test_description(spark):
    assert failed(spark, post(description="x" * 20)) == {"description_ok"}
    assert failed(spark, post(description="x" * 21)) == set()
    assert failed(spark, post(description=None)) == {"description_ok"}


def test_hashtags(spark):
    tail = " and some more text"
    assert failed(spark, post(text="#a #b #c #d" + tail)) == set()
    assert failed(spark, post(text="#a #b #c #d #" + tail)) == {"hashtag_count_ok"}
    assert failed(spark, post(text="#a#b#c#d#e#f" + tail)) == set()


def test_text_length(spark):
    assert failed(spark, post(text="x" * 20)) == {"text_length_ok"}
    assert failed(spark, post(text="x" * 21)) == set()
    assert failed(spark, post(text="👉" * 11)) == set()


def test_follow_phrases_are_plain_text(spark):
    for phrase in spam.FOLLOW_PHRASES:
        assert failed(spark, post(text=f"please {phrase.upper()} this account")) == {
            "no_follow_phrase"
        }
    assert failed(spark, post(text="please rtt follow this account")) == set()


def test_spam_counts(spark):
    verdicts = spam.spam_verdict(flat(spark, post(1), post(2, text="short")), F.lit(NOON))
    got = {r.Spam: (r.posts, r.text_length_ok) for r in spam.spam_counts(verdicts).collect()}
    assert got == {False: (1, 1), True: (1, 0)}


def test_json_keeps_null_fields(spark):
    body = post_ops.posts_to_json(flat(spark, post(location=None)), keep=["post_id"])
    read = json.loads(body.first().value)
    assert list(read) == post_ops.FLAT_FIELDS
    assert read["UserLocation"] is None and read["UserFollowersRatio"] == 1.0


def test_labels_and_maps(spark):
    people = spark.createDataFrame([("Ann", 31)], "name string, age int")
    assert post_ops.label_rows(people).first().label == "Name: Ann"
    assert post_ops.rows_as_map(people, ["name", "age"]).first().row == {"name": "Ann", "age": "31"}


def test_rollups(spark):
    df = flat(
        spark,
        post(1, name="Ann", friends_count=5, location=None),
        post(2, name="Ann", friends_count=5, location=None),
        post(3, name="Bob", friends_count=9, verified=False),
        post(4, name="Bob", friends_count=9, lang="de"),
    )
    assert [tuple(r) for r in rollups.lang_counts(df).collect()] == [("en", 3), ("de", 1)]
    assert [tuple(r) for r in rollups.location_counts(df).collect()] == [("Here", 2), (None, 2)]
    assert [tuple(r) for r in rollups.top_friends(df, 2).collect()] == [
        ("Bob", 9, "de"), ("Bob", 9, "en"),
    ]
    assert {tuple(r) for r in rollups.verified_users(df).collect()} == {
        ("Ann", True), ("Bob", True), ("Bob", False),
    }
    assert [r.UserName for r in rollups.posts_in_language(df, "en", 3).collect()] == [
        "Ann", "Ann", "Bob",
    ]


def test_top_k_plans_need_no_full_sort(spark):
    plan = rollups.location_counts(flat(spark, post()))._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan
