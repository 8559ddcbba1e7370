import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rookery.functions.values import followers_ratio, format_ts, parse_ts
from rookery.session import scratch_dir
from rookery.sources.access_log import parse_access_log, status_counts
from rookery.sources.lexicon import read_lexicon, word_weights
from rookery.sources.lines import parse_labeled_points, parse_people, parse_vectors
from rookery.sources.posts import CORRUPT, POST_SCHEMA, posts_from_messages, read_posts_json


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def write_text(spark, *values):
    path = scratch_dir(spark, "text")
    lines(spark, *values).coalesce(1).write.text(path)
    return path


def test_people(spark):
    got = parse_people(
        lines(spark, "Ann 31", "Bob 38 x", "x notanumber", "solo", "two  7", "half 3.5", "tab 9\t")
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Ann", 31, False),
        ("Bob", 38, False),
        ("x", None, True),
        ("solo", None, True),
        ("two", None, True),
        ("half", None, True),
        ("tab", 9, False),
    ]


def test_strict_people_fail(spark):
    with pytest.raises(PySparkException, match="not a person: x notanumber"):
        parse_people(lines(spark, "x notanumber"), strict=True).collect()


def test_vectors(spark):
    got = parse_vectors(
        lines(
            spark, "[1.0,2.5]", " [ -1e3 , 0 ] ", "(4,[0,2],[1.5,2.5])", "[]", "[1,x]", "1,2", "",
            "(2,[0],[1,2])",
        )
    ).collect()
    assert [r.features for r in got] == [
        [1.0, 2.5], [-1000.0, 0.0], [1.5, 0.0, 2.5, 0.0], [], None, None, None, None,
    ]


def test_labelled_points(spark):
    got = parse_labeled_points(
        lines(
            spark, "(1.0,[2.0,3.0])", "(2,(3,[1],[5.0]))", "1.5,2.0 3.0", "(x,[1.0])", "(1.0,[y])",
            "nothing",
        )
    ).collect()
    assert [(r.label, r.features) for r in got] == [
        (1.0, [2.0, 3.0]),
        (2.0, [0.0, 5.0, 0.0]),
        (1.5, [2.0, 3.0]),
        (None, None),
        (None, None),
        (None, None),
    ]


def test_strict_points_fail(spark):
    with pytest.raises(PySparkException, match="not a labelled point"):
        parse_labeled_points(lines(spark, "nothing"), strict=True).collect()


def test_followers_ratio(spark):
    df = spark.createDataFrame([(72, 206), (0, 0), (5, 0), (2, 200), (None, 3)], "a int, b int")
    got = [r.r for r in df.select(followers_ratio(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got[0] == 0.34951457381248474
    assert got[1] != got[1]
    assert got[2] == float("inf")
    assert got[3] == 0.009999999776482582
    assert got[4] is None


def test_timestamps_round_trip(spark):
    df = lines(spark, "2024-05-06T07:08:09.123-0400", "no time")
    got = df.select(format_ts(parse_ts(F.col("value"))).alias("t")).collect()
    assert [r.t for r in got] == ["2024-05-06T11:08:09.123+0000", None]


def test_json_lines_that_are_not_json_are_kept(spark):
    path = write_text(spark, '{"post_id": 1, "user": {"name": "Ann"}}', "Map(a -> b)")
    got = read_posts_json(spark, path).select("post_id", "user.name", CORRUPT).collect()
    assert [tuple(r) for r in got] == [(1, "Ann", None), (None, None, "Map(a -> b)")]


def test_a_file_without_any_json_still_reads(spark):
    path = write_text(spark, "Map(a -> b)")
    assert read_posts_json(spark, path).count() == 1
    assert read_posts_json(spark, path).filter(F.col("post_id").isNotNull()).count() == 0


def test_inferred_json(spark):
    path = write_text(spark, '{"user": {"lang": "en"}}', '{"user": {"lang": "de"}}')
    assert sorted(r.lang for r in read_posts_json(spark, path, None).select("user.lang").collect()) == [
        "de", "en",
    ]


def test_posts_from_messages(spark):
    got = posts_from_messages(lines(spark, '{"post_id": 7, "text": "x"}', "nope")).collect()
    assert [(r.post_id, r.text, r[CORRUPT]) for r in got] == [(7, "x", None), (None, None, "nope")]
    assert got[0].__fields__[: len(POST_SCHEMA)] == POST_SCHEMA.fieldNames()


def test_lexicon_counts_repeats_and_drops_blanks(spark):
    good = read_lexicon(spark, write_text(spark, "Good", "good", "", "fine", "odd"))
    bad = read_lexicon(spark, write_text(spark, "bad", "odd"))
    assert {(r.word, r.n) for r in good.collect()} == {("good", 2), ("fine", 1), ("odd", 1)}
    assert {(r.word, r.weight) for r in word_weights(good, bad).collect()} == {
        ("good", 2), ("fine", 1), ("bad", -1),
    }


def test_access_log(spark):
    line = '10.0.0.1 - u1 [06/May/2024:07:08:09 +0000] "GET /a HTTP/1.1" 200 {} "-" "agent x"'
    log = parse_access_log(
        lines(
            spark,
            line.format("12"),
            line.format("-"),
            line.format("7").replace("10.0.0.1", ""),
            "malformed",
            line.format("5").replace("agent x", "bell \u0001 end"),
            "\u0001" * 9,
            line.format("5") + " more",
        )
    ).collect()
    assert [r.parsed for r in log] == [True, True, True, False, True, False, False]
    assert [r.bytes for r in log][:3] == [12, None, 7]
    assert [r.ip for r in log][:3] == ["10.0.0.1", "10.0.0.1", None]
    assert log[0].logged_at.isoformat() == "2024-05-06T07:08:09"
    assert (log[0].client, log[0].user, log[0].request, log[0].status) == (
        "-", "u1", "GET /a HTTP/1.1", 200,
    )
    assert log[4].agent == "bell \u0001 end"
    assert log[3].line == "malformed" and log[3].status is None


def test_status_counts_keep_unreadable_lines(spark):
    counts = status_counts(parse_access_log(lines(spark, "bad", "worse")))
    assert [tuple(r) for r in counts.collect()] == [(None, 2)]
