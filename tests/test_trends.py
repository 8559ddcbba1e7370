import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rookery.operators import bounds, trends

START = dt.datetime(2024, 1, 1)


def posts(spark, seconds_and_texts):
    rows = [(START + dt.timedelta(seconds=s), t) for s, t in seconds_and_texts]
    return spark.createDataFrame(rows, "ts timestamp, text string")


def by_hand(seconds_and_texts, window, slide):
    base = int(START.replace(tzinfo=dt.timezone.utc).timestamp())
    counts = {}
    for s, text in seconds_and_texts:
        second = base + int(s // 1)
        last = second - second % slide
        for start in range(last - window + slide, last + slide, slide):
            for tag in text.split(" "):
                if tag.startswith("#"):
                    counts[start, tag] = counts.get((start, tag), 0) + 1
    return counts


def collected(counts):
    rows = counts.select(F.unix_timestamp("window_start").alias("s"), "tag", "count").collect()
    got = {(r.s, r.tag): r["count"] for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("window, slide", [(300, 1), (60, 20), (10, 10)])
def test_windows_match_counting_by_hand(spark, window, slide):
    rng = random.Random(7)
    # "#hot" is a third of all tags; the span covers several stretches of time.
    data = [
        (rng.uniform(-50, 6000), " ".join(rng.choice(["#hot", "#a", f"#r{i % 40}", "x"]) for _ in range(3)))
        for i in range(300)
    ]
    got = collected(trends.hashtag_window_counts(posts(spark, data), window, slide))
    assert got == by_hand(data, window, slide)


def test_windows_match_the_built_in_window(spark):
    data = [(i * 7.5, f"#t{i % 5} #hot") for i in range(200)]
    df = posts(spark, data)
    built_in = (
        df.select("ts", F.explode(F.split("text", " ")).alias("tag"))
        .groupBy(F.window("ts", "60 seconds", "20 seconds").alias("w"), "tag")
        .count()
        .select(F.col("w.start").alias("window_start"), "tag", "count")
    )
    assert collected(trends.hashtag_window_counts(df, 60, 20)) == collected(built_in)


def test_window_must_be_a_multiple_of_the_slide(spark):
    with pytest.raises(ValueError):
        trends.hashtag_window_counts(posts(spark, []), 10, 3)


def test_sliding_sum_shuffles_counts_not_expanded_windows(spark):
    plan = trends.hashtag_window_counts(posts(spark, [(0, "#a")]))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("threshold", ["1000", "1"], ids=["planner limit", "salted"])
def test_top_tags_per_window(spark, threshold):
    conf = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(conf, threshold)
    try:
        data = [(0, "#a #a #b #c"), (0, "#c #d"), (500, "#z")]
        counts = trends.hashtag_window_counts(posts(spark, data), 10, 10)
        top = trends.top_hashtags_per_window(counts, 2).collect()
    finally:
        spark.conf.unset(conf)
    got = sorted((r.window_start, r["rank"], r.tag, r["count"]) for r in top)
    assert got == [
        (START, 1, "#a", 2),
        (START, 2, "#c", 2),
        (START + dt.timedelta(seconds=500), 1, "#z", 1),
    ]


def test_group_limit_is_planned_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id")
    top = bounds.top_per_group(df, ["g"], [F.asc("id")], 3, spread_by="id")
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in top.collect()) == [0, 1, 2, 3, 4, 5]
