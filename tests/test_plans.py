"""What the planner makes of the operators, and where scratch data goes."""

import os
import tempfile
import types

import pytest
from pyspark.sql import functions as F

from rookery import session
from rookery.operators import bounds, clusters, posts, rollups, sentiment, spam, tokens
from rookery.operators.clusters import Centres
from rookery.plans import inputs
from rookery.sources.tables import table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.fixture
def texts(spark, sf_dir):
    """Posts straight from the scan, without the deal-out of small files."""
    return inputs.post_texts_from(table(spark, sf_dir, "documents"))


def test_language_filter_reaches_the_scan(texts):
    assert "EqualTo(lang,en)" in plan(posts.lang_filter(texts))


def test_language_counts_do_not_read_the_text(spark, sf_dir):
    scan = plan(rollups.lang_counts(inputs.posts_flat(spark, sf_dir)))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in scan
    assert "TakeOrderedAndProject" in scan and "partial_count" in scan


def test_word_counts_combine_before_the_shuffle(texts):
    counts = tokens.count_words(texts)
    assert "partial_count" in plan(counts) and shuffles(counts) == 1


def test_flattening_and_spam_rules_are_projections(spark, sf_dir):
    verdicts = spam.spam_verdict(inputs.posts_flat(spark, sf_dir), inputs.as_of())
    assert shuffles(verdicts) == 0 and "SortMergeJoin" not in plan(verdicts)


def test_labelling_with_short_lists_is_a_projection(spark, texts):
    labelled = sentiment.labelled_text(texts, inputs.short_weights(spark))
    assert "Exchange" not in plan(labelled) and "Join" not in plan(labelled)


def test_cluster_sums_shuffle_one_row_per_cluster_and_task(spark, sf_dir):
    sums = clusters.cluster_sums(
        inputs.cluster_points(spark, sf_dir), Centres.of(inputs.START_CENTRES)
    )
    assert "partial_sum" in plan(sums) and shuffles(sums) == 1


def test_sentiment_counts_shuffle_three_rows(spark, texts):
    counts = sentiment.sentiment_counts(
        sentiment.lexicon_sentiment(texts, inputs.short_weights(spark))
    )
    assert "partial_count" in plan(counts) and shuffles(counts) == 1


def test_only_small_scans_are_dealt_out(spark):
    cores = spark.sparkContext.defaultParallelism
    small, large = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, cores)
    assert bounds.spread(small).rdd.getNumPartitions() == cores
    assert "Exchange" not in plan(bounds.spread(large))
    assert bounds.spread(small).agg(F.sum("id")).first()[0] == 4950


def test_a_shuffled_frame_is_not_run_to_count_its_tasks(spark):
    fails = F.raise_error(F.lit("this frame was run"))
    counts = spark.range(10).groupBy((F.col("id") % 2).alias("g")).agg(F.count(fails).alias("n"))
    assert bounds.spread(counts) is counts


def test_spam_verdicts_have_the_recorded_counts(spark):
    verdicts = spam.spam_verdict(
        inputs.posts_flat(spark, "/root/testdata/sf0.01"), inputs.as_of()
    )
    got = verdicts.agg(
        *[F.count_if(F.col(r)).alias(r) for r in spam.RULES],
        F.count_if(~F.col("Spam")).alias("kept"),
        F.count_if(F.isnan("UserFollowersRatio")).alias("nan"),
        F.sum("TextLength").alias("units"),
    ).first()
    assert tuple(got) == (832, 573, 802, 598, 750, 996, 750, 107, 12, 2_418_620)


def fake_session(master, shared=None):
    return types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda key, default: shared or default),
        sparkContext=types.SimpleNamespace(master=master),
    )


def test_scratch_data_goes_to_the_shared_folder():
    cluster = fake_session("spark://host:7077", "hdfs://shared/checkpoints/")
    first, second = (session.scratch_dir(cluster, "x") for _ in range(2))
    assert first.startswith("hdfs://shared/checkpoints/x-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(fake_session("yarn"), "x")


def test_a_folder_of_one_machine_is_refused_on_a_cluster(tmp_path):
    own = f"file:{tempfile.gettempdir()}/checkpoints"
    with pytest.raises(ValueError, match="local to one machine"):
        session.scratch_dir(fake_session("spark://host:7077", own), "x")
    # A mounted folder and a path of the cluster's own file system are taken on trust.
    for shared in ("file:///mnt/shared", "/user/me/checkpoints"):
        assert session.scratch_dir(fake_session("spark://host:7077", shared), "x").startswith(shared)


def test_scratch_data_can_be_dropped(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "_MADE", [])
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    path, unused = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "y")
    spark.range(3).write.parquet(path)
    assert session.drop_scratch(spark) == 1 and not os.path.exists(path) and not session._MADE
    assert not os.path.exists(unused)


def test_flat_fields_read_nations_for_the_location_alone(spark, sf_dir):
    assert "Join" not in plan(rollups.lang_counts(inputs.posts_flat(spark, sf_dir, "UserLang")))
    assert "Join" in plan(rollups.location_counts(inputs.posts_flat(spark, sf_dir, "UserLocation")))


def test_a_local_master_may_use_a_temporary_folder():
    assert session.scratch_dir(fake_session("local[2]"), "x")
