import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from rookery.operators import trends
from rookery.operators.clusters import Centres, kmeans_update
from rookery.operators.posts import lang_filter
from rookery.operators.regression import LinearState, linreg_update
from rookery.plans import inputs
from rookery.session import scratch_dir
from rookery.sources.lines import parse_labeled_points, parse_vectors, read_line_stream
from rookery.sources.posts import POST_SCHEMA, read_post_stream
from rookery.sources import tables
from rookery.sources.tables import replay_table, table
from rookery.streaming import online
from rookery.streaming import trends as stream_trends
from rookery.streaming.batches import (
    BatchWriter,
    StateTable,
    drain,
    for_each_batch,
    every,
    kept,
    preview_batches,
    read_previews,
    reads_kept_rows,
    run_batches,
    run_until,
    waited,
    write_batches,
    write_previews,
)
from rookery.streaming.classify import RESULT_SCHEMA, train_per_batch


def land(spark, path, values):
    """One more file of lines."""
    df = spark.createDataFrame([(v,) for v in values], "value string")
    df.coalesce(1).write.mode("append").text(path)


@pytest.fixture
def base(spark):
    return scratch_dir(spark, "stream")


def test_batches_go_to_their_own_folders_and_a_restart_goes_on(spark, base):
    def run():
        stream = read_line_stream(spark, f"{base}/in", max_files=1)
        drain(write_batches(stream, BatchWriter(f"{base}/out", "posts"), f"{base}/checkpoint"))

    land(spark, f"{base}/in", ["a", "b"])
    land(spark, f"{base}/in", ["c"])
    run()
    run()
    land(spark, f"{base}/in", ["d"])
    run()
    folders = sorted(f for f in os.listdir(f"{base}/out") if f.startswith("posts_"))
    assert folders == ["posts_0", "posts_1", "posts_2"]
    assert sorted(r.value for r in spark.read.text(f"{base}/out/posts_*").collect()) == list("abcd")


def test_empty_batches_are_skipped_and_replays_overwrite(spark, base):
    writer = BatchWriter(f"{base}/out", "posts", files_per_batch=1, budget=100)
    rows = spark.createDataFrame([("a",), ("b",)], "value string").repartition(2)
    writer(rows, 0)
    writer(rows.limit(0), 1)
    writer(rows, 0)
    assert writer.total == 2
    assert os.listdir(f"{base}/out").count("posts_1") == 0
    assert spark.read.text(f"{base}/out/posts_*").count() == 2
    parts = [f for f in os.listdir(f"{base}/out/posts_0") if f.startswith("part")]
    assert len(parts) == 1


def test_row_budget_keeps_whole_batches_and_is_remembered(spark, base):
    for part in range(5):
        land(spark, f"{base}/in", [f"{part}-{i}" for i in range(40)])

    def run(budget):
        stream = read_line_stream(spark, f"{base}/in", max_files=1)
        return run_until(stream, f"{base}/out", "posts", f"{base}/checkpoint", budget=budget)

    assert run(100) == 120
    assert spark.read.text(f"{base}/out/posts_*").count() == 120
    # The budget is used up, so nothing more is taken; a larger one goes on where it stopped.
    assert run(100) == 120
    assert run(1000) == 200
    assert spark.read.text(f"{base}/out/posts_*").distinct().count() == 200


def test_a_timed_trigger_stops_at_the_budget(spark, base):
    land(spark, f"{base}/in", [str(i) for i in range(30)])
    stream = read_line_stream(spark, f"{base}/in")
    total = run_until(
        stream, f"{base}/out", "posts", f"{base}/checkpoint", budget=10, trigger=every(1)
    )
    assert total == 30


def test_preview_of_each_batch(spark, base):
    land(spark, f"{base}/in", ["c", "a", "b"])
    seen = {}
    stream = read_line_stream(spark, f"{base}/in")
    drain(
        preview_batches(
            stream, 2, ["value"], lambda i, rows: seen.update({i: [r.value for r in rows]}),
            f"{base}/checkpoint",
        )
    )
    assert seen == {0: ["a", "b"]}


def test_previews_are_kept_by_batch_and_replays_overwrite(spark, base):
    for lines in (["c", "a", "b"], ["z", "y"], []):
        land(spark, f"{base}/in", lines)
        stream = read_line_stream(spark, f"{base}/in")
        drain(write_previews(stream, 2, ["value"], f"{base}/out", f"{base}/checkpoint"))
    rows = lambda: {(r.batch_id, r.place, r.value) for r in read_previews(spark, f"{base}/out").collect()}
    want = {(0, 1, "a"), (0, 2, "b"), (1, 1, "y"), (1, 2, "z")}
    assert rows() == want
    # A batch that is not committed is done again, into its own folder.
    for log in ("commits", "offsets"):
        last = sorted(int(f) for f in os.listdir(f"{base}/checkpoint/{log}") if f.isdigit())[-1]
        assert last >= 1
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{base}/checkpoint/commits/{name}")
    drain(write_previews(read_line_stream(spark, f"{base}/in"), 2, ["value"], f"{base}/out", f"{base}/checkpoint"))
    assert rows() == want


def test_a_timed_trigger_spaces_its_batches(spark, base):
    for lines in (["a"], ["b", "c"], ["d"]):
        land(spark, f"{base}/in", lines)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{base}/in")
    writer = BatchWriter(f"{base}/out", "b", reuse=True)
    report = run_batches(write_batches(stream, writer, f"{base}/checkpoint", every(2)), 3)
    rows = report.withColumn("waited", waited(2)).orderBy("batch_id").collect()
    assert [(r.rows, r.waited) for r in rows] == [(1, True), (2, True), (1, True)]
    # Batches that follow each other without a pause have not waited.
    early = report.withColumn("started", F.timestamp_millis(F.lit(1000) + F.col("batch_id")))
    assert [r.w for r in early.orderBy("batch_id").select(waited(2).alias("w")).collect()] == [True, False, False]


def test_parts_land_as_several_files_each_and_stream_one_per_batch(spark, base, monkeypatch):
    monkeypatch.setattr(tables, "LANDED_BYTES", 10)
    rows = spark.range(0, 40, 1, 4)
    # Rows in all tasks, in one task only, in none, and in two.
    cut = ["id % 2 = 0", "id < 5", "id < 0", "id % 2 = 1 and id > 20"]
    stream = tables.land_in_turn([rows.filter(c) for c in cut], f"{base}/in", 31)
    assert len(spark.read.parquet(f"{base}/in").inputFiles()) == 16
    seen = {}
    drain(for_each_batch(stream, lambda b, i: seen.update({i: sorted(r.id for r in b.collect())}), f"{base}/checkpoint"))
    assert seen == {i: [r.id for r in rows.filter(c).orderBy("id").collect()] for i, c in enumerate(cut)}


def test_no_task_reads_a_whole_table_to_land_it(spark, base, sf_dir, monkeypatch):
    monkeypatch.setattr(tables, "LANDED_BYTES", tables.table_bytes(spark, sf_dir, "documents") // 4)
    docs = table(spark, sf_dir, "documents").repartition(8)
    tables.land_in_turn([docs], f"{base}/in", tables.table_bytes(spark, sf_dir, "documents"))
    counts = spark.read.parquet(f"{base}/in").groupBy(F.input_file_name()).count().collect()
    assert len(counts) >= 4 and max(r["count"] for r in counts) < docs.count() / 2


def test_kept_rows_are_read_by_all_and_released(spark):
    frame = spark.range(10).withColumn("x", F.rand())
    with pytest.raises(RuntimeError), kept(frame) as rows:
        assert reads_kept_rows(rows) and reads_kept_rows(rows.groupBy("id").count())
        assert not reads_kept_rows(rows.join(spark.range(3), "id"))
        assert rows.agg(F.sum("x")).first() == rows.agg(F.sum("x")).first()
        raise RuntimeError
    assert not frame.storageLevel.useMemory and not reads_kept_rows(frame)


def test_batches_too_small_for_the_folds_are_trained_but_not_tuned(spark, base):
    schema = "id long, text string, label double"
    words = {0.0: "grey dull slow", 1.0: "bright quick kind"}
    enough = [(i, words[i % 2 * 1.0], i % 2 * 1.0) for i in range(60)]
    # One training row of the second class: without its fold there is only the first class.
    ids = [i for i in range(100, 400) if classify_bucket(i, 12345, 100) < 60]
    few = [(i, words[0.0], 0.0) for i in ids[:6]] + [(ids[6], words[1.0], 1.0)]
    few += [(i, words[0.0], 0.0) for i in range(100, 140) if classify_bucket(i, 12345, 100) >= 60]
    for rows in (enough, few):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        drain(train_per_batch(stream, f"{base}/out", f"{base}/checkpoint", "id", with_tuning=True))
    got = spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out/batch_*").orderBy("batch_id").collect()
    assert [(r.batch_id, r.status, r.tuned_f1) for r in got] == [(0, "tuned", 1.0), (1, "untuned", None)]
    assert got[1].f1 is not None


def classify_bucket(i, seed, buckets):
    return int(hashlib.md5(f"{i}-{seed}".encode()).hexdigest()[:8], 16) % buckets


def test_post_stream_and_language_filter(spark, sf_dir, base):
    inputs.posts(spark, sf_dir).write.json(f"{base}/in")
    stream = lang_filter(read_post_stream(spark, f"{base}/in", POST_SCHEMA), "en")
    writer = BatchWriter(f"{base}/out", "b", "parquet")
    drain(write_batches(stream.select("post_id", "user.name"), writer, f"{base}/checkpoint"))
    batch = lang_filter(inputs.posts(spark, sf_dir), "en").select("post_id", "user.name")
    got = spark.read.parquet(f"{base}/out/b_*")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_state_table_ring(spark, base):
    table = StateTable(f"{base}/state", LinearState.zeros().to_df(spark).schema, keep=3)
    assert table.newest(spark) is None
    for b in range(5):
        table.save(LinearState((float(b),), 0.0, b).to_df(spark), b)
    fresh = StateTable(table.path, table.schema, keep=3)
    assert fresh.newest(spark).first().weights == [4.0]
    assert fresh.newest(spark, before=4).first().weights == [3.0]
    fresh.save(LinearState((40.0,), 0.0, 4).to_df(spark), 4)
    again = StateTable(table.path, table.schema, keep=3)
    assert again.newest(spark).first().weights == [40.0]
    assert again.newest(spark, before=4).first().weights == [3.0]
    assert len([f for f in os.listdir(table.path) if f.startswith("slot=")]) == 3


def test_kmeans_stream_equals_steps_by_hand_across_a_restart(spark, base):
    batches = [["[1.0,1.0]", "[2.0,2.0]", "[9.0,9.0]"], ["[1.5,1.0]", "[8.0,9.0]"], ["[8.5,8.5]"]]
    start = Centres.of([[0.0, 0.0], [10.0, 10.0]])
    by_hand = start
    for lines in batches:
        land(spark, f"{base}/in", lines)
        points = parse_vectors(read_line_stream(spark, f"{base}/in"))
        drain(online.train_kmeans(points, f"{base}/state", f"{base}/checkpoint", start, decay=0.9))
        df = parse_vectors(spark.createDataFrame([(v,) for v in lines], "value string"))
        by_hand = kmeans_update(by_hand, df, decay=0.9)
    got = Centres.from_df(online.centre_table(f"{base}/state").newest(spark))
    assert (got.centres, got.weights, got.batch_id) == (by_hand.centres, by_hand.weights, 2)

    land(spark, f"{base}/test", ["(3.0,[1.0,1.0])", "(4.0,[9.0,8.0])"])
    test = parse_labeled_points(read_line_stream(spark, f"{base}/test"))
    drain(online.predict_kmeans(test, f"{base}/state", f"{base}/out", "p", f"{base}/c2"))
    rows = spark.read.parquet(f"{base}/out/p_*").collect()
    assert {(r.label, r.cluster) for r in rows} == {(3.0, 0), (4.0, 1)}


def test_a_replayed_batch_does_not_apply_twice(spark, base):
    table = online.centre_table(f"{base}/state")
    start = Centres.of([[0.0], [10.0]])
    points = spark.createDataFrame([([1.0],), ([9.0],)], "features array<double>")
    for batch_id in (0, 1, 1):
        trainer = online._Trainer(table, start, lambda s, b: kmeans_update(s, b))
        trainer(points, batch_id)
    assert Centres.from_df(table.newest(spark)).weights == (2.0, 2.0)


def test_linreg_stream_equals_steps_by_hand(spark, base):
    batches = [["(1.0,[0.5])", "(-1.0,[-0.5])"], ["(0.9,[0.4])", "(0.1,[0.0])"]]
    by_hand = LinearState.zeros()
    for lines in batches:
        land(spark, f"{base}/in", lines)
        points = parse_labeled_points(read_line_stream(spark, f"{base}/in"))
        drain(online.train_linreg(points, f"{base}/state", f"{base}/checkpoint"))
        df = parse_labeled_points(spark.createDataFrame([(v,) for v in lines], "value string"))
        by_hand = linreg_update(by_hand, df)
    got = LinearState.from_df(online.weight_table(f"{base}/state").newest(spark))
    assert (got.weights, got.intercept) == (by_hand.weights, by_hand.intercept)

    test = parse_labeled_points(read_line_stream(spark, f"{base}/in"))
    drain(online.predict_linreg(test, f"{base}/state", f"{base}/out", "p", f"{base}/c2"))
    assert spark.read.parquet(f"{base}/out/p_*").count() == 4


# --- windows ---------------------------------------------------------------------------------

START = dt.datetime(2024, 1, 1)


def tagged(spark, seconds):
    rows = [(START + dt.timedelta(seconds=s), f"#t{s % 3} #hot") for s in seconds]
    return spark.createDataFrame(rows, "ts timestamp, text string")


def rows_of(counts):
    rows = counts.select("window_end", "tag", "count").collect()
    got = {(r.window_end, r.tag): r["count"] for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("window, slide, hop", [(60, 5, 15), (60, 20, 20), (70, 10, 10), (20, 20, 20)])
def test_windows_closed_over_many_batches_equal_the_batch_result(spark, base, window, slide, hop):
    assert stream_trends.hop_seconds(window, slide) == hop
    spans = [range(0, 40), range(35, 60), range(200, 260, 7), [261], range(900, 960, 3), [1002]]
    for span in spans:
        tagged(spark, span).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("ts timestamp, text string").parquet(f"{base}/in")
        query = stream_trends.write_window_counts(
            stream, f"{base}/out", "w", f"{base}/checkpoint", window_s=window, slide_s=slide, lateness_s=30
        )
        drain(query)
        assert stream_trends.late_rows(query) == 0
    got = rows_of(spark.read.parquet(f"{base}/out/w_*"))
    everything = tagged(spark, [s for span in spans for s in span])
    want = rows_of(trends.hashtag_window_counts(everything, window, slide))

    def stretch_end(end):
        start = int((end - START).total_seconds()) - window + 86400
        return -(-start // hop) * hop + window - 86400

    # The watermark stands 30 s behind the last post.
    assert got == {k: v for k, v in want.items() if stretch_end(k[0]) <= 1002 - 30}
    assert len(got) > 20 and len(got) < len(want)


def test_late_posts_do_not_change_closed_windows(spark, base):
    for i, span in enumerate([range(0, 200), [5, 6, 190]]):
        tagged(spark, span).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("ts timestamp, text string").parquet(f"{base}/in")
        query = stream_trends.write_top_hashtags(
            stream, f"{base}/out", "w", f"{base}/checkpoint", k=1, window_s=60, slide_s=5, lateness_s=30
        )
        drain(query)
        assert (stream_trends.late_rows(query) > 0) == (i == 1)
    top = spark.read.parquet(f"{base}/out/w_*").collect()
    assert {r.tag for r in top} == {"#hot"} and len(top) == len({r.window_end for r in top})
    counts = {int((r.window_end - START).total_seconds()): r["count"] for r in top}
    assert counts[60] == 60 and counts[5] == 5


def test_direct_windows_in_complete_mode_equal_the_batch_result(spark, base):
    tagged(spark, range(0, 100, 3)).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("ts timestamp, text string").parquet(f"{base}/in")
    counts = stream_trends.hashtag_windows_direct(stream, 60, 5)
    writer = BatchWriter(f"{base}/out", "w", "parquet", reuse=True)
    drain(write_batches(counts, writer, f"{base}/checkpoint", output_mode="complete"))
    last = sorted(os.listdir(f"{base}/out"))[-1]
    want = trends.hashtag_window_counts(tagged(spark, range(0, 100, 3)), 60, 5)
    assert rows_of(spark.read.parquet(f"{base}/out/{last}")) == rows_of(want)


def test_windows_from_the_slide_table(spark, base):
    tagged(spark, range(0, 100, 3)).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("ts timestamp, text string").parquet(f"{base}/in")
    drain(stream_trends.write_slide_counts(stream, f"{base}/slides", f"{base}/checkpoint", 5, 0))
    got = rows_of(stream_trends.hashtag_windows_from_slides(spark, f"{base}/slides", 60, 5))
    # The slide of the last post is still open.
    want = rows_of(trends.hashtag_window_counts(tagged(spark, range(0, 95, 3)), 60, 5))
    assert got == want


# --- classifier per batch --------------------------------------------------------------------


def test_batches_without_two_classes_are_recorded_as_skipped(spark, base):
    schema = "id long, text string, label double"
    words = {0.0: "grey dull slow", 1.0: "bright quick kind"}
    both = [(i, words[i % 2 * 1.0], i % 2 * 1.0) for i in range(60)]
    one = [(i, "same", 1.0) for i in range(60, 90)]
    for rows in (both, one):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        drain(train_per_batch(stream, f"{base}/out", f"{base}/checkpoint", "id"))
    got = spark.read.schema(RESULT_SCHEMA).parquet(f"{base}/out/batch_*").orderBy("batch_id").collect()
    assert [(r.batch_id, r.status, r.f1) for r in got] == [(0, "trained", 1.0), (1, "skipped", None)]
    assert got[0].train + got[0].test == 60



def test_a_table_replays_from_one_file_and_from_a_folder(spark, sf_dir, base):
    one_file = table(spark, sf_dir, "events")
    one_file.repartition(3).write.parquet(f"{base}/tables/events.parquet")
    for i, folder in enumerate((sf_dir, f"{base}/tables")):
        stream = replay_table(spark, folder, "events")
        writer = BatchWriter(f"{base}/out{i}", "b", "parquet")
        drain(write_batches(stream, writer, f"{base}/checkpoint{i}"))
        assert spark.read.parquet(f"{base}/out{i}/b_*").exceptAll(one_file).isEmpty()
        assert spark.read.parquet(f"{base}/out{i}/b_*").count() == one_file.count()


def test_unreadable_lines_of_a_post_stream_are_kept(spark, base):
    land(spark, f"{base}/in", ['{"post_id": 1, "text": "x"}', "nope"])
    stream = read_post_stream(spark, f"{base}/in").select("post_id", "_corrupt_record")
    writer = BatchWriter(f"{base}/out", "b", "parquet")
    drain(write_batches(stream, writer, f"{base}/checkpoint"))
    rows = {tuple(r) for r in spark.read.parquet(f"{base}/out/b_*").collect()}
    assert rows == {(1, None), (None, "nope")}
