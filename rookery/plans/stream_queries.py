"""Replayed streams and sliding windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.operators import trends
from rookery.operators.posts import lang_filter, track_filter
from rookery.plans import inputs, post_queries  # noqa: F401
from rookery.plans.registry import ORACLES, query
from rookery.session import scratch_dir
from rookery.sources.tables import land_in_turn, replay_table, table, table_bytes
from rookery.streaming import trends as stream_trends
from rookery.streaming.batches import (
    BATCH_SECONDS,
    BatchWriter,
    count_and_write,
    drain,
    every,
    read_previews,
    reads_kept_rows,
    run_batches,
    run_until,
    waited,
    write_batches,
    write_previews,
)


def _written(spark, stream, fmt="parquet", schema=None, **options):
    """Drain a stream into batch folders and read them back."""
    base = scratch_dir(spark, "stream")
    writer = BatchWriter(f"{base}/out", "batch", fmt, **options)
    drain(write_batches(stream, writer, f"{base}/checkpoint"))
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.format(fmt).load(writer.batches_path)


@query("stream_scan", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf_dir):
    events = replay_table(spark, sf_dir, "events")
    return _written(spark, events.select("event_id", "user_id", "event_type", "value"))


@query(
    "stream_batch_sink",
    f"""WITH {inputs.POST_TEXTS_SQL}
        SELECT unnest(string_split(text, chr(10))) AS value FROM post_texts""",
)
def _(spark, sf_dir):
    return _written(spark, inputs.post_text_stream(spark, sf_dir).select("text"), "text")


@query(
    "stream_lang_filter",
    f"WITH {inputs.POST_TEXTS_SQL} SELECT post_id, text FROM post_texts WHERE lang = 'en'",
)
def _(spark, sf_dir):
    stream = lang_filter(inputs.post_text_stream(spark, sf_dir), "en")
    return _written(spark, stream.select("post_id", "text"))


@query("stream_track_filter", ORACLES["track_filter"])
def _(spark, sf_dir):
    stream = track_filter(inputs.post_text_stream(spark, sf_dir), inputs.TRACK_PHRASES)
    return _written(spark, stream.select("post_id"), reuse=True)


@query(
    "stream_row_budget",
    """SELECT count(*) AS kept, count(DISTINCT event_id) AS distinct_kept, true AS stopped_in_time
       FROM (SELECT event_id, event_id % 16 AS part FROM events) e
       WHERE part < (SELECT coalesce(min(part), 15) + 1 FROM (
         SELECT part, sum(count(*)) OVER (ORDER BY part) AS upto
         FROM (SELECT event_id % 16 AS part FROM events) GROUP BY part) WHERE upto > 1000)""",
)
def _(spark, sf_dir):
    """What a collector keeps that stops after more than 1000 rows.

    The rows land in 16 parts in order, one per batch: it keeps those of the first batches up to the
    one that passes the budget, and had at most the budget before that one.
    """
    base = scratch_dir(spark, "budget")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id")
    parts = [rows.filter(F.col("event_id") % 16 == part) for part in range(16)]
    stream = land_in_turn(parts, f"{base}/in", table_bytes(spark, sf_dir, "events"))
    run_until(stream, f"{base}/out", "batch", f"{base}/checkpoint", budget=1000, fmt="parquet")
    kept = spark.read.parquet(f"{base}/out/batch_*")
    n = F.count(F.lit(1))
    last = kept.groupBy((F.col("event_id") % 16).alias("part")).agg(n.alias("n"))
    before = last.agg((F.sum("n") - F.max_by("n", "part")).alias("before"))
    return kept.agg(n.alias("kept"), F.count_distinct("event_id").alias("distinct_kept")).join(
        F.broadcast(before)
    ).select("kept", "distinct_kept", (F.col("before") <= 1000).alias("stopped_in_time"))


_PARTS_SQL = f"{inputs.POST_TEXTS_SQL}, parts AS (SELECT *, CAST(epoch(ts) AS BIGINT) % 7200 // 1800 AS part FROM post_texts)"


def _landed_parts(spark, sf_dir, base):
    """The posts in four parts, landed one after the other, and a stream that takes one per batch."""
    posts = inputs.post_texts_from(table(spark, sf_dir, "documents"))
    parts = [posts.filter(F.expr("(unix_timestamp(ts) % 7200) div 1800") == part) for part in range(4)]
    return land_in_turn(parts, f"{base}/in", table_bytes(spark, sf_dir, "documents"))


@query(
    "stream_preview",
    f"""WITH {_PARTS_SQL}
        SELECT CAST(part AS INTEGER) AS batch_id, post_id, lang, CAST(place AS INTEGER) AS place FROM (
          SELECT *, row_number() OVER (PARTITION BY part ORDER BY post_id) AS place FROM parts) WHERE place <= 10""",
)
def _(spark, sf_dir):
    """The first rows of each batch of a stream."""
    base = scratch_dir(spark, "preview")
    stream = _landed_parts(spark, sf_dir, base).select("post_id", "lang")
    drain(write_previews(stream, 10, ["post_id"], f"{base}/out", f"{base}/checkpoint"))
    return read_previews(spark, f"{base}/out")


@query(
    "stream_interval",
    f"""WITH {_PARTS_SQL}
        SELECT part AS batch_id, count(*) AS rows, true AS in_time FROM parts GROUP BY part""",
)
def _(spark, sf_dir):
    """Batches of a timed trigger: their rows, and whether each waited for the next whole interval."""
    base = scratch_dir(spark, "interval")
    stream = _landed_parts(spark, sf_dir, base)
    # Kept, as rows that are read twice are reported twice.
    writer = BatchWriter(f"{base}/out", "batch", "parquet", reuse=True)
    report = run_batches(write_batches(stream, writer, f"{base}/checkpoint", every(BATCH_SECONDS)), 4)
    return report.select("batch_id", "rows", waited(BATCH_SECONDS).alias("in_time"))


@query(
    "stream_reuse",
    f"""WITH {_PARTS_SQL}
        SELECT part AS batch_id, lang, count(*) AS posts, true AS kept, true AS released
        FROM parts GROUP BY part, lang""",
)
def _(spark, sf_dir):
    """Counts made from the kept rows of each batch; that they are read from there, and released."""
    base = scratch_dir(spark, "reuse")
    seen = []

    def by_lang(rows):
        counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("posts"))
        seen.append((rows, reads_kept_rows(rows) and reads_kept_rows(counts)))
        return counts.withColumn("kept", F.lit(seen[-1][1]))

    stream = _landed_parts(spark, sf_dir, base)
    drain(count_and_write(stream, f"{base}/out", f"{base}/checkpoint", {"langs": by_lang}))
    released = not any(rows.storageLevel.useMemory or reads_kept_rows(rows) for rows, _ in seen)
    counts = spark.read.parquet(f"{base}/out/langs")
    return counts.select(F.col("batch_id").cast("long"), "lang", "posts", "kept", F.lit(released).alias("released"))


# --- windows ---------------------------------------------------------------------------------

WINDOWS_SQL = f"""{inputs.POST_TEXTS_SQL},
tags AS (
  SELECT CAST(epoch(ts) AS BIGINT) AS second, tag FROM
    (SELECT ts, unnest(string_split(text, ' ')) AS tag FROM post_texts)
  WHERE starts_with(tag, '#')),
slides AS (SELECT tag, second, count(*) AS n FROM tags GROUP BY ALL),
windows AS (
  SELECT start, tag, CAST(sum(n) AS BIGINT) AS count FROM
    (SELECT tag, n, unnest(range(second - 299, second + 1)) AS start FROM slides)
  GROUP BY start, tag),
ranked AS (SELECT *, row_number() OVER (PARTITION BY start ORDER BY count DESC, tag) AS rank
           FROM windows)"""

# What is closed when the watermark stands ten seconds behind the newest post.
_MARK = """(SELECT max(second) - 10 FROM
            (SELECT CAST(epoch(ts) AS BIGINT) AS second FROM post_texts))"""
_CLOSED = f"start + 300 <= (SELECT max(second) + 1 FROM slides WHERE second + 1 <= {_MARK})"


def _in_seconds(counts):
    return counts.select(F.unix_timestamp("window_start").alias("start"), "tag", "count")


@query("hashtag_window_counts", f"WITH {WINDOWS_SQL} SELECT start, tag, count FROM windows")
def _(spark, sf_dir):
    return _in_seconds(trends.hashtag_window_counts(inputs.post_texts(spark, sf_dir)))


@query(
    "top_hashtags_per_window",
    f"""WITH {WINDOWS_SQL} SELECT start, tag, count, CAST(rank AS INTEGER) AS rank FROM ranked
        WHERE rank <= 10""",
)
def _(spark, sf_dir):
    counts = trends.hashtag_window_counts(inputs.post_texts(spark, sf_dir))
    top = trends.top_hashtags_per_window(counts, 10)
    return top.select(F.unix_timestamp("window_start").alias("start"), "tag", "count", "rank")


@query(
    "event_window_counts",
    """SELECT start, event_type, CAST(sum(n) AS BIGINT) AS count FROM (
         SELECT event_type, n, unnest(range(hour - 23 * 3600, hour + 1, 3600)) AS start FROM (
           SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) // 3600 * 3600 AS hour,
                  count(*) AS n
           FROM events GROUP BY ALL))
       GROUP BY start, event_type""",
)
def _(spark, sf_dir):
    at = F.col("ts").cast("timestamp")
    events = table(spark, sf_dir, "events").select(at.alias("ts"), "event_type")
    hours = trends.slide_counts(events, "event_type", 3600)
    counts = trends.sliding_counts(hours, "event_type", 86400, 3600)
    return counts.select(F.unix_timestamp("window_start").alias("start"), "event_type", "count")


def _landed_in_order(spark, sf_dir, base, start):
    """Land the posts in four parts by time; ``start`` a query after each, from its checkpoint.

    Nothing may come behind the watermark then.
    """
    posts = inputs.post_texts_from(table(spark, sf_dir, "documents"))
    quarter = F.expr("(unix_timestamp(ts) % 7200) div 1800")
    for part in range(4):
        landed = posts.filter(quarter == part).select("ts", "text")
        landed.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(landed.schema).parquet(f"{base}/in")
        running = start(stream)
        drain(running)
        late = stream_trends.late_rows(running)
        if late:
            raise ValueError(f"{late} rows of part {part} came behind the watermark")


@query(
    "stream_hashtag_window",
    f"WITH {WINDOWS_SQL} SELECT start, tag, count FROM windows WHERE {_CLOSED}",
)
def _(spark, sf_dir):
    """Windows over the finished slides of a stream that lands in four parts."""
    base = scratch_dir(spark, "windows")
    slides = f"{base}/slides"
    _landed_in_order(
        spark, sf_dir, base, lambda posts: stream_trends.write_slide_counts(posts, slides, f"{base}/checkpoint")
    )
    return _in_seconds(stream_trends.finished_windows(spark, slides))


@query(
    "stream_top_hashtags",
    f"""WITH {WINDOWS_SQL} SELECT start, tag, count, CAST(rank AS INTEGER) AS rank FROM ranked
        WHERE rank <= 10 AND {_CLOSED}""",
)
def _(spark, sf_dir):
    """The most frequent tags of the windows over the finished slides, after four landings."""
    base = scratch_dir(spark, "windows")
    slides = f"{base}/slides"
    _landed_in_order(
        spark, sf_dir, base, lambda posts: stream_trends.write_slide_counts(posts, slides, f"{base}/checkpoint")
    )
    top = trends.top_hashtags_per_window(stream_trends.finished_windows(spark, slides), 10)
    return top.select(F.unix_timestamp("window_start").alias("start"), "tag", "count", "rank")


# What a chain of hops of 15 s has closed: the stretch that a window lies in ends at a multiple of them.
_CHAIN_CLOSED = f"((start + 14) // 15) * 15 + 300 <= {_MARK}"


@query(
    "stream_hashtag_window_chain",
    f"WITH {WINDOWS_SQL} SELECT start, tag, count FROM windows WHERE {_CHAIN_CLOSED}",
)
def _(spark, sf_dir):
    """Windows by chained aggregations in one query, over four landings."""
    base = scratch_dir(spark, "windows")
    _landed_in_order(
        spark, sf_dir, base,
        lambda posts: stream_trends.write_window_counts(posts, f"{base}/out", "batch", f"{base}/checkpoint"),
    )
    return _in_seconds(spark.read.parquet(f"{base}/out/batch_*"))


@query(
    "stream_top_hashtags_chain",
    f"""WITH {WINDOWS_SQL} SELECT start, tag, count, CAST(rank AS INTEGER) AS rank FROM ranked
        WHERE rank <= 10 AND {_CHAIN_CLOSED}""",
)
def _(spark, sf_dir):
    """The most frequent tags of the windows that each batch of the chain closes."""
    base = scratch_dir(spark, "windows")
    _landed_in_order(
        spark, sf_dir, base,
        lambda posts: stream_trends.write_top_hashtags(posts, f"{base}/out", "batch", f"{base}/checkpoint"),
    )
    top = spark.read.parquet(f"{base}/out/batch_*")
    return top.select(F.unix_timestamp("window_start").alias("start"), "tag", "count", "rank")


@query(
    "stream_hashtag_window_direct",
    f"WITH {WINDOWS_SQL} SELECT start, tag, count FROM windows WHERE start + 300 <= {_MARK}",
)
def _(spark, sf_dir):
    counts = stream_trends.hashtag_windows_direct(inputs.post_text_stream(spark, sf_dir))
    return _in_seconds(_written(spark, counts, reuse=True))


@query(
    "stream_hashtag_slides",
    f"""WITH {WINDOWS_SQL} SELECT tag, second AS bucket, n FROM slides
        WHERE second + 1 <= {_MARK}""",
)
def _(spark, sf_dir):
    base = scratch_dir(spark, "slides")
    posts = inputs.post_text_stream(spark, sf_dir)
    drain(stream_trends.write_slide_counts(posts, f"{base}/out", f"{base}/checkpoint"))
    return spark.read.schema("tag string, bucket bigint, n bigint").parquet(f"{base}/out")
