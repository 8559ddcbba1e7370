"""Reading lines, JSON, records, vectors and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.operators.sinks import write_lines
from rookery.plans import inputs
from rookery.plans.registry import query
from rookery.session import scratch_dir
from rookery.sources.access_log import parse_access_log, status_counts
from rookery.sources.lines import parse_labeled_points, parse_people, parse_vectors, read_lines
from rookery.sources.posts import CORRUPT, read_posts_json
from rookery.sources.tables import table


@query("scan_lines", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def _(spark, sf_dir):
    path = scratch_dir(spark, "lines")
    write_lines(table(spark, sf_dir, "documents").select("text"), path)
    return read_lines(spark, path)


@query(
    "scan_json",
    f"""WITH {inputs.POSTS_SQL}
        SELECT post_id, CAST(epoch(ts) AS BIGINT) AS second, lang, text, name, friends, verified,
               lat, false AS corrupt
        FROM posts""",
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "posts-json")
    inputs.posts(spark, sf_dir).write.json(path)
    return read_posts_json(spark, path).select(
        "post_id",
        F.unix_timestamp("ts").alias("second"),
        "lang",
        "text",
        F.col("user.name").alias("name"),
        F.col("user.friends_count").alias("friends"),
        F.col("user.verified").alias("verified"),
        F.col("geo.lat").alias("lat"),
        F.col(CORRUPT).isNotNull().alias("corrupt"),
    )


@query(
    "scan_json_inferred",
    """SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "events-json")
    props = F.from_json("props", "k bigint")
    table(spark, sf_dir, "events").select("event_id", "user_id", props.alias("props")).write.json(
        path
    )
    return read_posts_json(spark, path, schema=None).select("event_id", "user_id", "props.k")


@query(
    "scan_json_corrupt",
    """SELECT event_id % 50 = 0 AS corrupt, count(*) AS n,
              CAST(sum(CASE WHEN event_id % 50 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END)
                   AS BIGINT) AS k
       FROM events GROUP BY 1""",
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "props-json")
    # Every fiftieth line is no JSON at all.
    line = F.when(F.col("event_id") % 50 == 0, F.lit("malformed")).otherwise(F.col("props"))
    write_lines(table(spark, sf_dir, "events").select(line.alias("value")), path)
    schema = spark.createDataFrame([], "k bigint").schema
    read = read_posts_json(spark, path, schema)
    return read.groupBy(F.col(CORRUPT).isNotNull().alias("corrupt")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("k")
    )


@query(
    "parse_delimited",
    f"WITH {inputs.PEOPLE_SQL} SELECT name, age, false AS malformed FROM people",
)
def _(spark, sf_dir):
    return parse_people(inputs.people_lines(spark, sf_dir))


@query("parse_vector", f"WITH {inputs.CLUSTER_POINTS_SQL} SELECT x0, x1 FROM points")
def _(spark, sf_dir):
    parsed = parse_vectors(inputs.vector_lines(table(spark, sf_dir, "lineitem")))
    x0, x1 = F.get("features", F.lit(0)), F.get("features", F.lit(1))
    return parsed.select(x0.alias("x0"), x1.alias("x1"))


@query(
    "parse_labeled_point",
    f"WITH {inputs.CLUSTER_POINTS_SQL} SELECT CAST(id AS DOUBLE) AS label, id, x0, x1 FROM points",
)
def _(spark, sf_dir):
    parsed = parse_labeled_points(inputs.labeled_point_lines(table(spark, sf_dir, "lineitem")))
    return parsed.select(
        "label",
        F.col("label").cast("int").alias("id"),
        F.get("features", F.lit(0)).alias("x0"),
        F.get("features", F.lit(1)).alias("x1"),
    )


@query(
    "access_log_parse",
    """SELECT event_id, event_id % 50 <> 0 AS parsed,
              CASE WHEN ok THEN '10.0.' || user_id % 256 || '.' || event_id % 256 END AS ip,
              CASE WHEN ok THEN '-' END AS client,
              CASE WHEN ok THEN 'u' || user_id END AS user,
              CASE WHEN ok THEN CAST(floor(epoch(ts)) AS BIGINT) END AS second,
              CASE WHEN ok THEN 'GET /' || event_type || ' HTTP/1.1' END AS request,
              CASE WHEN ok THEN CAST(CASE event_type WHEN 'error' THEN 500 ELSE 200 END AS INTEGER) END
                AS status,
              CASE WHEN ok AND event_id % 10 <> 1 THEN event_id % 5000 END AS bytes,
              CASE WHEN ok THEN '-' END AS referer,
              CASE WHEN ok THEN 'agent' END AS agent
       FROM (SELECT *, event_id % 50 <> 0 AS ok FROM events)""",
)
def _(spark, sf_dir):
    log = parse_access_log(inputs.access_log_lines(spark, sf_dir))
    return log.withColumn("second", F.unix_timestamp("logged_at")).drop("line", "logged_at")


@query(
    "access_log_status_counts",
    """SELECT CAST(CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_type = 'error' THEN 500
                        ELSE 200 END AS INTEGER) AS status, count(*) AS n
       FROM events GROUP BY 1""",
)
def _(spark, sf_dir):
    return status_counts(parse_access_log(inputs.access_log_lines(spark, sf_dir)))
