"""Post inputs: JSON files, a stream over a landing folder, and message values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

USER_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("screen_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("verified", T.BooleanType()),
        T.StructField("friends_count", T.IntegerType()),
        T.StructField("followers_count", T.IntegerType()),
        T.StructField("favourites_count", T.IntegerType()),
        T.StructField("statuses_count", T.IntegerType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

POST_SCHEMA = T.StructType(
    [
        T.StructField("post_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("lang", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField(
            "geo",
            T.StructType(
                [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]
            ),
        ),
        T.StructField("user", USER_SCHEMA),
    ]
)

CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_posts_json(
    spark: SparkSession, path: str, schema: T.StructType | None = POST_SCHEMA
) -> DataFrame:
    """JSON lines under an explicit schema; unreadable lines are kept in ``_corrupt_record``.

    ``schema=None`` infers it, which costs a pass over the whole input.
    """
    if schema is None:
        return spark.read.json(path)
    return (
        spark.read.schema(with_corrupt(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_post_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = POST_SCHEMA,
    fmt: str = "json",
    max_files: int | None = None,
) -> DataFrame:
    """Posts from the files that land in ``path``; unreadable JSON lines in ``_corrupt_record``."""
    reader = spark.readStream.format(fmt)
    if fmt == "json":
        reader = reader.schema(with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT)
    else:
        reader = reader.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def posts_from_messages(
    messages: DataFrame, value: str | Column = "value", schema: T.StructType = POST_SCHEMA
) -> DataFrame:
    """Posts from a JSON message column, as a message-queue source delivers them."""
    col = F.col(value) if isinstance(value, str) else value
    parsed = F.from_json(
        col.cast("string"), with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT}
    )
    return messages.select(parsed.alias("post")).select("post.*")
