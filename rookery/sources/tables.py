"""The given parquet tables, in batch and as a replayed stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# What one task reads, about, when parts of a table are landed as files of a stream.
LANDED_BYTES = 128 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Times are rendered as text with an offset, so the zone has to be fixed.
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _located(spark: SparkSession, path: str):
    """The Hadoop path, and the file system it is on."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _is_file(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _located(spark, path)
    return fs.getFileStatus(hadoop_path).isFile()


def table_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """The size of a table's files."""
    hadoop_path, fs = _located(spark, f"{sf_dir}/{name}.parquet")
    return fs.getContentSummary(hadoop_path).getLength()


def land_in_turn(parts: Sequence[DataFrame], path: str, scanned: int) -> DataFrame:
    """Land frames one after the other in a folder, and stream them from there, one frame per batch.

    A stream takes so many files per batch, so every frame lands as the same number of files: one per
    ``LANDED_BYTES`` of the ``scanned`` bytes that each frame is filtered from, so that no task reads
    much more. A task without rows leaves no file; an empty one takes its place.
    """
    spark, schema = parts[0].sparkSession, parts[0].schema
    files = max(1, -(-scanned // LANDED_BYTES))
    for i, part in enumerate(parts, 1):
        part.coalesce(files).write.mode("append").parquet(path)
        nothing = spark.createDataFrame([], schema).coalesce(1)
        for _ in range(files * i - len(spark.read.schema(schema).parquet(path).inputFiles())):
            nothing.write.mode("append").parquet(path)
    # All files of the folder are listed once, so that no batch ends where a shorter list does.
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.option("maxCachedFiles", files * len(parts)).parquet(path)


def replay_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream, be it one file or a folder of files."""
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    path = f"{sf_dir}/{name}.parquet"
    if _is_file(spark, path):
        # A file stream watches a folder.
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(path)
