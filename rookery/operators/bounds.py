"""Size checks and the joins chosen by them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.storagelevel import StorageLevel

# Word lists up to this size are sent to every executor.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# Spark prunes row_number() <= k before the shuffle only below this k.
_GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


@dataclass(frozen=True)
class WordListSize:
    """Rows and bytes of a word list, counted up to just above the broadcast bound."""

    rows: int
    bytes: int

    def within(self, rows: int, size: int) -> bool:
        return self.rows <= rows and self.bytes <= size


def word_list_size(words: DataFrame, key: str = "word") -> WordListSize:
    counted = words.select(key).limit(BROADCAST_ROWS + 1)
    row = counted.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(key)), F.lit(0)).alias("bytes"),
    ).first()
    return WordListSize(row["rows"], row["bytes"])


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small scan out to all cores, ahead of costly work on each row.

    A scan with at least as many tasks as there are cores is returned as it is, so no large table
    is ever shuffled by this. So is a frame that shuffles anyway: asking for its tasks would run
    its stages.
    """
    if df.isStreaming or "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    # The rows stay in Spark's own form: ``df.rdd`` would plan their way to Python as well.
    tasks = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if tasks >= cores else df.repartition(cores)


def salts(df: DataFrame) -> int:
    """More salts on a larger cluster; what is still uneven then is left to AQE's skew join."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(16, min(256, partitions))


def hot_words(tokens: DataFrame, key: str, salts: int) -> list[str]:
    """Words that make up more than one in ``4 * salts`` of the tokens; so there are fewer than that."""
    # No observation here: a session that has made one can no longer ship some of Spark's own models.
    counts = tokens.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total")).first()["total"]
        most = counts.orderBy(F.desc("_n")).limit(4 * salts).collect()
    finally:
        counts.unpersist()
    return [row[key] for row in most if row[key] is not None and row["_n"] * 4 * salts > total]


def word_join(
    tokens: DataFrame,
    words: DataFrame,
    spread_by: str,
    how: str = "inner",
    key: str = "word",
    size: WordListSize | None = None,
    hot: Sequence[str] | None = None,
) -> DataFrame:
    """Join tokens to a word table on ``key`` although a few words make up most tokens.

    A small word table is broadcast. For a large one the tokens are counted first. The rows of a hot
    word are spread over several tasks by the hash of ``spread_by``, and its row of the table is
    repeated once per salt; all other words are joined as they are. On a stream, which cannot be
    counted, every word counts as hot. A known ``size`` saves counting the word table again, known
    ``hot`` words the tokens.
    """
    size = size or word_list_size(words, key)
    if size.within(BROADCAST_ROWS, BROADCAST_BYTES):
        return tokens.join(F.broadcast(words), key, how)
    n = salts(tokens)
    # Tokens that are null meet no word, but may be many.
    is_hot = F.lit(True)
    if not tokens.isStreaming:
        hot = hot_words(tokens, key, n) if hot is None else hot
        is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(True))
    none = F.lit(0).cast("bigint")
    salted_tokens = tokens.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(spread_by), F.lit(n))).otherwise(none)
    )
    last = F.when(is_hot, F.lit(n - 1)).otherwise(F.lit(0)).cast("bigint")
    salted_words = words.withColumn("_salt", F.explode(F.sequence(none, last)))
    return salted_tokens.join(salted_words, [key, "_salt"], how).drop("_salt")


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, spread_by: str
) -> DataFrame:
    """The first ``k`` rows of each group, with their ``rank``.

    Below Spark's threshold the planner cuts each task to ``k`` rows per group before the shuffle.
    Above it the same cut is made here on salted groups, so that no group is sorted whole.
    """
    threshold = int(df.sparkSession.conf.get(_GROUP_LIMIT_CONF, "1000"))
    if k >= threshold:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(64)))
        part = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = salted.withColumn("_r", F.row_number().over(part)).filter(F.col("_r") <= k)
        df = df.drop("_salt", "_r")
    whole = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)
