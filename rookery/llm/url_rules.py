"""Verdicts on urls from nested host and path rules: a range join by one sorted sweep."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rookery.llm.rows import Packed, materialise

# Rows that one stretch of the sorted urls holds on average.
CELL_ROWS = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = "verdict string, host string, path string"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, both empty where it is null or has no ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.translate(F.regexp_extract(after, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each with a dot behind it.

    A host and all its subdomains are then one interval: the keys that start with the host's key.
    """
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _events(pages: DataFrame, rules: DataFrame, id_col: str, url_col: str) -> DataFrame:
    names = pages.columns
    plain = pages.toDF(*[f"c{i}" for i in range(len(names))])
    ident, url = (F.col(f"c{names.index(c)}") for c in (id_col, url_col))
    host, path = url_parts(url)
    urls = plain.select(
        host_key(host).alias("key"), F.lit(1).alias("kind"), path.alias("path"), host.alias("host"),
        F.lit(None).cast("string").alias("verdict"), ident.alias("id"),
    )
    host, path = (F.coalesce(c, F.lit("")) for c in ("host", "path"))
    host = F.translate(host, _UPPER, _LOWER)
    # The empty host is above all others, also above urls without a host.
    key = F.when(host == "", "").otherwise(host_key(host))
    given = rules.filter("verdict is not null").groupBy(key.alias("key"), path.alias("path"), host.alias("host"))
    given = given.agg(F.max("verdict").alias("verdict")).select(
        "key", F.lit(0).alias("kind"), "path", "host", "verdict",
        F.lit(None).cast(urls.schema["id"].dataType).alias("id"),
    )
    # The salt lets a url that many rows share lie in several stretches; it is written, so it stays.
    return urls.union(given).withColumn("salt", F.monotonically_increasing_id())


class _Sweep:
    """The active rules while keys ascend: a stack of hosts, each within the one below it."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str, list[str], list[int], list[str]]] = []

    def leave(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def rule(self, key: str, host: str, path: str, verdict: str) -> None:
        """Rules of a host come in the order of their paths; each knows the one it is nested in."""
        self.leave(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, host, [], [], []))
        _, _, paths, above, verdicts = self.stack[-1]
        outer = len(paths) - 1
        while outer >= 0 and not path.startswith(paths[outer]):
            outer = above[outer]
        paths.append(path)
        above.append(outer)
        verdicts.append(verdict)

    def longest(self, key: str, path: str) -> tuple[str | None, str | None]:
        """Rule and verdict of the longest rule that fits; of equally long ones that of the longer host."""
        self.leave(key)
        best, rule, verdict = -1, None, None
        for _, host, paths, above, verdicts in self.stack:
            at = bisect_right(paths, path) - 1
            while at >= 0 and not path.startswith(paths[at]):
                at = above[at]
            if at >= 0 and len(host) + len(paths[at]) >= best:
                best, rule, verdict = len(host) + len(paths[at]), host + paths[at], verdicts[at]
        return rule, verdict


def _swept(rows: DataFrame) -> DataFrame:
    """Urls with rule and verdict; partitions hold whole stretches, in order."""
    schema = T.StructType(
        [rows.schema["id"]] + [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, sweep, last, found = None, _Sweep(), None, (None, None)
        for batch in batches:
            cells, keys, kinds, paths, hosts, verdicts = (batch.column(i).to_pylist() for i in range(6))
            urls, out = [], ([], [])
            for i, key in enumerate(keys):
                if cells[i] != cell:
                    cell, sweep, last = cells[i], _Sweep(), None
                if kinds[i] == 0:
                    sweep.rule(key, hosts[i], paths[i], verdicts[i])
                    last = None
                    continue
                if last != (key, paths[i]):
                    last, found = (key, paths[i]), sweep.longest(key, paths[i])
                urls.append(i)
                out[0].append(found[0])
                out[1].append(found[1])
            own = batch.take(pa.array(urls, pa.int64()))
            cells_out = [own.column(6), own.column(4), own.column(3), *(pa.array(x, pa.string()) for x in out)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cells_out, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``(id, host, path, rule, verdict)``: one row per row of ``pages``.

    ``rules`` has ``verdict``, ``host`` and ``path``. A rule fits its host and all subdomains where
    the url's path starts with the rule's; the longest (characters of host and path together) wins,
    of equally long ones that with the longer host. Without a rule, ``rule`` is null and the verdict
    is ``default``.

    Hosts are keyed by their labels in reverse, so a rule is an interval of keys and intervals are
    nested or apart. Urls and rules are range-partitioned and sorted together by key and path; equal
    urls may lie in several stretches. A stretch also gets the rules that began before it and hold
    its first key, found by an equality join on that key's own prefixes. One sweep over a stretch
    keeps the stack of active rules and judges each url from it.

    Null and empty urls have empty host and path, which only rules of the empty host and path fit. Hosts
    of rules are lower-cased, null host or path is empty, a rule without a verdict is none, and of
    equal rules with different verdicts ``block`` wins. Repeated rows and null ids are judged like any
    other. No rows give no rows; no rules give the default. Only ids and urls move.
    """
    spark = pages.sparkSession
    events = materialise(_events(pages, rules, id_col, url_col), "urls")
    stretches = max(spark.sparkContext.defaultParallelism, -(-events.count() // cell_rows))
    order = ["key", "kind", "path", "salt"]
    cells = events.repartitionByRange(stretches, *order).sortWithinPartitions(*order)
    cells = materialise(cells.select(F.spark_partition_id().alias("cell"), "key", "kind", "path", "host", "verdict", "id"), "cells")
    # One row per stretch, and one per label of its first host.
    firsts = cells.groupBy("cell").agg(F.min("key").alias("key"))
    labels = F.split(F.expr("substr(key, 1, length(key) - 1)"), r"\.")
    nested = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit("."))
    )
    above = F.concat(F.array(F.lit("")), F.when(F.col("key") != "", nested).otherwise(F.array().cast("array<string>")))
    firsts = firsts.select(F.col("cell").alias("into"), F.explode(above).alias("key"))
    carried = cells.filter("kind = 0").join(firsts, "key").filter("cell < into")
    carried = carried.select(F.col("into").alias("cell"), "key", "kind", "path", "host", "verdict", "id")
    rows = cells.union(carried).repartition(stretches, "cell").sortWithinPartitions("cell", "key", "kind", "path")
    return _swept(rows).withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def without_blocked(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``pages`` whose url is not blocked, with all their columns.

    Each distinct url is judged once. Null urls stay unless ``default`` is ``block``.
    """
    packed = Packed(pages, url_col, url_col)
    urls = packed.frame.select("id").distinct()
    blocked = judge_urls(urls, rules, "id", "id", default).filter("verdict = 'block'").select(F.col("id").alias("blocked"))
    kept = packed.frame.join(blocked, F.col("id").eqNullSafe(F.col("blocked")), "left_anti")
    return packed.unpack(kept)
