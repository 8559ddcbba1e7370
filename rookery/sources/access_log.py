"""Web access-log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the nine groups of a combined access-log line (the address may be missing).
ACCESS_LOG_LINE = (
    r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})? (\S+) (\S+) (\[.+?\]) "
    r'"(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"'
)
ACCESS_LOG_TIME = "'['dd/MMM/yyyy:HH:mm:ss Z']'"

_GROUPS = ["ip", "client", "user", "logged_at", "request", "status", "bytes", "referer", "agent"]
_MARK = "\u0001"


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Typed columns of each line plus ``parsed``; unreadable lines stay with NULL fields.

    The pattern runs once per line: it rewrites a matching line to its groups with a control
    character between them, and the groups are then picked by position. Only a line that itself
    holds that character is read group by group.
    """
    whole = rf"\A{ACCESS_LOG_LINE}\z"
    numbers = range(1, len(_GROUPS) + 1)
    rewritten = F.regexp_replace(F.col(col), whole, "".join(f"{_MARK}${i}" for i in numbers))
    by_group = F.when(
        F.col(col).rlike(whole),
        F.array(F.lit(""), *[F.regexp_extract(F.col(col), whole, i) for i in numbers]),
    )
    parts = F.when(F.col(col).contains(_MARK), by_group).otherwise(F.split(rewritten, _MARK))
    kept = [c for c in lines.columns if c != col]
    split_lines = lines.select(*kept, F.col(col).alias("line"), parts.alias("parts")).select(
        *kept, "line", F.when(F.size("parts") == len(_GROUPS) + 1, F.col("parts")).alias("parts")
    )
    field = {name: F.get("parts", F.lit(i + 1)) for i, name in enumerate(_GROUPS)}
    return split_lines.select(
        *kept,
        "line",
        F.col("parts").isNotNull().alias("parsed"),
        F.nullif(field["ip"], F.lit("")).alias("ip"),
        field["client"].alias("client"),
        field["user"].alias("user"),
        F.try_to_timestamp(field["logged_at"], F.lit(ACCESS_LOG_TIME)).alias("logged_at"),
        field["request"].alias("request"),
        field["status"].try_cast("int").alias("status"),
        field["bytes"].try_cast("bigint").alias("bytes"),
        field["referer"].alias("referer"),
        field["agent"].alias("agent"),
    )


def status_counts(log: DataFrame) -> DataFrame:
    """Lines per status; unreadable lines are the NULL status."""
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
