"""Service logs as a table of lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the layout "yyyy-MM-dd HH:mm:ss [thread] LEVEL logger - message".
LAYOUT = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \[([^\]]*)\] (\w+) +(\S+) - (.*)$"
RENDERED = "%s [%s] %-5s %s - %s"


def read_logs(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Lines of each service's log files: ``service, value``."""
    parts = [
        spark.read.text(path).select(F.lit(service).alias("service"), "value")
        for service, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def error_log_lines(lines: DataFrame) -> DataFrame:
    """Lines with ERROR anywhere, in any case.  A line outside the layout, such
    as a stack trace, is kept with its whole text as message."""

    def part(index: int):
        return F.nullif(F.regexp_extract("value", LAYOUT, index), F.lit(""))

    return lines.filter(F.lower("value").contains("error")).select(
        "service",
        part(1).try_cast("timestamp_ntz").alias("logged_at"),
        part(2).alias("thread"),
        part(3).alias("level"),
        part(4).alias("logger"),
        F.coalesce(part(5), F.col("value")).alias("message"),
    )
