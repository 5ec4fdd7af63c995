"""Deliveries per location and window, kept up to date from a stream.

The watermark trails the highest event time by the grace period.  It moves
between micro-batches only, so a late record may still be counted here where
the exact rule (operators.late) would drop it; none is dropped that the rule
keeps for one clock over all.  ``streaming.late`` applies the rule itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from waybill import schemas as S
from waybill.functions import times
from waybill.operators import counts
from waybill.operators.late import GRACE
from waybill.streaming import latest, sinks

def windowed_counts(
    delivered: DataFrame, size: str = counts.WINDOW, grace: str | None = GRACE, zone: str | None = "UTC"
) -> DataFrame:
    """``delivered`` is a stream of decoded delivered events.

    Without ``grace`` nothing is ever late: for replaying stored events, which come
    in any order.  The state then keeps one row per location and window.
    """
    record_time = "record_timestamp" if "record_timestamp" in delivered.columns else None
    at = times.to_instant(times.event_time("delivered_at", record_time, zone=zone))
    timed = counts.valid_deliveries(delivered).select("location", at.alias("event_time"))
    timed = timed if grace is None else timed.withWatermark("event_time", grace)
    counted = counts.count_windows(timed, "event_time", size)
    return counted.select(
        "location",
        times.from_instant("window_start").alias("window_start"),
        times.from_instant("window_end").alias("window_end"),
        "count",
    )


def counts_writer(counted: DataFrame, path: str) -> DataStreamWriter:
    """Every changed window of a batch goes to that batch's folder."""
    return counted.writeStream.outputMode("update").foreachBatch(sinks.to_batches(path))


KEY = ["location", "window_start", "window_end"]


def read_counts(spark: SparkSession, path: str, retention: str | None = None) -> DataFrame:
    """The counts table: each window as the latest batch left it.

    ``retention`` leaves out windows that started that long before the newest one.
    """
    rows = latest.view(spark, path, S.DELIVERY_COUNT, KEY)
    return rows if retention is None else counts.retained(rows, retention)


def compact(spark: SparkSession, path: str, files: int = 16, retention: str | None = None) -> int | None:
    """See ``latest.compact``; windows older than ``retention`` are left out for good once
    ``remove_covered`` has deleted what the compaction covers."""
    keep = None if retention is None else lambda rows: counts.retained(rows, retention)
    return latest.compact(spark, path, S.DELIVERY_COUNT, KEY, files, keep)


remove_covered = latest.remove_covered
