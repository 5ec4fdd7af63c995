"""Deliveries counted per location and time window, and the queries on the counts.

A counts table has the columns ``location, window_start, window_end, count``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import text, times

WINDOW = "60 minutes"
RETENTION = "7 days"


def valid_deliveries(events: DataFrame) -> DataFrame:
    """Events with a location, under its trimmed name."""
    return events.filter(~text.is_empty("location")).withColumn("location", text.trimmed("location"))


def count_windows(
    events: DataFrame, time: str = "delivered_at", size: str = WINDOW, slide: str | None = None
) -> DataFrame:
    """Count events per location and epoch-aligned window (start inclusive, end
    exclusive).  Partial counts are built before the only shuffle, so a busy
    location costs one row per window and task."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return (
        events.groupBy("location", window.alias("w"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select("location", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "count")
    )


def delivery_counts(events: DataFrame, size: str = WINDOW, slide: str | None = None) -> DataFrame:
    return count_windows(valid_deliveries(events), "delivered_at", size, slide)


def merge_counts(partials: DataFrame) -> DataFrame:
    """Add up partial counts of the same window."""
    return partials.groupBy("location", "window_start", "window_end").agg(F.sum("count").alias("count"))


def check_range(start, end) -> None:
    """Reject a missing or reversed range; columns are taken as they are."""
    if start is None:
        raise ValueError("From date cannot be null")
    if end is None:
        raise ValueError("To date cannot be null")
    if isinstance(start, datetime) and isinstance(end, datetime) and start > end:
        raise ValueError("From date must be before or equal to to date")


def check_location(location: str | None) -> None:
    if location is None or not location.strip("".join(map(chr, range(0x21)))):
        raise ValueError("Location cannot be null or empty")


def _moment(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _listed(rows: DataFrame, max_results: int | None) -> DataFrame:
    """All rows, in no order; with ``max_results`` the first so many in time order."""
    return rows if max_results is None else rows.orderBy("window_start", "location").limit(max_results)


def _in_range(counts: DataFrame, start, end) -> DataFrame:
    check_range(start, end)
    return counts.filter(F.col("window_start").between(_moment(start), _moment(end)))


def deliveries_of_range(
    events: DataFrame, start, end, time: str = "delivered_at", size: str = WINDOW
) -> DataFrame:
    """The events that windows starting within ``[start, end]`` can hold, for
    counting no more than a range asks for; a plain comparison that reaches the scan."""
    check_range(start, end)
    last = _moment(end) + F.expr(f"INTERVAL {size}")
    return events.filter((F.col(time) >= _moment(start)) & (F.col(time) < last))


def deliveries_of_location(events: DataFrame, location: str) -> DataFrame:
    """The events that can count for a location: those whose own text contains it,
    padded or not; a comparison that reaches the scan."""
    check_location(location)
    return events.filter(F.contains("location", F.lit(location)))


def counts_in_range(counts: DataFrame, start, end, max_results: int | None = None) -> DataFrame:
    """Windows of all locations starting within ``[start, end]``, both ends
    included; the first ``max_results`` in time order if that is given."""
    return _listed(_in_range(counts, start, end), max_results)


def location_counts(
    counts: DataFrame, location: str, start, end, max_results: int | None = None
) -> DataFrame:
    """The same for one location, matched exactly (the argument is not trimmed)."""
    check_location(location)
    return _listed(_in_range(counts, start, end).filter(F.col("location") == location), max_results)


def looking_back(as_of, hours: int = 24) -> tuple[Column, Column]:
    """The range of the last ``hours`` before ``as_of``."""
    if as_of is None:
        raise ValueError("To date cannot be null")
    end = _moment(as_of)
    return end - F.expr(f"INTERVAL {int(hours)} HOURS"), end


def counts_looking_back(
    counts: DataFrame, as_of, hours: int = 24, max_results: int | None = None
) -> DataFrame:
    """Windows that started in the last ``hours`` before ``as_of``."""
    return counts_in_range(counts, *looking_back(as_of, hours), max_results)


def recent_window_count(counts: DataFrame, as_of) -> DataFrame:
    """How many windows started in the last hour, all of them."""
    return counts_looking_back(counts, as_of, 1).agg(F.count(F.lit(1)).alias("recent_data_count"))


def location_total(counts: DataFrame, location: str, start, end) -> DataFrame:
    """One row: the location, the range and the total of all its windows."""
    return location_counts(counts, location, start, end).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_deliveries")
    ).select(
        F.lit(location).alias("location"), _moment(start).alias("from"), _moment(end).alias("to"), "total_deliveries",
    )


def location_analytics(
    counts: DataFrame, location: str, start, end, max_results: int | None = None
) -> DataFrame:
    """One row: the location, the range, its windows in time order and their total.

    The total is over all windows of the range; ``max_results`` shortens the list
    only.  The list is one value, so for ranges without bound use ``location_counts``
    and ``location_total``.
    """
    rows = location_counts(counts, location, start, end)
    entry = F.struct("window_start", "window_end", "location", "count")
    listed = F.sort_array(F.collect_list(entry))
    if max_results is not None:
        listed = F.slice(listed, 1, max_results)
    return rows.agg(
        listed.alias("hourly_data"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_deliveries"),
    ).select(
        F.lit(location).alias("location"),
        _moment(start).alias("from"),
        _moment(end).alias("to"),
        "hourly_data",
        "total_deliveries",
    )


def deliveries_per_location(counts: DataFrame) -> DataFrame:
    return counts.groupBy("location").agg(F.sum("count").alias("total_deliveries"))


def retained(counts: DataFrame, retention: str = RETENTION) -> DataFrame:
    """Windows that started less than ``retention`` before the newest one."""
    newest = counts.agg(F.max("window_start")).scalar()
    return counts.filter(F.col("window_start") > newest - F.expr(f"INTERVAL {retention}"))


def delivery_rate(counts: DataFrame) -> DataFrame:
    """Deliveries per hour of each window and the texts shown for it."""
    minutes = times.minutes_between("window_start", "window_end")
    hours = F.coalesce(minutes / F.lit(60.0), F.lit(0.0))
    rate = F.when(hours > 0, F.col("count") / hours).otherwise(F.lit(0.0))
    return counts.select(
        "location",
        "window_start",
        rate.alias("per_hour"),
        F.format_string("%,d", "count").alias("total_display"),
        F.format_string("%.1f", rate).alias("rate_display"),
        times.clock_display("window_start").alias("start_display"),
        times.clock_display("window_end").alias("end_display"),
    )
