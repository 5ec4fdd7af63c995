"""Queries on delivery counts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import times
from waybill.operators import counts, late, lifecycle, records
from waybill.plans.lifecycle import replayed
from waybill.session import temporary_folder
from waybill.sources import stored, tables, topics
from waybill.streaming import counts as stream_counts
from waybill.streaming import sinks

ZONE = "Europe/Berlin"
RANGE = (datetime(2024, 1, 10), datetime(2024, 1, 12))
ANALYSED = ("purchase", datetime(2024, 1, 5), datetime(2024, 1, 25))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.delivery_counts(tables.deliveries(spark, sf_dir))


def hopping(spark, sf_dir):
    return counts.delivery_counts(tables.deliveries(spark, sf_dir), "60 minutes", "30 minutes")


def valid_deliveries(spark, sf_dir):
    return counts.valid_deliveries(tables.dirty_deliveries(spark, sf_dir))


def event_time(spark, sf_dir):
    """Every eleventh delivery has no time of its own, every twenty-second no record time either."""
    events = tables.deliveries(spark, sf_dir)
    key = F.col("event_id")
    own = F.when(key % 11 != 0, F.col("delivered_at"))
    recorded = F.when(key % 22 != 0, F.col("delivered_at")).otherwise(times.epoch())
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return events.select("event_id", times.event_time(own, recorded, now, ZONE).alias("event_time"))


def _hourly_of(spark, sf_dir, start, end):
    """Hourly counts of no more deliveries than a range can hold."""
    return counts.delivery_counts(counts.deliveries_of_range(tables.deliveries(spark, sf_dir), start, end))


def counts_in_range(spark, sf_dir):
    return counts.counts_in_range(_hourly_of(spark, sf_dir, *RANGE), *RANGE)


def _newest(spark, sf_dir) -> datetime:
    """The latest delivery time, asked at once so that it can prune the scan."""
    newest = tables.deliveries(spark, sf_dir).agg(F.max("delivered_at").alias("t")).first()["t"]
    return newest or datetime(1970, 1, 1)


def counts_last_24h(spark, sf_dir):
    now = _newest(spark, sf_dir)
    return counts.counts_looking_back(_hourly_of(spark, sf_dir, *counts.looking_back(now, 24)), now, 24)


def recent_window_count(spark, sf_dir):
    now = _newest(spark, sf_dir)
    return counts.recent_window_count(_hourly_of(spark, sf_dir, *counts.looking_back(now, 1)), now)


def location_analytics(spark, sf_dir):
    """The nested row, laid out flat for comparison."""
    events = counts.deliveries_of_location(tables.deliveries(spark, sf_dir), ANALYSED[0])
    hourly_counts = counts.delivery_counts(counts.deliveries_of_range(events, *ANALYSED[1:]))
    nested = counts.location_analytics(hourly_counts, *ANALYSED)
    return nested.select(
        "location", F.explode("hourly_data").alias("h"), "total_deliveries"
    ).select("location", "h.window_start", "h.window_end", "h.count", "total_deliveries")


def _stored(spark, sf_dir) -> DataFrame:
    """The hourly counts as a table by day, made once in a session."""
    return stored.once(
        spark, "hourly-counts", [f"{sf_dir}/events.parquet"],
        lambda folder: stored.write_counts(hourly(spark, sf_dir), folder),
    )


def counts_in_range_stored(spark, sf_dir):
    return counts.counts_in_range(stored.counts_of_days(_stored(spark, sf_dir), *RANGE), *RANGE)


def location_total_stored(spark, sf_dir):
    location, start, end = ANALYSED
    total = counts.location_total(stored.counts_of_days(_stored(spark, sf_dir), start, end), location, start, end)
    return total.select("location", "total_deliveries")


def delivery_rate(spark, sf_dir):
    return counts.delivery_rate(hourly(spark, sf_dir))


def deliveries_per_location(spark, sf_dir):
    return counts.deliveries_per_location(hourly(spark, sf_dir))


def delivery_counts_merged(spark, sf_dir):
    """Counts per source partition, added up."""
    events = tables.deliveries(spark, sf_dir)
    partials = (
        counts.valid_deliveries(events)
        .groupBy("location", F.window("delivered_at", counts.WINDOW).alias("w"), F.col("event_id") % 3)
        .agg(F.count(F.lit(1)).alias("count"))
        .select("location", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "count")
    )
    return counts.merge_counts(partials)


def counts_retained(spark, sf_dir):
    return counts.retained(hourly(spark, sf_dir))


def counts_with_grace(spark, sf_dir):
    return late.counts_with_grace(tables.late_arrivals(spark, sf_dir), tables.ARRIVAL_ORDER)


def counts_with_grace_one_clock(spark, sf_dir):
    return late.counts_with_grace(tables.late_arrivals(spark, sf_dir), tables.ARRIVAL_ORDER, clock=[])


def late_deliveries(spark, sf_dir):
    return late.late_deliveries(tables.late_arrivals(spark, sf_dir), tables.ARRIVAL_ORDER)


def delivery_counts_daily(spark, sf_dir):
    """Counts over the deliveries the life cycle yields."""
    events = lifecycle.delivered_events(replayed(spark, sf_dir))
    return counts.delivery_counts(events, "1 day")


def delivery_counts_streamed(spark, sf_dir):
    """The flagship as a stream over the events table, run until all is read, a
    bounded number of files at a time.  Building it runs the stream; its batches go
    to a folder of their own in the shared one, which goes when the application ends.

    Stored rows come in no order, so no watermark may drop any.
    """
    path = f"{sf_dir}/[e]vents.parquet"  # a pattern: as a plain path a stream takes folders only
    events = spark.readStream.schema(tables.table(spark, sf_dir, "events").schema).option(
        "maxFilesPerTrigger", topics.FILES_PER_TRIGGER
    ).parquet(path)
    folder = temporary_folder(spark, "delivery-counts")
    counted = stream_counts.windowed_counts(tables.as_deliveries(events), grace=None)
    writer = stream_counts.counts_writer(counted, f"{folder}/table")
    sinks.start(writer, f"{folder}/progress", available_now=True).awaitTermination()
    return stream_counts.read_counts(spark, f"{folder}/table")


def analytics_records(spark, sf_dir):
    return records.analytics_records(hourly(spark, sf_dir))


QUERIES = {
    "delivery_counts_hourly": hourly,
    "delivery_counts_hopping": hopping,
    "valid_deliveries": valid_deliveries,
    "event_time": event_time,
    "counts_in_range": counts_in_range,
    "counts_last_24h": counts_last_24h,
    "recent_window_count": recent_window_count,
    "location_analytics": location_analytics,
    "counts_in_range_stored": counts_in_range_stored,
    "location_total_stored": location_total_stored,
    "delivery_rate": delivery_rate,
    "deliveries_per_location": deliveries_per_location,
    "delivery_counts_merged": delivery_counts_merged,
    "counts_retained": counts_retained,
    "counts_with_grace": counts_with_grace,
    "counts_with_grace_one_clock": counts_with_grace_one_clock,
    "late_deliveries": late_deliveries,
    "delivery_counts_daily": delivery_counts_daily,
    "delivery_counts_streamed": delivery_counts_streamed,
    "analytics_records": analytics_records,
}
