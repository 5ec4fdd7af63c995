"""Queries on raw records and log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill import schemas as S
from waybill.functions import times
from waybill.operators import events, records
from waybill.sources import decode, logs, stored, tables


def decode_delivered(spark, sf_dir):
    decoded = decode.decode(tables.delivered_records(spark, sf_dir))
    return decode.delivered(decoded).drop("record_timestamp")


def mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three topics in one table; created records carry the class header in full,
    scanned ones in short, delivered ones none."""
    number = F.regexp_extract("key", r"\d+", 0).cast("bigint")
    made = events.created_events(tables.created(spark, sf_dir)).unionByName(
        events.scanned_events(tables.scans(spark, sf_dir))
    )
    both = records.event_records(made).select(
        "topic",
        (number % 3).cast("int").alias("partition"),
        F.floor((number - number % 3) / 3).alias("offset"),
        times.epoch().alias("timestamp"),
        F.when(F.col("topic") == S.TOPIC_CREATED, f"org.example.events.{S.CREATED_EVENT}")
        .otherwise(S.SCANNED_EVENT)
        .alias("type_id"),
        "key",
        "value",
    )
    return both.unionByName(tables.delivered_records(spark, sf_dir).drop("event_id"))


def _stored_records(spark, sf_dir) -> DataFrame:
    """The records of three topics as a table, written once in a session."""
    inputs = [f"{sf_dir}/{t}.parquet" for t in ("orders", "lineitem", "customer", "supplier", "nation", "events")]
    return stored.once(
        spark, "mixed-records", inputs, lambda folder: mixed_records(spark, sf_dir).write.parquet(folder)
    )


def decode_by_type(spark, sf_dir):
    return decode.decode(_stored_records(spark, sf_dir)).select(
        "topic", "partition", "offset", "event_type", "shipment_id", "destination", "location",
        "created_at", "scanned_at", "delivered_at", "correlation_id",
    )


def decode_dates(spark, sf_dir):
    """Each time as ISO text and as a number array, read back."""
    rows = tables.deliveries(spark, sf_dir)
    array = F.to_json(times.datetime_array("delivered_at"))
    return rows.select(
        "event_id",
        times.read_datetime(times.iso_datetime("delivered_at")).alias("from_iso"),
        times.read_datetime(array).alias("from_array"),
        times.read_datetime(F.concat(F.lit("x"), array)).alias("from_junk"),
    )


def dead_letters(spark, sf_dir):
    parsed = decode.parse(tables.broken_records(spark, sf_dir))
    return decode.dead_letters(parsed).drop("key", "value")


def decode_usable(spark, sf_dir):
    """The other side of the split: what is left to count."""
    decoded = decode.decode(tables.broken_records(spark, sf_dir))
    return decode.delivered(decoded).select("shipment_id", "location", "delivered_at", "correlation_id")


def error_log_lines(spark, sf_dir):
    return logs.error_log_lines(tables.log_lines(spark, sf_dir))


QUERIES = {
    "decode_delivered": decode_delivered,
    "decode_by_type": decode_by_type,
    "decode_dates": decode_dates,
    "decode_usable": decode_usable,
    "dead_letters": dead_letters,
    "error_log_lines": error_log_lines,
}
