"""The three event streams as one: ``event_type, shipment_id, destination,
location, event_at, correlation_id, record_id``.

``record_id`` names the record an event lies in (topic, partition and offset, or
file and line); ids made from it stay the same in a replay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import schemas as S


def _event(event_type: str, location: Column, destination: str, time: str, record_id: Column) -> Column:
    return F.struct(
        F.lit(event_type).alias("event_type"),
        F.col("shipment_id"),
        F.col(destination).alias("destination"),
        location.cast("string").alias("location"),
        F.col(time).alias("event_at"),
        F.col("correlation_id"),
        record_id.alias("record_id"),
    )


def created_events(created: DataFrame) -> DataFrame:
    event = _event(S.CREATED_EVENT, F.lit(None), "destination", "created_at", F.col("record_id"))
    return created.select(event.alias("e")).select("e.*")


def scanned_events(scanned: DataFrame) -> DataFrame:
    event = _event(S.SCANNED_EVENT, F.col("location"), "destination", "scanned_at", F.col("record_id"))
    return scanned.select(event.alias("e")).select("e.*")


def delivered_events(delivered: DataFrame) -> DataFrame:
    event = _event(S.DELIVERED_EVENT, F.col("location"), "destination", "delivered_at", F.col("record_id"))
    return delivered.select(event.alias("e")).select("e.*")


def event_stream(created: DataFrame, scanned: DataFrame, delivered: DataFrame) -> DataFrame:
    """All events, one row each, no de-duplication."""
    return (
        created_events(created)
        .unionByName(scanned_events(scanned))
        .unionByName(delivered_events(delivered))
    )


def replayed_events(replayed: DataFrame) -> DataFrame:
    """Scanned and delivered events from one pass over replayed scans.

    A row is repeated by its kinds alone, so that columns nobody asks for stay unread
    and ids nobody asks for unmade.
    """
    kinds = F.when(
        F.col("delivered"), F.array(F.lit(S.SCANNED_EVENT), F.lit(S.DELIVERED_EVENT))
    ).otherwise(F.array(F.lit(S.SCANNED_EVENT)))
    scanned = F.col("_kind") == S.SCANNED_EVENT
    delivery = F.concat_ws(":", F.lit(S.TOPIC_DELIVERED), "correlation_id")
    return replayed.select("*", F.explode(kinds).alias("_kind")).select(
        F.col("_kind").alias("event_type"),
        "shipment_id",
        F.when(scanned, F.col("scan_destination")).otherwise(F.col("destination")).alias("destination"),
        F.col("location").cast("string").alias("location"),
        F.col("scanned_at").alias("event_at"),
        "correlation_id",
        F.when(scanned, F.col("record_id")).otherwise(delivery).alias("record_id"),
    )


def decoded_events(decoded: DataFrame) -> DataFrame:
    """Decoded topic records as events."""
    return decoded.filter(
        F.col("event_type").isin(S.CREATED_EVENT, S.SCANNED_EVENT, S.DELIVERED_EVENT)
    ).select(
        "event_type",
        "shipment_id",
        "destination",
        "location",
        F.coalesce("created_at", "scanned_at", "delivered_at").alias("event_at"),
        "correlation_id",
        "record_id",
    )


def by_type(created: Column, scanned: Column, delivered: Column) -> Column:
    """One of three values, by event type."""
    kind = F.col("event_type")
    return (
        F.when(kind == S.CREATED_EVENT, created)
        .when(kind == S.SCANNED_EVENT, scanned)
        .when(kind == S.DELIVERED_EVENT, delivered)
    )
