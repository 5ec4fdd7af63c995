"""Rows as topic records: ``topic, key, value`` with JSON values, and webhook payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill import schemas as S
from waybill.functions import messages, times
from waybill.operators.events import by_type


def _json(**fields: Column) -> Column:
    """A JSON object; null fields are left out."""
    return F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()]))


def _envelope(event_type: Column, time: Column) -> dict[str, Column]:
    return {
        "correlationId": F.col("correlation_id"),
        "timestamp": F.concat(time, F.lit("Z")),
        "version": F.lit(S.DEFAULT_VERSION),
        "eventType": event_type,
    }


def event_records(events: DataFrame) -> DataFrame:
    """Created, scanned and delivered events as records keyed by shipment."""
    at = times.iso_datetime("event_at")
    kind = F.col("event_type")
    value = _json(
        shipmentId=F.col("shipment_id"),
        location=F.when(kind != S.CREATED_EVENT, F.col("location")),
        destination=F.col("destination"),
        createdAt=F.when(kind == S.CREATED_EVENT, at),
        scannedAt=F.when(kind == S.SCANNED_EVENT, at),
        deliveredAt=F.when(kind == S.DELIVERED_EVENT, at),
        **_envelope(kind, at),
    )
    return events.select(
        by_type(F.lit(S.TOPIC_CREATED), F.lit(S.TOPIC_SCANNED), F.lit(S.TOPIC_DELIVERED)).alias("topic"),
        F.col("shipment_id").alias("key"),
        value.alias("value"),
    )


def analytics_records(counts: DataFrame) -> DataFrame:
    """Counts keyed by location and window start in epoch milliseconds; dates as number arrays."""
    key = F.concat_ws("-", "location", times.epoch_millis("window_start").cast("string"))
    value = _json(
        location=F.col("location"),
        count=F.col("count"),
        windowStart=times.datetime_array("window_start"),
        windowEnd=times.datetime_array("window_end"),
    )
    return counts.select(
        F.lit(S.TOPIC_DELIVERY_ANALYTICS).alias("topic"), key.alias("key"), value.alias("value")
    )


def notification_sent_records(notes: DataFrame) -> DataFrame:
    """A record per notification, without a key."""
    sent = notes.withColumn("correlation_id", F.sha2(F.concat_ws(":", F.lit("sent"), "id"), 256))
    value = _json(
        notificationId=F.col("id"),
        shipmentId=F.col("shipment_id"),
        type=F.col("type"),
        message=F.col("message"),
        **_envelope(F.lit(S.NOTIFICATION_SENT_EVENT), times.iso_datetime("timestamp")),
    )
    return sent.select(
        F.lit(S.TOPIC_NOTIFICATION_SENT).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        value.alias("value"),
    )


def webhook_payloads(events: DataFrame) -> DataFrame:
    """What the webhook is told per event: a scan's location travels as origin,
    a delivery's as destination."""
    millis = times.epoch_millis("event_at")
    nowhere = F.lit(None).cast("string")
    return events.select(
        by_type(F.lit(S.TOPIC_CREATED), F.lit(S.TOPIC_SCANNED), F.lit(S.TOPIC_DELIVERED)).alias("eventType"),
        F.col("shipment_id").alias("shipmentId"),
        messages.default_customer(nowhere, F.col("shipment_id")).alias("customerId"),
        by_type(nowhere, F.col("location"), nowhere).alias("origin"),
        by_type(F.col("destination"), F.col("destination"), F.col("location")).alias("destination"),
        millis.alias("timestamp"),
        F.concat(F.lit("serverless-"), millis.cast("string")).alias("correlationId"),
    )


def customer_messages(payloads: DataFrame, brand: str, now=None) -> DataFrame:
    """Texts sent to the customer for each payload, and how long after the event."""
    event_type = F.col("eventType")

    def channel(number: int) -> Column:
        template = messages.customer_template(event_type, number, brand)
        return F.printf(template, F.col("shipmentId"), F.col("destination"))

    moment = now if now is not None else times.from_instant(F.current_timestamp())
    millis = times.epoch_millis(moment)
    sent_at = F.coalesce(F.nullif(F.col("timestamp"), F.lit(0)), millis)
    return payloads.select(
        event_type.alias("event_type"),
        F.col("shipmentId").alias("shipment_id"),
        messages.customer_name(F.col("customerId")).alias("customer_name"),
        channel(1).alias("email_subject"),
        channel(2).alias("email_body"),
        channel(3).alias("sms"),
        (millis - sent_at).alias("execution_time"),
    )


def event_metrics(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Processed events by type and outcome.  A body that is no JSON object
    counts as a failure, under the type ``error``."""
    schema = T.StructType([*S.WEBHOOK.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(
        F.col(body), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    rows = bodies.select(parsed.alias("p"))
    failed = F.col("p").isNull() | F.col("p._corrupt").isNotNull()
    return (
        rows.groupBy(
            F.when(failed, "error").otherwise(F.col("p.eventType")).alias("event_type"),
            F.when(failed, "failure").otherwise(F.lit("success")).alias("status"),
        )
        .agg(F.count(F.lit(1)).alias("count"))
    )
